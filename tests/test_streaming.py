"""Structured Streaming: watermark boundary, restart, update vs append, metrics."""

import os
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learner_scoring.plans.pipeline import build_scores
from learner_scoring.sources.fixture import load_topics
from learner_scoring.streaming.observe import observe_scores
from learner_scoring.streaming.pipeline import file_topics, start_query, stream_scores
from learner_scoring.streaming.sinks import BatchUpsert, kafka_frame, latest_scores

from tests.conftest import SF001
from tests.helpers import quiz, sess, topics


def _append_rows(spark, rows, root):
    q, s = topics(spark, rows)
    q.coalesce(1).write.mode("append").parquet(f"{root}/quiz")
    s.coalesce(1).write.mode("append").parquet(f"{root}/session")


def _run(spark, root, mode="update", observe=False):
    qs, ss = file_topics(spark, f"{root}/quiz", f"{root}/session")
    scored = stream_scores(qs, ss)
    if observe:
        scored = observe_scores(scored)
    q = start_query(scored, BatchUpsert(f"{root}/out"), f"{root}/ckpt", mode, available_now=True)
    q.awaitTermination()
    return q


def _table(spark, root):
    if not os.path.exists(f"{root}/out"):
        return {}
    return {(r.student_id, r.window_start_ms): r for r in latest_scores(spark, f"{root}/out").collect()}


def test_watermark_inside_grace_keeps_record(spark, scratch):
    _append_rows(spark, [quiz(1, 64999, True, 8000), sess(2, "STARTED", 64999)], scratch)
    _run(spark, scratch)
    _append_rows(spark, [quiz(3, 30000, False, 8000), sess(4, "STARTED", 30000)], scratch)
    _run(spark, scratch)  # restart from the checkpoint
    t = _table(spark, scratch)
    assert t[("s1", 0)].total_answers == 1


def test_watermark_at_grace_end_drops_record(spark, scratch):
    _append_rows(spark, [quiz(1, 65000, True, 8000), sess(2, "STARTED", 65000)], scratch)
    _run(spark, scratch)
    _append_rows(spark, [quiz(3, 31000, False, 8000), sess(4, "STARTED", 31000)], scratch)
    _run(spark, scratch)
    t = _table(spark, scratch)
    assert ("s1", 0) not in t
    assert t[("s1", 60000)].total_answers == 1


def test_restart_resumes_window_state(spark, scratch):
    _append_rows(spark, [quiz(1, 1000, False, 8000), quiz(2, 2000, False, 8000), sess(9, "STARTED", 1000)], scratch)
    _run(spark, scratch)
    _append_rows(spark, [quiz(3, 3000, False, 8000), sess(10, "STARTED", 3000)], scratch)
    _run(spark, scratch)
    r = _table(spark, scratch)[("s1", 0)]
    # state carried across the restart: all three answers, streak 3, two rapid gaps
    assert (r.total_answers, r.consecutive_incorrect, r.rapid_submissions) == (3, 3, 2)


def test_update_stream_equals_batch_on_fixture(spark, scratch):
    q, s = load_topics(spark, SF001)
    # four arrival-ordered slices -> four micro-batches, each a quarter of either topic's offsets
    n_quiz, n_session = (t.agg(F.max("kafka_offset")).first()[0] for t in (q, s))
    kept, seen = [], [0]
    for i in range(4):
        part = [
            t.filter((F.col("kafka_offset") > n * i // 4) & (F.col("kafka_offset") <= n * (i + 1) // 4))
            for t, n in ((q, n_quiz), (s, n_session))
        ]
        for t, folder in zip(part, ("quiz", "session")):
            t.coalesce(1).write.mode("append").parquet(f"{scratch}/{folder}")
        # a micro-batch drops what the watermark of the batch before it has closed: the batches up to i - 2
        closed = (max(seen[: max(i, 1)]) - 5000) if i >= 2 else 0
        kept.append([t.filter(F.unix_millis("record_ts") - F.unix_millis("record_ts") % 60000 + 60000 > closed) for t in part])
        seen.append(max(t.agg(F.max(F.unix_millis("record_ts"))).first()[0] for t in part))
    on_time_q, on_time_s = (reduce(DataFrame.unionByName, [k[j] for k in kept]) for j in (0, 1))
    batch = {(r.student_id, r.window_start_ms): r for r in build_scores(on_time_q, on_time_s, late="keep").collect()}
    qs, ss = file_topics(spark, f"{scratch}/quiz", f"{scratch}/session", max_files_per_trigger=1)
    query = start_query(stream_scores(qs, ss), BatchUpsert(f"{scratch}/out"), f"{scratch}/ckpt", available_now=True)
    query.awaitTermination()
    assert len(query.recentProgress) >= 4
    stream = _table(spark, scratch)
    assert set(stream) == set(batch)
    for k, r in batch.items():
        for f in ("score", "total_answers", "session_id", "consecutive_incorrect", "rapid_submissions"):
            assert stream[k][f] == r[f], (k, f)


def test_append_mode_emits_closed_windows_once(spark, scratch):
    _append_rows(spark, [quiz(1, 1000, True, 8000), quiz(2, 2000, True, 9000)], scratch)
    _run(spark, scratch, mode="append")
    assert _table(spark, scratch) == {}  # window still open
    _append_rows(spark, [sess(3, "STARTED", 200000)], scratch)  # moves the watermark past the window
    _run(spark, scratch, mode="append")
    _append_rows(spark, [sess(4, "STARTED", 201000)], scratch)  # next batch evicts and emits
    _run(spark, scratch, mode="append")
    t = _table(spark, scratch)
    assert t[("s1", 0)].total_answers == 2


def test_observed_metrics_and_kafka_frame(spark, scratch):
    _append_rows(spark, [quiz(1, 1000, False, 3000), quiz(2, 2000, False, 3000)], scratch)
    q = _run(spark, scratch, observe=True)
    observed = [p["observedMetrics"] for p in q.recentProgress if p.get("observedMetrics")]
    assert observed and observed[-1]["scores"]["scores_produced"] == 1
    kf = kafka_frame(latest_scores(spark, f"{scratch}/out")).collect()[0]
    assert kf.key == "s1" and '"trend":"CRITICAL"' in kf.value and '"alertThresholdCrossed":true' in kf.value


def test_streaming_decode_splits_dead_letters(spark, scratch):
    """Kafka-schema records (as files) -> decode -> score stream + dead letters."""
    from learner_scoring.operators.enrich import split_valid, unified_events
    from learner_scoring.schemas import QUIZ_ANSWER, SESSION_EVENT
    from learner_scoring.sources import decode
    from learner_scoring.sources.fixture import kafka_records, staged_fixture

    qr, sr = kafka_records(staged_fixture(spark, SF001), defects=True)
    qr.write.parquet(f"{scratch}/quiz_rec")
    sr.write.parquet(f"{scratch}/session_rec")
    rq = spark.readStream.schema(qr.schema).parquet(f"{scratch}/quiz_rec")
    rs = spark.readStream.schema(sr.schema).parquet(f"{scratch}/session_rec")
    q, qbad = decode.split_decoded(decode.decode_json(rq, QUIZ_ANSWER))
    s, sbad = decode.split_decoded(decode.decode_json(rs, SESSION_EVENT))
    _, dead = split_valid(unified_events(q, s))
    bad = qbad.unionByName(sbad).select("record_key", "reason").unionByName(
        dead.select("record_key", F.col("invalid_reason").alias("reason"))
    )
    dq = start_query(bad, BatchUpsert(f"{scratch}/dead"), f"{scratch}/ckpt_dead", "append", available_now=True)
    dq.awaitTermination()
    sq = start_query(stream_scores(q, s), BatchUpsert(f"{scratch}/out"), f"{scratch}/ckpt", available_now=True)
    sq.awaitTermination()
    dead_rows = spark.read.parquet(f"{scratch}/dead/batch_id=*").collect()
    reasons = {r.reason for r in dead_rows}
    assert {"corrupt_payload", "empty_payload", "null_event_type", "null_student_id"} <= reasons
    # the stream sends exactly the dead letters the batch decode finds
    bq, bqbad = decode.split_decoded(decode.decode_json(qr, QUIZ_ANSWER))
    bs, bsbad = decode.split_decoded(decode.decode_json(sr, SESSION_EVENT))
    _, bdead = split_valid(unified_events(bq, bs))
    assert len(dead_rows) == bqbad.count() + bsbad.count() + bdead.count()
    assert len(_table(spark, scratch)) > 0


def test_updates_of_a_window_have_their_own_ids(spark):
    import json

    from learner_scoring.plans.pipeline import build_scores
    from learner_scoring.sources.fixture import load_topics

    one = build_scores(*load_topics(spark, SF001), late="keep").limit(1)
    ids = [json.loads(kafka_frame(one, batch_id=b).first()["value"])["envelope"]["id"] for b in (1, 2, 1)]
    assert ids[0] != ids[1] and ids[0] == ids[2]


def test_registered_stream_runs_in_batches_on_rocksdb(spark, tmp_path):
    """Several micro-batches over landed slices, each started from the checkpoint, hold all scores of the batch topology."""
    from learner_scoring.plans.pipeline import build_scores
    from learner_scoring.sources.fixture import load_topics
    from learner_scoring.streaming.pipeline import PROVIDER_KEY, run_file_backed_stream
    from tests.conftest import SF001

    before, run = spark.conf.get(PROVIDER_KEY, None), tmp_path / "run"
    got = run_file_backed_stream(spark, SF001, run=str(run))
    assert spark.conf.get(PROVIDER_KEY, None) == before
    cols = ["student_id", "window_start_ms", "score", "trend"]
    want = build_scores(*load_topics(spark, SF001), late="keep").select(*cols)
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.collect()))
    batches = spark.read.parquet(str(run / "scores")).groupBy("student_id", "window_start_ms").agg({"batch_id": "count"})
    assert spark.read.parquet(str(run / "scores")).select("batch_id").distinct().count() >= 4
    assert batches.filter("`count(batch_id)` > 1").count() > 0  # windows gone on with from kept state
    assert any("RocksDB" in f.read_text() for f in (run / "checkpoint" / "offsets").iterdir() if not f.name.startswith("."))

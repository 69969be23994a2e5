"""The streaming job end to end, with parquet folders of Kafka-schema records."""

import json

import pytest
from pyspark.sql import functions as F

from learner_scoring.operators.enrich import split_valid, unified_events
from learner_scoring.plans.pipeline import build_scores
from learner_scoring.schemas import QUIZ_ANSWER, SESSION_EVENT
from learner_scoring.sources import decode
from learner_scoring.sources.fixture import kafka_records, load_topics, staged_fixture
from learner_scoring.streaming import app
from learner_scoring.streaming.sinks import latest_scores

from tests.conftest import SF001


def test_args_defaults():
    a = app.parse_args([])
    assert (a.source, a.sink, a.quiz_topic, a.score_topic, a.mode) == (
        "kafka", "kafka", "quiz.answers", "engagement.scores", "update")


def test_job_scores_and_dead_letters(spark, scratch):
    qr, sr = kafka_records(staged_fixture(spark, SF001), defects=True)
    qr.write.parquet(f"{scratch}/quiz")
    sr.write.parquet(f"{scratch}/session")
    queries = app.run(spark, [
        "--source", "files", "--quiz-path", f"{scratch}/quiz", "--session-path", f"{scratch}/session",
        "--sink", "files", "--out", f"{scratch}/scores", "--dead-letters", f"{scratch}/dead",
        "--alerts", f"{scratch}/alerts",
        "--checkpoint-name", f"app-{scratch.rsplit('/', 1)[-1]}", "--available-now",
    ])
    for q in queries:
        q.awaitTermination()
    got = {(r.student_id, r.window_start_ms): r for r in latest_scores(spark, f"{scratch}/scores").collect()}

    # the same records through the batch plan
    q, qbad = decode.split_decoded(decode.decode_json(qr, QUIZ_ANSWER))
    s, sbad = decode.split_decoded(decode.decode_json(sr, SESSION_EVENT))
    want = {(r.student_id, r.window_start_ms): r for r in build_scores(q, s, late="keep").collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert (got[k].score, got[k].trend, got[k].total_answers) == (want[k].score, want[k].trend, want[k].total_answers)

    alerted = {(r.student_id, r.window_start_ms) for r in latest_scores(spark, f"{scratch}/alerts").filter("alert_threshold_crossed").collect()}
    assert alerted == {k for k, r in want.items() if r.alert_threshold_crossed}
    observed = [p["observedMetrics"]["scores"] for p in queries[0].recentProgress if p.get("observedMetrics")]
    assert sum(m["scores_produced"] for m in observed) == len(want)

    _, unfoldable = split_valid(unified_events(q, s))
    dead = spark.read.parquet(f"{scratch}/dead/batch_id=*")
    assert dead.count() == qbad.count() + sbad.count() + unfoldable.count()
    # the payload as it came, whatever the reason
    sent = {r.key.decode(): bytes(r.value) for r in qr.select("key", "value").union(sr.select("key", "value")).collect()}
    assert all(bytes(r.payload) == sent[r.record_key] for r in dead.collect())
    consumed = [p["observedMetrics"]["events"] for p in queries[0].recentProgress if p.get("observedMetrics")]
    assert sum(m["records"] for m in consumed) == q.count() + s.count() - unfoldable.count()


def test_settings_from_file_and_arguments(scratch):
    with open(f"{scratch}/scoring.json", "w") as f:
        json.dump({"weights": {"accuracy": 0.5, "dwell": 0.2}, "window": {"duration_seconds": 30}}, f)
    a = app.parse_args(["--config", f"{scratch}/scoring.json", "--set", "weights.dwell=0.25", "--set", "thresholds.struggling_ms=9000", "--set", "window.grace_period_seconds=2"])
    cfg = app.scoring_config(a)
    assert (cfg.weights.accuracy, cfg.weights.dwell, cfg.weights.pacing) == (0.5, 0.25, 0.3)
    assert (cfg.window.duration_ms, cfg.window.grace_ms, cfg.thresholds.struggling_ms) == (30_000, 2_000, 9000)
    for bad in (["--set", "weights.speed=1"], ["--set", "colors.red=1"], ["--set", "weights"], ["--set", "window.duration_seconds=0"]):
        with pytest.raises(ValueError):
            app.scoring_config(app.parse_args(bad))


def test_job_uses_its_settings(spark, scratch):
    """A 30 s window and other weights, through the job and through the batch plan."""
    qr, sr = kafka_records(staged_fixture(spark, SF001), defects=False)
    qr.write.parquet(f"{scratch}/quiz")
    sr.write.parquet(f"{scratch}/session")
    args = ["--set", "window.duration_seconds=30", "--set", "weights.accuracy=0.7", "--set", "thresholds.yellow=0.6"]
    for q in app.run(spark, [
        "--source", "files", "--quiz-path", f"{scratch}/quiz", "--session-path", f"{scratch}/session", "--sink", "files",
        "--out", f"{scratch}/scores", "--checkpoint-name", f"app-{scratch.rsplit('/', 1)[-1]}", "--available-now", *args,
    ]):
        q.awaitTermination()
    cols = ["student_id", "window_start_ms", "window_end_ms", "total_answers", "score", "trend"]
    q, s = load_topics(spark, SF001)
    want = build_scores(q, s, app.scoring_config(app.parse_args(args)), late="keep", order=False).select(*cols)
    assert sorted(map(tuple, latest_scores(spark, f"{scratch}/scores").select(*cols).collect())) == sorted(map(tuple, want.collect()))


def test_client_settings_and_schemas_reach_kafka(monkeypatch, scratch):
    seen = []
    monkeypatch.setattr(app.kafka, "read_topic_stream", lambda spark, opts: seen.append(opts))
    a = app.parse_args(["--client", "security.protocol=SASL_SSL", "--client", "sasl.mechanism=PLAIN"])
    app._records(None, a, "quiz.answers", None)
    assert seen[0]["kafka.security.protocol"] == "SASL_SSL" and seen[0]["kafka.sasl.mechanism"] == "PLAIN"
    with open(f"{scratch}/q.avsc", "w") as f:
        f.write('{"type":"record"}')
    called = {}
    monkeypatch.setattr(app.decode, "decode_avro_by_id", lambda records, schemas, schema: called.update(schemas))
    monkeypatch.setattr(app.decode, "split_decoded", lambda d: (None, None))
    a = app.parse_args(["--format", "avro", "--quiz-schema", f"7={scratch}/q.avsc"])
    app._decoded(None, a, QUIZ_ANSWER, a.quiz_schema)
    assert called == {7: '{"type":"record"}'}
    with pytest.raises(ValueError):
        app._decoded(None, a, SESSION_EVENT, a.session_schema)


def test_timed_trigger_emits_while_records_come(spark, scratch):
    """A running query with a one-second cadence; records land while it runs."""
    qr, sr = kafka_records(staged_fixture(spark, SF001), defects=False)
    even = F.col("offset") % 2 == 0
    qr.filter(even).write.parquet(f"{scratch}/quiz")
    sr.filter(even).write.parquet(f"{scratch}/session")
    (query,) = app.run(spark, [
        "--source", "files", "--quiz-path", f"{scratch}/quiz", "--session-path", f"{scratch}/session", "--sink", "files",
        "--out", f"{scratch}/scores", "--checkpoint-name", f"app-{scratch.rsplit('/', 1)[-1]}", "--trigger-seconds", "1",
    ])
    try:
        query.processAllAvailable()
        first = [p["batchId"] for p in query.recentProgress if p["numInputRows"]]
        n = sum(r.total_answers for r in latest_scores(spark, f"{scratch}/scores").collect())
        assert first and query.isActive and 0 < n < qr.count()
        qr.filter(~even).write.mode("append").parquet(f"{scratch}/quiz")
        query.processAllAvailable()
        assert max(p["batchId"] for p in query.recentProgress if p["numInputRows"]) > max(first)
        assert sum(r.total_answers for r in latest_scores(spark, f"{scratch}/scores").collect()) > n
    finally:
        query.stop()

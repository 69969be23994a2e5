"""Keyed state with timers: clocks, compact folds, eviction, hand-over, state read back, the committed table."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learner_scoring.operators import partials as P
from learner_scoring.operators.enrich import valid_events
from learner_scoring.operators.sequence import arrival_order
from learner_scoring.operators.windows import assign_window, late_records
from learner_scoring.plans import monitor
from learner_scoring.plans.pipeline import build_scores
from learner_scoring.sources.fixture import load_topics
from learner_scoring.streaming import runs as R
from learner_scoring.streaming import stateful as S
from learner_scoring.streaming.pipeline import rocksdb_state, start_query
from learner_scoring.streaming.sinks import BatchUpsert, latest_scores
from learner_scoring.streaming.table import CommittedTable

from tests.conftest import SF001
from tests.helpers import quiz, sess, topics

STATE = [f for f in S._SHOWN if f != "session_id"]


def events(spark, rows):
    """Windowed events; offsets count per partition, arrival goes by record time."""
    q, s = topics(spark, rows)
    order = arrival_order(F.unix_millis("record_ts"), F.col("topic"), F.col("kafka_partition"), F.col("kafka_offset"))
    return assign_window(valid_events(q.withColumn("arrival_seq", order), s.withColumn("arrival_seq", order)))


def fold_slices(spark, scratch, slices, **kw):
    """The latest states of a fold started again for every slice, and its last progress."""
    progress = []
    with rocksdb_state(spark):
        for ev in slices:
            ev.select(*S.EVENT_COLUMNS).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
            stream = spark.readStream.schema(ev.select(*S.EVENT_COLUMNS).schema).parquet(f"{scratch}/in")
            q = start_query(S.fold_windows(stream, **kw), BatchUpsert(f"{scratch}/out"), f"{scratch}/ckpt", available_now=True)
            q.awaitTermination()
            progress.append(q.lastProgress)
    return latest_scores(spark, f"{scratch}/out"), progress


def many(n, start=0, at=1000, step=20):
    """n answers and n session records of two students inside the first minute."""
    out = []
    for i in range(start, start + n):
        out.append(quiz(2 * i + 1, at + i * step, i % 5 == 0, 100 + i, hints=i % 3, skill=f"k{i % 4}", student=f"s{i % 2}"))
        out.append(sess(2 * i + 2, ["NAVIGATION", "DWELL", "PAUSED", "RESUMED"][i % 4], at + i * step + 5, page=f"p{i % 3}", dwell=i, student=f"s{i % 2}"))
    return out


def test_fold_equals_batch_and_state_does_not_grow(spark, scratch):
    slices = [events(spark, many(10)), events(spark, many(300, start=10))]
    latest, _ = fold_slices(spark, scratch, slices[:1], words=True)
    size = lambda: {
        r.student_id: (r.asDict()["total_answers"], 8 * len(S._FIELDS) + len(r.session_id)) for r in S.read_windows(spark, f"{scratch}/ckpt").collect()
    }
    few = size()
    kinds = T._parse_datatype_string(S.STATE_DDL)
    assert all(isinstance(f.dataType, (T.LongType, T.IntegerType, T.StringType)) for f in kinds)  # no list, no map
    latest, progress = fold_slices(spark, scratch, slices[1:], words=True)
    many_ = size()
    assert few["s0"][0] == 5 and many_["s0"][0] == 155 and few["s0"][1] == many_["s0"][1]
    # two windows: one value, four tags at most and three pages at most, a timer and its index each
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] <= 2 * (1 + 4 + 3 + 2)
    want = P.state(P.window_partials(slices[0].unionByName(slices[1]), words=True))
    cols = ["student_id", "window_start_ms", "session_id", *STATE, "pages_visited", "skill_tag_attempts"]
    key = lambda df: sorted([[r[c] for c in cols] for r in df.collect()], key=repr)
    assert key(latest) == key(want)


def test_timer_ends_a_window_once(spark, scratch):
    one = events(spark, [quiz(1, 1000, True, 10), quiz(2, 2000, False, 10)])
    far = events(spark, [sess(3, "STARTED", 200_000), sess(4, "STARTED", 200_001, student="s2")])
    more = events(spark, [sess(5, "STARTED", 400_000)])
    out, _ = fold_slices(spark, scratch, [one], emit="final", lag_seconds=0)
    assert out is not None and S.read_windows(spark, f"{scratch}/ckpt").count() == 1
    final, _ = fold_slices(spark, scratch, [far, more], emit="final", lag_seconds=0)
    rows = {(r.student_id, r.window_start_ms): r.total_answers for r in final.collect()}
    assert rows == {("s1", 0): 2, ("s1", 180_000): 0, ("s2", 180_000): 0}
    assert spark.read.parquet(f"{scratch}/out/batch_id=*").count() == 3  # each once
    assert [r.window_start_ms for r in S.read_windows(spark, f"{scratch}/ckpt").collect()] == [360_000]


def test_every_record_has_a_change(spark, scratch):
    a, b = events(spark, many(6)), events(spark, many(6, start=6))
    fold_slices(spark, scratch, [a, b], emit="every")
    from learner_scoring.operators.changelog import running_state

    got = spark.read.parquet(f"{scratch}/out/batch_id=*")
    cols = ["event_id", "total_answers", "consecutive_incorrect", "rapid_submissions", "first_event_ms", "last_event_ms"]
    want = running_state(a.unionByName(b))
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


def test_clock_is_kept_per_partition_and_across_restarts(spark, scratch):
    first = [quiz(1, 64_999, True), quiz(2, 30_000, True), quiz(1, 500_000, True, partition=1, student="s2")]
    then = [quiz(3, 65_000, True), quiz(4, 31_000, True), quiz(2, 400_000, True, partition=1), quiz(3, 499_999, True, partition=1)]
    with rocksdb_state(spark):
        for rows in (first, then):
            ev = events(spark, rows).select(*S.EVENT_COLUMNS, "event_type")
            ev.coalesce(1).write.mode("append").parquet(f"{scratch}/in")
            timed = S.stamp_stream_time(spark.readStream.schema(ev.schema).parquet(f"{scratch}/in"))
            w = timed.writeStream.format("parquet").option("path", f"{scratch}/out").option("checkpointLocation", f"{scratch}/ckpt")
            w.trigger(availableNow=True).start().awaitTermination()
    cols = ["kafka_partition", "kafka_offset", "stream_time_ms"]
    late = spark.read.parquet(f"{scratch}/out").filter("late").select(*cols)
    want = late_records(events(spark, first + then)).select(*cols)
    assert sorted(map(tuple, late.collect())) == sorted(map(tuple, want.collect())) == [(0, 4, 65_000), (1, 2, 500_000)]


def test_students_of_a_window_share_state_keys(spark, scratch):
    """40 students in one window are two keys of the state, not 40, and go on from their own values."""
    def part(lo, hi):
        return events(spark, [quiz(100 * i + n, 1000 + n * 10 + i, (i + n) % 3 == 0, n, student=f"s{i}") for i in range(40) for n in range(lo, hi)])

    latest, _ = fold_slices(spark, scratch, [part(1, 5), part(5, 9)], shards=2)
    held = spark.read.format("statestore").option("path", f"{scratch}/ckpt").option("stateVarName", "window").load()
    assert held.select("key").distinct().count() == 2 and S.read_windows(spark, f"{scratch}/ckpt").count() == 40
    want = P.state(P.window_partials(part(1, 9)))
    cols = ["student_id", "window_start_ms", "session_id", *STATE]
    key = lambda df: sorted([[r[c] for c in cols] for r in df.collect()], key=repr)
    assert key(latest) == key(want)


def test_clocked_batches_take_no_partition_whole(spark, scratch):
    """A micro-batch is clocked by native scans cut into offset buckets; clocks go on, a replay changes nothing."""
    first = [quiz(1, 64_999, True), quiz(2, 30_000, True), quiz(1, 500_000, True, partition=1, student="s2")]
    then = [quiz(3, 65_000, True), quiz(4, 31_000, True), quiz(2, 400_000, True, partition=1), quiz(3, 499_999, True, partition=1)]
    a, b = (events(spark, rows).select(*S.EVENT_COLUMNS, "event_type") for rows in (first, then))
    plan = S.stamp_stream_time(a)._jdf.queryExecution().optimizedPlan().toString()
    assert "TransformWithState" not in plan and "Window" in plan
    clock = S.ClockedBatches(scratch)
    for batch, n in ((a, 0), (b, 1), (b, 1), (a.limit(0), 2)):
        clock(batch, n)
    cols = ["kafka_partition", "kafka_offset", "stream_time_ms"]
    rows = spark.read.schema(clock.schema(a)).parquet(f"{scratch}/rows")
    assert rows.count() == 7
    late = rows.filter("late = 1").select(*cols)
    want = late_records(events(spark, first + then)).select(*cols)
    assert sorted(map(tuple, late.collect())) == sorted(map(tuple, want.collect())) == [(0, 4, 65_000), (1, 2, 500_000)]
    clocks = spark.read.schema(S.CLOCK_DDL).parquet(f"{scratch}/clocks/batch=2")
    assert sorted(r[1:] for r in map(tuple, clocks.collect())) == [(0, 65_000), (1, 500_000)]


def test_batch_hands_over_to_stream(spark):
    q, s = load_topics(spark, SF001)
    ev = assign_window(valid_events(q, s))
    got = R.handover_run(spark, ev, slices=2)
    cols = ["student_id", "window_start_ms", "session_id", "total_answers", "score", "trend"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, build_scores(q, s, late="keep", order=False).select(*cols).collect()))


# ------------------------------------------------------------ the table with a commit log


def batch(spark, rows):
    return spark.createDataFrame(rows, "student_id string, window_start_ms bigint, score double")


def content(spark, table):
    return sorted(map(tuple, table.read(spark).collect()))


def test_uncommitted_write_is_not_seen(spark, scratch):
    t = CommittedTable(scratch, compact_every=None)
    with pytest.raises(FileNotFoundError):
        t.read(spark)
    assert t.write(batch(spark, [("a", 0, 0.1), ("b", 0, 0.2)]), 0)
    left = t._stage(batch(spark, [("a", 0, 9.9)]).withColumn("batch_id", F.lit(1).cast("bigint")), "batch", 1)  # dies here
    assert content(spark, t) == [("a", 0, 0.1), ("b", 0, 0.2)] and t.unused(spark) == [left]
    assert t.write(batch(spark, [("a", 0, 0.3)]), 1)  # the replay
    assert content(spark, t) == [("a", 0, 0.3), ("b", 0, 0.2)]
    assert not t.write(batch(spark, [("a", 0, 7.0)]), 1)  # replayed after its commit
    assert not t.write(batch(spark, [("a", 0, 7.0)]), 0)
    assert content(spark, t) == [("a", 0, 0.3), ("b", 0, 0.2)]


def test_compaction_replaces_writes_by_one_commit(spark, scratch):
    t = CommittedTable(scratch, compact_every=None)
    for i in range(4):
        t.write(batch(spark, [("a", 0, float(i)), (f"x{i}", 60_000, float(i))]), i)
    before = content(spark, t)
    live = t.commits(spark)
    t._stage(t._latest(spark, live), "base", live[-1][2])  # a compaction that dies changes nothing
    assert content(spark, t) == before and len(t.commits(spark)) == 4
    t.compact(spark)
    assert content(spark, t) == before and [c[1] for c in t.commits(spark)] == ["base"]
    assert len(t.unused(spark)) == 5
    t.write(batch(spark, [("a", 0, 9.0)]), 4)
    assert dict((r[0], r[2]) for r in content(spark, t))["a"] == 9.0
    assert not t.write(batch(spark, [("a", 0, 1.0)]), 3)
    small = CommittedTable(f"{scratch}/auto", compact_every=2)
    for i in range(5):
        small.write(batch(spark, [("a", 0, float(i))]), i)
    assert len(small.commits(spark)) <= 2 and content(spark, small) == [("a", 0, 4.0)]


# ------------------------------------------------------------ sketches


def test_sketch_ranks(spark):
    """Merged sketches of 200,000 scores: every quantile within 0.2 % of its rank; small ones exact."""
    scored = spark.range(200_000).select(
        (F.col("id") % 40 * 60_000).alias("window_start_ms"), (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1_000_003.0).alias("score")
    )
    merged = monitor.merge_sketches(monitor.score_sketches(scored), 3_600_000)
    (row,) = monitor.sketch_quantiles(merged).collect()
    assert row.scores == 200_000
    for name, q in monitor.QUANTILES.items():
        rank = scored.filter(F.col("score") <= row[name]).count() / 200_000
        assert abs(rank - q) <= 0.002, (name, rank)
    some = monitor.sketch_quantiles(monitor.score_sketches(scored.filter("id < 4000"))).collect()
    exact = scored.filter("id < 4000").groupBy("window_start_ms").agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY score)").alias("p50"))
    assert {r.window_start_ms: r.p50 for r in some} == {r.window_start_ms: r.p50 for r in exact.collect()}



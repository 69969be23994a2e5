"""Adaptive order scans and mergeable partials: same results however windows are cut and merged."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from learner_scoring.operators import partials as P
from learner_scoring.operators import sequence
from learner_scoring.operators.changelog import score_changelog
from learner_scoring.operators.enrich import valid_events
from learner_scoring.operators.fold import order_metrics, window_state
from learner_scoring.operators.sequence import answer_positions, hot_windows, split_hot
from learner_scoring.operators.windows import assign_window
from learner_scoring.plans.queries import _events, queries

from tests.conftest import SF001
from tests.helpers import quiz, sess, topics

ALL_HOT = {"hot_rows": 1, "every": 1}
KINDS = ["NAVIGATION", "PAUSED", "RESUMED", "DWELL", "STARTED"]


def rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(tuple(sorted(v.items())) if isinstance(v, dict) else tuple(v) if isinstance(v, list) else v for v in r) for r in df.select(*cols).collect()), key=repr)


@pytest.fixture(scope="module")
def events(spark):
    return _events(spark, SF001)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows in one window, half of those in one millisecond; sparse windows beside it."""
    data = []
    for i in range(1, 901):
        third = i % 3 == 0
        at = (7_000 if i % 2 else 7_000 + i * 13) if third else i * 411
        who = {"student": "hot" if third else f"s{i % 40}", "session": f"x{i % 5}", "partition": i // 3 % 2}
        if i % 4:
            data.append(quiz(i, at, i % 7 == 0, i if i % 5 else None, skill=f"k{i % 3}" if i % 6 else None, **who))
        else:
            data.append(sess(i, KINDS[i % 5], at, page=f"p{i % 4}", dwell=i, **who))
    q, s = topics(spark, data)
    order = F.struct((F.unix_millis("record_ts")).alias("record_ms"), "topic", "kafka_partition", "kafka_offset")
    return assign_window(valid_events(q.withColumn("arrival_seq", order), s.withColumn("arrival_seq", order))).persist()


def test_one_pass_equals_joined_aggregates(events, skewed):
    for ev in (events, skewed):
        want = rows(window_state(ev, windowed=True, with_skills=True))
        assert rows(window_state(ev, windowed=True, with_skills=True, one_pass=True)) == want
        assert rows(window_state(ev, windowed=True, with_skills=True, one_pass=True, seq_bucket=1)) == want


@pytest.mark.parametrize("how", [ALL_HOT, {"hot_rows": 4, "every": 1}, {"hot_rows": 40, "every": 1}, {"hot_rows": 20, "every": 4}])
def test_cut_windows_change_nothing(events, skewed, how):
    for ev in (events, skewed):
        assert rows(P.state(P.window_partials(ev, True, **how))) == rows(P.state(P.window_partials(ev, True)))
        assert rows(order_metrics(ev, **how)) == rows(order_metrics(ev))
        assert rows(score_changelog(ev, **how)) == rows(score_changelog(ev))
        answers = ev.filter("is_quiz").select(*P.GROUP, "arrival_seq", "event_ms")
        assert rows(answer_positions(answers, P.GROUP, 60_000, **how)) == rows(answer_positions(answers, P.GROUP, 60_000))


def test_longest_window_is_found_and_cut(skewed, monkeypatch):
    monkeypatch.setattr(sequence, "OFFSETS", 64)
    hot = hot_windows(skewed, P.GROUP, 60_000, 100, 1)
    assert [(r.student_id, r.window_start_ms) for r in hot.collect()] == [("hot", 0)]
    usual, cut = split_hot(skewed, P.GROUP, 60_000, hot_rows=100, every=1)
    assert usual.filter("student_id = 'hot' and window_start_ms = 0").count() == 0
    sizes = [r["count"] for r in cut.groupBy("_bkt").count().collect()]
    assert usual.count() + sum(sizes) == skewed.count()
    assert len(sizes) > 20 and max(sizes) <= 20  # the hot millisecond is cut by topic, partition and offsets
    assert hot_windows(skewed, P.GROUP, 60_000) is None


@pytest.mark.parametrize("sizes", [(1,), (2, 3), (7, 2), (50,)])
def test_merge_in_any_grouping(skewed, sizes):
    """Slices of the arrival order, merged step by step into coarser ones, give the window state."""
    want = rows(P.state(P.window_partials(skewed, True)))
    order = F.dense_rank().over(Window.partitionBy(*P.GROUP).orderBy("arrival_seq"))
    part = P.fold(skewed.withColumn("slice", F.floor((order - 1) / 3)), [*P.GROUP, "slice"], words=True)
    for n in sizes:
        coarser = part.withColumn("slice", F.floor(F.col("slice") / n))
        part = P.merge(coarser, [*P.GROUP, "slice"])
    assert rows(P.state(P.merge(part.drop("slice")))) == want


def full_shuffles(df):
    """Shuffles of the plan that ran, and the records each wrote."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    return final.count("Exchange hashpartitioning"), final


@pytest.mark.parametrize("name", ["incorrect_streak", "rapid_submissions", "answer_lists", "score_changelog", "window_state", "pattern_flags"])
def test_order_queries_shuffle_once(spark, name):
    n, plan = full_shuffles(queries()[name](spark, SF001))
    assert n == 1, plan
    assert "Join" not in plan and plan.count("FileScan") <= 2
    (exchange,) = [x for x in plan.split("\n") if "Exchange hashpartitioning" in x]
    assert "student_id" in exchange and "window_start_ms" in exchange and "_bkt" not in exchange


def test_cut_windows_shuffle_rows_once(events):
    """Cut windows: their rows by bucket, the others by window; the rest are partials."""
    n, plan = full_shuffles(P.window_partials(events, **ALL_HOT))
    shuffles = [x for x in plan.split("\n") if "Exchange hashpartitioning" in x]
    assert sum("_bkt" in x for x in shuffles) == 1 and n == 3, plan

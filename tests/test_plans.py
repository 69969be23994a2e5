"""Physical-plan checks: the plans stay the ones intended for scale."""

import pytest

from learner_scoring.plans import queries

from tests.conftest import SF001


def _plan(df):
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def q():
    return queries.queries()


def test_no_python_or_cartesian_in_core_queries(spark, q):
    for name, fn in q.items():
        if name == "streaming_scores":
            continue
        p = _plan(fn(spark, SF001))
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "FlatMapGroupsInPandas"):
            assert bad not in p, (name, bad)


def test_flagship_has_one_shuffle_and_pruned_scans(spark, q):
    p = _plan(q["engagement_scores"](spark, SF001))
    assert p.count("Exchange hashpartitioning") == 1
    scans = [line for line in p.split("\n") if "FileScan" in line]
    assert len(scans) == 2  # one per topic partition
    for line in scans:
        schema = line.split("ReadSchema:")[1]
        # columns the score does not need are pruned at the scan
        for unused in ("question_id", "skill_tag", "hints_used", "difficulty_level", "page_id", "dwell_time_ms"):
            assert unused not in schema, (unused, schema)
        assert "PartitionFilters: [isnotnull(topic" in line


def test_fold_never_collects_answers_in_batch(spark, q):
    # only the per-tag counts (bounded by the tag vocabulary) are collected
    for name in ("window_state", "engagement_scores", "incorrect_streak", "rapid_submissions", "score_changelog"):
        p = _plan(q[name](spark, SF001))
        for line in p.split("\n"):
            if "collect_list(" in line:
                assert "collect_list(struct(skill_tag" in line, (name, line[:200])


def test_late_filter_is_bucketed(spark, q):
    p = _plan(q["late_filtered_scores"](spark, SF001))
    # running max is partitioned by (topic, kafka partition, offset bucket), not the partition alone
    parts = [line.split("hashpartitioning(")[1] for line in p.split("\n") if "hashpartitioning(topic" in line]
    assert parts and any("kafka_partition" in x and "_bkt" in x for x in parts)


def test_answer_metrics_and_routes_take_one_pass(spark, q):
    for name in ("incorrect_streak", "rapid_submissions", "event_routing"):
        p = _plan(q[name](spark, SF001))
        assert "Join" not in p, name
        assert len([line for line in p.split("\n") if "FileScan" in line]) <= 2, name

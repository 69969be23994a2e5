"""Golden cases (state -> score), worked out by hand from the scoring rules."""

import pytest

from learner_scoring.config import DEFAULT_CONFIG, f32
from learner_scoring.functions.scoring import with_metrics, with_score

PACE4 = DEFAULT_CONFIG.with_thresholds(expected_questions_per_minute=4.0, tolerance_percent=0.5)
YELLOW7 = DEFAULT_CONFIG.with_thresholds(yellow=0.7)

# id, total, correct, n_times, total_time, first, last, cfg, acc, dwell, pacing, score, trend, alert
CASES = [
    ("GC01", 0, 0, 0, 0, 1000, 2000, None, 0.0, 1.0, 1.0, 0.6000000238418579, "STABLE", False),
    ("GC02", 0, 0, 0, 0, None, None, None, 0.0, 1.0, 1.0, 0.6000000238418579, "STABLE", False),
    ("GC03", 1, 1, 1, 8500, 0, 0, None, 1.0, 1.0, 0.7, 0.9100000262260437, "RISING", False),
    ("GC04", 1, 1, 0, 0, 0, 0, None, 1.0, 0.5, 0.7, 0.7600000202655792, "STABLE", False),
    ("GC05", 1, 0, 1, 8500, 0, 0, None, 0.0, 1.0, 0.7, 0.5100000202655792, "STABLE", False),
    ("GC06", 1, 0, 1, 4999, 0, 0, None, 0.0, 0.5, 0.7, 0.36000001430511475, "CRITICAL", True),
    ("GC07", 1, 0, 1, 15001, 0, 0, None, 0.0, 0.3, 0.7, 0.30000001192092896, "CRITICAL", True),
    ("GC08", 1, 1, 1, 5000, 0, 0, None, 1.0, 1.0, 0.7, 0.9100000262260437, "RISING", False),
    ("GC09", 1, 1, 1, 15000, 0, 0, None, 1.0, 1.0, 0.7, 0.9100000262260437, "RISING", False),
    ("GC10", 4, 1, 4, 64000, 0, 40000, None, 0.25, 0.3, 0.7, 0.4000000134110451, "STABLE", False),
    ("GC11", 4, 3, 4, 36000, 0, 45000, None, 0.75, 1.0, 0.7, 0.8100000247359276, "RISING", False),
    ("GC12", 10, 7, 10, 90000, 0, 50000, None, 0.7, 1.0, 0.7, 0.7900000244379044, "STABLE", False),
    ("GC13", 4, 4, 4, 36000, 0, 60000, PACE4, 1.0, 1.0, 1.0, 1.0, "RISING", False),
    ("GC14", 0, 0, 0, 0, 0, 10, YELLOW7, 0.0, 1.0, 1.0, 0.6000000238418579, "DECLINING", False),
]

DDL = (
    "id string, total_answers bigint, correct_answers bigint, n_time_values bigint, total_time_spent bigint, "
    "first_event_ms bigint, last_event_ms bigint, consecutive_incorrect bigint, rapid_submissions bigint"
)


def test_float_widening():
    assert f32(0.4) == 0.4000000059604645
    assert f32(0.3) == 0.30000001192092896
    lo, hi = DEFAULT_CONFIG.pacing_bounds
    assert lo == 0.3999999985098839 and hi == 0.6000000014901161


@pytest.mark.parametrize("case", CASES, ids=[c[0] for c in CASES])
def test_golden(spark, case):
    cid, total, correct, nt, tt, first, last, cfg, acc, dwell, pacing, score, trend, alert = case
    state = spark.createDataFrame([(cid, total, correct, nt, tt, first, last, 0, 0)], DDL)
    row = with_score(with_metrics(state), cfg or DEFAULT_CONFIG).collect()[0]
    assert row.accuracy_score == acc
    assert row.dwell_score == dwell
    assert row.pacing_score == pacing
    assert row.attention_score is None
    assert row.score == score
    assert row.trend == trend
    assert row.alert_threshold_crossed is alert


def test_exactly_seventy_percent_is_not_rising(spark):
    # rate > 0.7 is strict (GC12 would otherwise be RISING with a higher score)
    state = spark.createDataFrame([("x", 10, 7, 10, 90000, 0, 0, 0, 0)], DDL)
    row = with_score(with_metrics(state)).collect()[0]
    assert row.correctness_rate == 0.7 and row.trend == "STABLE"


def test_metrics_flags(spark):
    rows = [
        ("rapid", 5, 1, 5, 10000, 0, 1000, 3, 2),
        ("slow", 4, 1, 4, 84000, 0, 1000, 0, 0),
    ]
    out = {r.id: r for r in with_metrics(spark.createDataFrame(rows, DDL)).collect()}
    assert out["rapid"].rapid_incorrect_pattern and not out["rapid"].struggling_pattern
    assert out["slow"].struggling_pattern and not out["slow"].rapid_incorrect_pattern
    assert out["slow"].average_time_spent == 21000.0
    assert out["rapid"].questions_per_minute == 5 / (1000 / 60000.0)
    assert out["rapid"].active_time_ms == 1000

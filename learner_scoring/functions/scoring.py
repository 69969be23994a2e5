"""Window metrics (correctness, timing, pace, pattern flags) and the score.

Every function maps state columns to a Column, so the same code scores a
static frame, a streaming aggregate or a running changelog. Nothing leaves
the JVM: all branches are ``when`` chains inside one projection.

State columns read (names of the window state frame):
``total_answers, correct_answers, n_time_values, total_time_spent,
first_event_ms, last_event_ms, consecutive_incorrect, rapid_submissions``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learner_scoring import config as C
from learner_scoring.config import DEFAULT_CONFIG, ScoringConfig, dlit
from learner_scoring.functions import column_cache


def _c(name: str) -> Column:
    return F.col(name)


# ---------------------------------------------------------------- metrics (F)


def correctness_rate(total: Column | None = None, correct: Column | None = None) -> Column:
    """F1: correct / total as double, 0.0 without answers."""
    total = _c("total_answers") if total is None else total
    correct = _c("correct_answers") if correct is None else correct
    return F.when(total == 0, dlit(0.0)).otherwise(correct.cast("double") / total.cast("double"))


def average_time_spent(n_times: Column | None = None, total_time: Column | None = None) -> Column:
    """F2: total time / number of non-null time values, 0.0 when there are none."""
    n_times = _c("n_time_values") if n_times is None else n_times
    total_time = _c("total_time_spent") if total_time is None else total_time
    return F.when(n_times == 0, dlit(0.0)).otherwise(total_time.cast("double") / n_times.cast("double"))


def questions_per_minute(
    total: Column | None = None, first_ms: Column | None = None, last_ms: Column | None = None
) -> Column:
    """answers per minute of event-time span; 0.0 without a span."""
    total = _c("total_answers") if total is None else total
    first_ms = _c("first_event_ms") if first_ms is None else first_ms
    last_ms = _c("last_event_ms") if last_ms is None else last_ms
    duration = last_ms - first_ms
    minutes = duration.cast("double") / dlit(60000.0)
    return (
        F.when(first_ms.isNull() | last_ms.isNull(), dlit(0.0))
        .when(duration == 0, dlit(0.0))
        .otherwise(total.cast("double") / minutes)
    )


def rapid_incorrect_pattern() -> Column:
    """a streak of wrong answers given in quick succession."""
    return (_c("consecutive_incorrect") >= C.RAPID_PATTERN_MIN_CONSECUTIVE) & (
        _c("rapid_submissions") >= C.RAPID_PATTERN_MIN_RAPID
    )


def struggling_pattern() -> Column:
    """slow and mostly wrong."""
    return (average_time_spent() > dlit(C.STRUGGLING_PATTERN_AVG_MS)) & (
        correctness_rate() < dlit(C.STRUGGLING_PATTERN_MAX_RATE)
    )


def active_time_ms() -> Column:
    """event-time span, 0 when the window saw no quiz or session event."""
    return F.coalesce(_c("last_event_ms") - _c("first_event_ms"), F.lit(0).cast("bigint"))


@column_cache
def metric_columns(order: bool = True) -> tuple[Column, ...]:
    pattern = (rapid_incorrect_pattern().alias("rapid_incorrect_pattern"),) if order else ()
    return (
        correctness_rate().alias("correctness_rate"),
        average_time_spent().alias("average_time_spent"),
        questions_per_minute().alias("questions_per_minute"),
        *pattern,
        struggling_pattern().alias("struggling_pattern"),
        active_time_ms().alias("active_time_ms"),
    )


def with_metrics(state: DataFrame) -> DataFrame:
    """Append F1-F5 and F7 (F6 comes with the skill map, see fold); F4 where the state has the order fields."""
    return state.select("*", *metric_columns("consecutive_incorrect" in state.columns))


# ---------------------------------------------------------------- scoring (G)


def accuracy_score() -> Column:
    """G1."""
    return F.when(_c("total_answers") == 0, dlit(0.0)).otherwise(correctness_rate())


def dwell_score(cfg: ScoringConfig = DEFAULT_CONFIG) -> Column:
    """Neutral without answers; struggling tested before rushing."""
    avg = average_time_spent()
    t = cfg.thresholds
    return (
        F.when(_c("total_answers") == 0, dlit(1.0))
        .when(avg > dlit(t.struggling_ms), dlit(0.3))
        .when(avg < dlit(t.rushing_ms), dlit(0.5))
        .otherwise(dlit(1.0))
    )


def pacing_score(cfg: ScoringConfig = DEFAULT_CONFIG) -> Column:
    """1.0 inside the inclusive tolerance band around the expected pace."""
    lower, upper = cfg.pacing_bounds
    qpm = questions_per_minute()
    return (
        F.when(_c("total_answers") == 0, dlit(1.0))
        .when((qpm >= dlit(lower)) & (qpm <= dlit(upper)), dlit(1.0))
        .otherwise(dlit(0.7))
    )


def composite_score(acc: Column, dwell: Column, pacing: Column, cfg: ScoringConfig = DEFAULT_CONFIG) -> Column:
    """G5 + G6 (identity) + G7: weighted sum, left to right, clamped to [0, 1]."""
    raw = acc * dlit(cfg.w_accuracy) + dwell * dlit(cfg.w_dwell) + pacing * dlit(cfg.w_pacing)
    return F.greatest(dlit(0.0), F.least(dlit(1.0), raw))


def trend(score: Column, cfg: ScoringConfig = DEFAULT_CONFIG) -> Column:
    """CRITICAL / DECLINING / RISING / STABLE."""
    avg = average_time_spent()
    t = cfg.thresholds
    healthy_pace = (avg >= dlit(t.rushing_ms)) & (avg <= dlit(t.struggling_ms))
    rising = (correctness_rate() > dlit(C.RISING_MIN_RATE)) & healthy_pace & (score >= dlit(C.RISING_MIN_SCORE))
    return (
        F.when(score < dlit(cfg.alert), F.lit("CRITICAL"))
        .when(score < dlit(cfg.yellow), F.lit("DECLINING"))
        .when(rising, F.lit("RISING"))
        .otherwise(F.lit("STABLE"))
    )


def zone(score: Column, cfg: ScoringConfig = DEFAULT_CONFIG) -> Column:
    """Green / yellow / alert band (documented, not used by the trend)."""
    return (
        F.when(score >= dlit(cfg.green), F.lit("GREEN"))
        .when(score >= dlit(cfg.yellow), F.lit("YELLOW"))
        .otherwise(F.lit("ALERT"))
    )


SCORE_COLUMNS = [
    "accuracy_score",
    "dwell_score",
    "pacing_score",
    "attention_score",
    "score",
    "trend",
    "alert_threshold_crossed",
]


def with_score(state: DataFrame, cfg: ScoringConfig = DEFAULT_CONFIG) -> DataFrame:
    """G1-G9 as flat columns appended to a window-state frame.

    Two projections: components first, then score/trend/alert on top of them,
    so the component expressions are evaluated once per row.
    """
    comp, score, final = _score_columns(cfg)
    return state.select("*", *comp).select("*", score).select("*", *final)


@column_cache
def _score_columns(cfg: ScoringConfig) -> tuple:
    comp = (
        accuracy_score().alias("accuracy_score"),
        dwell_score(cfg).alias("dwell_score"),
        pacing_score(cfg).alias("pacing_score"),
        F.lit(None).cast("double").alias("attention_score"),
    )
    score = composite_score(_c("accuracy_score"), _c("dwell_score"), _c("pacing_score"), cfg).alias("score")
    final = (
        trend(_c("score"), cfg).alias("trend"),
        (_c("score") < dlit(cfg.alert)).alias("alert_threshold_crossed"),
    )
    return comp, score, final


def score_record(envelope: Column) -> Column:
    """The nested score record (envelope, score, components, trend, alert)."""
    return F.struct(
        envelope.alias("envelope"),
        _c("score").alias("score"),
        F.struct(
            _c("accuracy_score").alias("accuracyScore"),
            _c("dwell_score").alias("dwellScore"),
            _c("pacing_score").alias("pacingScore"),
            _c("attention_score").alias("attentionScore"),
        ).alias("scoreComponents"),
        _c("trend").alias("trend"),
        _c("alert_threshold_crossed").alias("alertThresholdCrossed"),
    )


def score_envelope(cfg: ScoringConfig = DEFAULT_CONFIG, event_id: Column | None = None) -> Column:
    """Outgoing envelope. Random UUID unless a deterministic id is given."""
    return F.struct(
        (F.expr("uuid()") if event_id is None else event_id).alias("id"),
        F.lit(C.SCORE_EVENT_TYPE).alias("type"),
        F.lit(cfg.application_name).alias("source"),
        F.lit(C.SPEC_VERSION).alias("specversion"),
        F.current_timestamp().alias("timestamp"),
        _c("student_id").alias("studentId"),
        _c("session_id").alias("sessionId"),
        F.lit(None).cast("string").alias("correlationId"),
    )


def deterministic_score_id(batch_id: Column | None = None) -> Column:
    """G13 deterministic mode: same (student, window[, batch]) -> same id."""
    parts = [_c("student_id"), _c("window_start_ms").cast("string")]
    if batch_id is not None:
        parts.append(batch_id.cast("string"))
    return F.sha2(F.concat_ws(":", *parts), 256)

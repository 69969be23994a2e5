"""The full changelog — the state and score after every input record.

The reference emits a new score whenever a window's state changes (its cache
merges updates between commits). Without merging, that is one row per record:
running aggregates over (student, window) in arrival order.

Usual windows are one window function over (student, window): one shuffle of
the records, and no join. A window too long for a task is cut into arrival
buckets (``sequence.split_hot``) and built in two levels:

1. rows, per (group, arrival bucket): running values inside the bucket;
2. buckets, per group: a small summary row per bucket and its exclusive
   prefix over earlier buckets (sums, min/max, the last answer time before
   the bucket, the wrong-answer streak carried into the bucket);
3. state after a row = prefix of earlier buckets (+) running value in its own
   bucket.

The summary has one row per (cut window, bucket).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from learner_scoring import config as C
from learner_scoring.config import DEFAULT_CONFIG, ScoringConfig
from learner_scoring.functions import column_cache
from learner_scoring.functions.scoring import with_metrics, with_score
from learner_scoring.operators.partials import GROUP
from learner_scoring.operators.sequence import BUCKET as B
from learner_scoring.operators.sequence import HOT_ROWS, SAMPLE_EVERY, SEQ, both, split_hot


@column_cache
def _row_columns(part: tuple[str, ...]) -> tuple[tuple[Column, ...], tuple[Column, ...]]:
    upto = Window.partitionBy(*part).orderBy(SEQ).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*part).orderBy(SEQ).rowsBetween(Window.unboundedPreceding, -1)
    first = Window.partitionBy(*part).orderBy(SEQ).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    q = F.col("is_quiz")
    ok = F.coalesce(F.col("is_correct"), F.lit(False))
    routed = q | F.col("is_session")
    prev_answer_ms = F.last(F.when(q, F.col("event_ms")), ignorenulls=True).over(before)
    step1 = (
        F.first("session_id").over(first).alias("_b_session"),
        F.count_if(q).over(upto).alias("_r_total"),
        F.count_if(q & ok).over(upto).alias("_r_correct"),
        F.count_if(q & ~ok).over(upto).alias("_r_incorrect"),
        F.count(F.when(q, F.col("time_spent_ms"))).over(upto).alias("_r_nt"),
        F.coalesce(F.sum(F.when(q, F.col("time_spent_ms"))).over(upto), F.lit(0)).cast("bigint").alias("_r_tt"),
        F.min(F.when(routed, F.col("event_ms"))).over(upto).alias("_r_first"),
        F.max(F.when(routed, F.col("event_ms"))).over(upto).alias("_r_last"),
        (q & ((F.col("event_ms") - prev_answer_ms) < C.RAPID_SUBMISSION_MS)).alias("_rapid"),
    )
    since_correct = Window.partitionBy(*part, "_r_correct").orderBy(SEQ).rowsBetween(Window.unboundedPreceding, 0)
    step2 = (
        F.count_if(F.col("_rapid")).over(upto).alias("_r_rapid"),
        F.count_if(q & ~ok).over(since_correct).alias("_r_streak"),
    )
    return step1, step2


_PREFIX_KEEP = ("_p_total", "_p_correct", "_p_incorrect", "_p_nt", "_p_tt", "_p_first", "_p_last", "_edge", "_g_session")


@column_cache
def _bucket_columns() -> tuple[tuple[Column, ...], tuple[Column, ...], tuple[Column, ...]]:
    q = F.col("is_quiz")
    ok = F.coalesce(F.col("is_correct"), F.lit(False))
    answer_seq = F.when(q, F.col(SEQ))
    # bucket totals = the running values at the bucket's last row
    summary = (
        F.max_by("_r_total", SEQ).alias("_n_total"),
        F.max_by("_r_correct", SEQ).alias("_n_correct"),
        F.max_by("_r_incorrect", SEQ).alias("_n_incorrect"),
        F.max_by("_r_nt", SEQ).alias("_n_nt"),
        F.max_by("_r_tt", SEQ).alias("_n_tt"),
        F.min("_r_first").alias("_n_first"),
        F.max("_r_last").alias("_n_last"),
        F.max_by("_r_rapid", SEQ).alias("_n_rapid"),
        F.min_by(F.when(q, F.col("event_ms")), answer_seq).alias("_first_answer_ms"),
        F.max_by(F.when(q, F.col("event_ms")), answer_seq).alias("_last_answer_ms"),
        F.max((q & ok).cast("int")).alias("_has_ok"),
        F.max_by("_r_streak", SEQ).alias("_trailing"),
    )
    w = Window.partitionBy(*GROUP).orderBy(B)
    prior = w.rowsBetween(Window.unboundedPreceding, -1)
    inc_upto = F.sum("_n_incorrect").over(w.rowsBetween(Window.unboundedPreceding, 0))
    prev_answer = F.last("_last_answer_ms", ignorenulls=True).over(prior)
    edge = F.coalesce((F.col("_first_answer_ms") - prev_answer) < C.RAPID_SUBMISSION_MS, F.lit(False))
    step_a = (
        F.coalesce(F.sum("_n_total").over(prior), F.lit(0)).alias("_p_total"),
        F.coalesce(F.sum("_n_correct").over(prior), F.lit(0)).alias("_p_correct"),
        F.coalesce(F.sum("_n_incorrect").over(prior), F.lit(0)).alias("_p_incorrect"),
        F.coalesce(F.sum("_n_nt").over(prior), F.lit(0)).alias("_p_nt"),
        F.coalesce(F.sum("_n_tt").over(prior), F.lit(0)).alias("_p_tt"),
        F.min("_n_first").over(prior).alias("_p_first"),
        F.max("_n_last").over(prior).alias("_p_last"),
        edge.cast("int").alias("_edge"),
        inc_upto.alias("_inc_upto"),
        F.first("_b_session").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_g_session"),
    )
    # streak entering a bucket: trailing run of the last earlier bucket with a
    # correct answer plus every wrong answer in the buckets after it
    last_ok = F.last(F.when(F.col("_has_ok") == 1, F.struct("_trailing", "_inc_upto")), ignorenulls=True).over(prior)
    inc_before = F.coalesce(F.col("_inc_upto") - F.col("_n_incorrect"), F.lit(0))
    step_b = (
        F.coalesce(F.sum(F.col("_n_rapid") + F.col("_edge")).over(prior), F.lit(0)).alias("_p_rapid"),
        F.when(last_ok.isNull(), inc_before)
        .otherwise(last_ok["_trailing"] + inc_before - last_ok["_inc_upto"])
        .alias("_carry"),
    )
    return summary, step_a, step_b


def _rows(events: DataFrame, *part: str) -> DataFrame:
    step1, step2 = _row_columns(part)
    return events.select("*", *step1).select("*", *step2).drop("_rapid")


def _state_columns(events: DataFrame, prefix: bool) -> list[Column]:
    """The state after a row: its running values, after a prefix of earlier buckets if there are any."""
    c = F.col

    def plus(name: str) -> Column:
        return (c(f"_p_{name}") + c(f"_r_{name}") if prefix else c(f"_r_{name}")).cast("bigint")

    seen_answer = c("_r_total") > 0
    rapid = plus("rapid")
    streak = c("_r_streak")
    if prefix:
        rapid = rapid + F.when(seen_answer, c("_edge")).otherwise(0)
        streak = F.when(c("_r_correct") > 0, streak).otherwise(c("_carry") + streak)
    return [
        *[c(x) for x in events.columns if x != B],
        c("_g_session" if prefix else "_b_session").alias("state_session_id"),
        plus("total").alias("total_answers"),
        plus("correct").alias("correct_answers"),
        plus("incorrect").alias("incorrect_answers"),
        plus("nt").alias("n_time_values"),
        plus("tt").alias("total_time_spent"),
        (F.least("_p_first", "_r_first") if prefix else c("_r_first")).alias("first_event_ms"),
        (F.greatest("_p_last", "_r_last") if prefix else c("_r_last")).alias("last_event_ms"),
        rapid.cast("bigint").alias("rapid_submissions"),
        streak.cast("bigint").alias("consecutive_incorrect"),
    ]


def running_state(
    events: DataFrame,
    seq_bucket: int | None = None,
    cfg: ScoringConfig = DEFAULT_CONFIG,
    hot_rows: int = HOT_ROWS,
    every: int = SAMPLE_EVERY,
) -> DataFrame:
    """State after each record (windowed, valid events in, one row per record out)."""
    usual, cut = split_hot(events, GROUP, cfg.window.duration_ms, seq_bucket, hot_rows, every)
    if usual is not None:
        usual = _rows(usual, *GROUP).select(*_state_columns(events, prefix=False))
    if cut is not None:
        rows = _rows(cut, *GROUP, B)
        summary_aggs, step_a, step_b = _bucket_columns()
        # _b_session is constant per (group, bucket): a grouping key, not a buffer
        buckets = rows.groupBy(*GROUP, B, "_b_session").agg(*summary_aggs)
        prefix = buckets.select("*", *step_a).select(*GROUP, B, *_PREFIX_KEEP, *step_b)
        cut = rows.join(prefix, [*GROUP, B]).select(*_state_columns(events, prefix=True))
    return both(usual, cut)


def score_changelog(
    events: DataFrame,
    cfg: ScoringConfig = DEFAULT_CONFIG,
    seq_bucket: int | None = None,
    hot_rows: int = HOT_ROWS,
    every: int = SAMPLE_EVERY,
) -> DataFrame:
    """Running state scored after every record."""
    return with_score(with_metrics(running_state(events, seq_bucket, cfg, hot_rows, every)), cfg)

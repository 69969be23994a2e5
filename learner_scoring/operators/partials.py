"""Mergeable partial states of a window.

A partial is the state of a run of a window's records in arrival order: counts
and sums, time bounds, the first session, and what the order-dependent fields
need at the run's edges (first and last answer time, whether all answers are
wrong). Two neighbouring runs merge into the partial of both, in any grouping,
so partials can be stored per slice and merged later:

* rapid submissions: both counts, plus one if the gap across the border is
  short;
* trailing wrong answers: the later run's, and the earlier run's as well where
  the later one has no correct answer;
* the first session is the earlier run's; all else adds up.

``fold`` makes partials of rows, ``merge`` makes partials of partials, and
``state`` reads the window state off a partial.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from learner_scoring import config as C
from learner_scoring.config import DEFAULT_CONFIG, ScoringConfig
from learner_scoring.functions import column_cache
from learner_scoring.operators.sequence import BUCKET, HOT_ROWS, SAMPLE_EVERY, SEQ, both, split_hot

GROUP = ["student_id", "window_start_ms"]
#: What two partials simply add up.
SUMS = (
    "total_answers", "correct_answers", "incorrect_answers", "n_time_values", "total_time_spent", "navigation_events",
    "pause_events", "resume_events", "total_dwell_time", "total_hints_used",
)
#: The run's first record and session, its first and last answer, and whether no answer is correct.
EDGES = ("lo", "session_id", "first_answer_ms", "last_answer_ms", "all_wrong")
COLUMNS = (*GROUP, *EDGES, *SUMS, "first_event_ms", "last_event_ms", "rapid_submissions", "consecutive_incorrect")
#: Distinct words of a run: pages and skill tags with their counts.
WORDS = ("pages_visited", "skill_tag_attempts")


def _q() -> Column:
    return F.col("is_quiz")


def _ok() -> Column:
    return F.coalesce(F.col("is_correct"), F.lit(False))


def _long(c: Column) -> Column:
    return F.coalesce(c, F.lit(0)).cast("bigint")


@column_cache
def _row_columns(part: tuple[str, ...]) -> tuple[tuple[Column, ...], tuple[Column, ...]]:
    """What a row needs to know of its run: constants of the run, and the answer before it."""
    order = Window.partitionBy(*part).orderBy(SEQ)
    run = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    answer_ms = F.when(_q(), F.col("event_ms"))
    seen = (
        F.first(SEQ).over(run).alias("lo"),
        F.first("session_id").over(run).alias("_session"),
        F.first(answer_ms, ignorenulls=True).over(run).alias("first_answer_ms"),
        F.last(answer_ms, ignorenulls=True).over(run).alias("last_answer_ms"),
        F.last(F.when(_q() & _ok(), F.col(SEQ)), ignorenulls=True).over(run).alias("_last_ok"),
        F.last(answer_ms, ignorenulls=True).over(before).alias("_answer_before"),
    )
    none_ok = F.col("_last_ok").isNull()
    flags = (
        none_ok.alias("all_wrong"),
        (_q() & ((F.col("event_ms") - F.col("_answer_before")) < C.RAPID_SUBMISSION_MS)).alias("_rapid"),
        (_q() & ~_ok() & (none_ok | (F.col(SEQ) > F.col("_last_ok")))).alias("_trailing"),
    )
    return seen, flags


@column_cache
def _fold_aggregates() -> tuple[Column, ...]:
    q = _q()
    routed = q | F.col("is_session")

    def kind(name: str) -> Column:
        return F.col("is_session") & (F.col("session_event_type") == name)

    return (
        F.count_if(q).alias("total_answers"),
        F.count_if(q & _ok()).alias("correct_answers"),
        F.count_if(q & ~_ok()).alias("incorrect_answers"),
        F.count(F.when(q, F.col("time_spent_ms"))).alias("n_time_values"),
        _long(F.sum(F.when(q, F.col("time_spent_ms")))).alias("total_time_spent"),
        F.count_if(kind("NAVIGATION")).alias("navigation_events"),
        F.count_if(kind("PAUSED")).alias("pause_events"),
        F.count_if(kind("RESUMED")).alias("resume_events"),
        _long(F.sum(F.when(kind("DWELL"), F.col("dwell_time_ms")))).alias("total_dwell_time"),
        _long(F.sum(F.when(q, F.col("hints_used")))).alias("total_hints_used"),
        F.min(F.when(routed, F.col("event_ms"))).alias("first_event_ms"),
        F.max(F.when(routed, F.col("event_ms"))).alias("last_event_ms"),
        F.count_if("_rapid").alias("rapid_submissions"),
        F.count_if("_trailing").alias("consecutive_incorrect"),
    )


@column_cache
def _sum_aggregates() -> tuple[Column, ...]:
    return (
        *[F.sum(c).cast("bigint").alias(c) for c in SUMS],
        F.min("first_event_ms").alias("first_event_ms"),
        F.max("last_event_ms").alias("last_event_ms"),
    )


def fold(events: DataFrame, part: list[str], words: bool = False) -> DataFrame:
    """One partial per ``part`` (window, or window and slice) from windowed events.

    One shuffle on ``part``: the run's rows are sorted once, its constants come
    from that order and are grouping keys of the aggregate, which then holds
    numbers only. With ``words``, rows are counted per skill tag and page first,
    in the same place, so only distinct words of a run are collected.
    """
    seen, flags = _row_columns(tuple(part))
    rows = events.select("*", *seen).select("*", *flags)
    keys = [*part, "lo", F.col("_session").alias("session_id"), "first_answer_ms", "last_answer_ms", "all_wrong"]
    if not words:
        return rows.groupBy(*keys).agg(*_fold_aggregates()).select(*_order(part))
    page = F.when(F.col("is_session") & (F.col("session_event_type") == "NAVIGATION"), F.col("page_id"))
    per_word = rows.groupBy(*keys, F.when(_q(), F.col("skill_tag")).alias("skill_tag"), page.alias("_page")).agg(*_fold_aggregates())
    tags = F.filter(F.collect_list(F.struct("skill_tag", "total_answers")), lambda t: t["skill_tag"].isNotNull())
    folded = per_word.groupBy(*part, *EDGES).agg(
        *_sum_aggregates(),
        F.sum("rapid_submissions").alias("rapid_submissions"),
        F.sum("consecutive_incorrect").alias("consecutive_incorrect"),
        F.sort_array(F.collect_set("_page")).alias("pages_visited"),
        F.map_from_entries(tags).alias("skill_tag_attempts"),
    )
    return folded.select(*_order(part), *WORDS)


def _order(part: list[str]) -> list[str]:
    return [*part, *[c for c in COLUMNS if c not in part]]


@column_cache
def _merge_columns(part: tuple[str, ...]) -> tuple[tuple[Column, ...], tuple[Column, ...]]:
    order = Window.partitionBy(*part).orderBy("lo")
    run = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    gap = F.col("first_answer_ms") - F.last("last_answer_ms", ignorenulls=True).over(before)
    seen = (
        F.first("lo").over(run).alias("_lo"),
        F.first("session_id").over(run).alias("_session"),
        F.first("first_answer_ms", ignorenulls=True).over(run).alias("_first"),
        F.last("last_answer_ms", ignorenulls=True).over(run).alias("_last"),
        F.last(F.when(~F.col("all_wrong"), F.col("lo")), ignorenulls=True).over(run).alias("_ok_lo"),
        F.coalesce(gap < C.RAPID_SUBMISSION_MS, F.lit(False)).cast("int").alias("_edge"),
    )
    ok_lo = F.col("_ok_lo")
    aggregates = (
        *_sum_aggregates(),
        F.sum(F.col("rapid_submissions") + F.col("_edge")).cast("bigint").alias("rapid_submissions"),
        F.sum(F.when(ok_lo.isNull() | (F.col("lo") >= ok_lo), F.col("consecutive_incorrect")).otherwise(0))
        .cast("bigint")
        .alias("consecutive_incorrect"),
    )
    return seen, aggregates


def merge(partials: DataFrame, part: list[str] | None = None) -> DataFrame:
    """One partial per ``part`` from partials of neighbouring runs, in the order of their first records.

    ``part`` is the window, or the window and a coarser slice. Runs must not
    interleave within a window. Only partials are shuffled, and words are added up
    per word before they are collected.
    """
    part = list(part or GROUP)
    seen, aggregates = _merge_columns(tuple(part))
    rows = partials.select("*", *seen).drop("session_id", "first_answer_ms", "last_answer_ms", "all_wrong")
    keys = [
        *part, F.col("_lo").alias("first_lo"), F.col("_session").alias("session_id"), F.col("_first").alias("first_answer_ms"),
        F.col("_last").alias("last_answer_ms"), F.col("_ok_lo").isNull().alias("all_wrong"),
    ]
    merged = rows.groupBy(*keys, "_ok_lo").agg(*aggregates).withColumnRenamed("first_lo", "lo").select(*_order(part))
    return merged if "pages_visited" not in partials.columns else _with_words(merged, partials, part)


def _with_words(merged: DataFrame, partials: DataFrame, part: list[str]) -> DataFrame:
    pages = F.transform("pages_visited", lambda p: F.struct(F.lit("page").alias("kind"), p.alias("word"), F.lit(0).cast("bigint").alias("n")))
    tags = F.transform(
        F.map_entries("skill_tag_attempts"), lambda e: F.struct(F.lit("tag").alias("kind"), e["key"].alias("word"), e["value"].alias("n"))
    )
    words = partials.select(*part, F.explode(F.concat(pages, tags)).alias("w")).groupBy(*part, "w.kind", "w.word").agg(F.sum("w.n").alias("n"))
    words = words.groupBy(*part).agg(
        F.sort_array(F.collect_list(F.when(F.col("kind") == "page", F.col("word")))).alias("pages_visited"),
        F.map_from_entries(F.collect_list(F.when(F.col("kind") == "tag", F.struct("word", "n")))).alias("skill_tag_attempts"),
    )
    empty = {
        "pages_visited": F.array().cast("array<string>"),
        "skill_tag_attempts": F.create_map().cast("map<string,bigint>"),
    }
    out = merged.join(words, part, "left")
    return out.select(*_order(part), *[F.coalesce(c, empty[c]).alias(c) for c in WORDS])


def window_partials(
    events: DataFrame,
    words: bool = False,
    cfg: ScoringConfig = DEFAULT_CONFIG,
    seq_bucket: int | None = None,
    hot_rows: int = HOT_ROWS,
    every: int = SAMPLE_EVERY,
    lazy: bool = False,
) -> DataFrame:
    """One partial per window: usual windows in one fold, cut windows per bucket and merged."""
    usual, cut = split_hot(events, GROUP, cfg.window.duration_ms, seq_bucket, hot_rows, every, lazy)
    if usual is not None:
        usual = fold(usual, GROUP, words)
    if cut is not None:
        cut = merge(fold(cut, [*GROUP, BUCKET], words).drop(BUCKET))
    return both(usual, cut)


def state(partials: DataFrame, cfg: ScoringConfig = DEFAULT_CONFIG) -> DataFrame:
    """The window state of partials that cover their windows, with the columns of ``fold.window_state``."""
    out = partials.drop("lo", "first_answer_ms", "last_answer_ms", "all_wrong")
    if "skill_tag_attempts" in out.columns:
        out = out.withColumn("unique_skills_attempted", F.size("skill_tag_attempts").cast("bigint"))
    return out.withColumn("window_end_ms", F.col("window_start_ms") + F.lit(cfg.window.duration_ms))

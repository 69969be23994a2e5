"""The windowed fold: one state row per (student, window).

Two plans compute the same state:

* ``window_state`` (batch, the scalable form). With ``one_pass`` all fields come
  from one shuffle of the records, as mergeable partials (``operators.partials``).
  Without it, order-free fields are plain aggregates with map-side combination,
  and the arrival-order fields (E5, E9) and skills are joined to them; Catalyst
  drops the joins that the output does not need, which leaves scores one shuffle
  of combined rows. No group is ever collected into one array.
* ``window_state_lists`` (static or streaming). One aggregate, arrival-order
  fields from a sorted ``collect_list`` of three small fields per answer and
  higher-order functions. This is the shape Structured Streaming can keep in
  its state store; the list is bounded by the answers of one student in one
  window, the same state the reference keeps per window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learner_scoring.config import DEFAULT_CONFIG, ScoringConfig
from learner_scoring.functions import arrays as A
from learner_scoring.functions import column_cache
from learner_scoring.operators.partials import GROUP, window_partials
from learner_scoring.operators.partials import state as partial_state
from learner_scoring.operators.sequence import HOT_ROWS, SAMPLE_EVERY
from learner_scoring.operators.windows import assign_window


def _ok() -> Column:
    return F.coalesce(F.col("is_correct"), F.lit(False))


def _q() -> Column:
    return F.col("is_quiz")


def _s(kind: str) -> Column:
    return F.col("is_session") & (F.col("session_event_type") == kind)


@column_cache
def order_free_aggregates() -> tuple[Column, ...]:
    """E1-E4, E7 (count), E8, E11-E18: aggregates that ignore arrival order
    except through ``min_by`` (E1), which is itself mergeable."""
    q = _q()
    ok = _ok()
    routed = q | F.col("is_session")
    return (
        F.min_by("session_id", "arrival_seq").alias("session_id"),
        F.count_if(q).alias("total_answers"),
        F.count_if(q & ok).alias("correct_answers"),
        F.count_if(q & ~ok).alias("incorrect_answers"),
        F.count(F.when(q, F.col("time_spent_ms"))).alias("n_time_values"),
        F.coalesce(F.sum(F.when(q, F.col("time_spent_ms"))), F.lit(0)).cast("bigint").alias("total_time_spent"),
        F.count_if(_s("NAVIGATION")).alias("navigation_events"),
        F.count_if(_s("PAUSED")).alias("pause_events"),
        F.count_if(_s("RESUMED")).alias("resume_events"),
        F.coalesce(F.sum(F.when(_s("DWELL"), F.col("dwell_time_ms"))), F.lit(0)).cast("bigint").alias(
            "total_dwell_time"
        ),
        F.sort_array(F.collect_set(F.when(_s("NAVIGATION"), F.col("page_id")))).alias("pages_visited"),
        F.min(F.when(routed, F.col("event_ms"))).alias("first_event_ms"),
        F.max(F.when(routed, F.col("event_ms"))).alias("last_event_ms"),
        F.coalesce(F.sum(F.when(q, F.col("hints_used"))), F.lit(0)).cast("bigint").alias("total_hints_used"),
    )


def order_metrics(
    events: DataFrame,
    seq_bucket: int | None = None,
    cfg: ScoringConfig = DEFAULT_CONFIG,
    hot_rows: int = HOT_ROWS,
    every: int = SAMPLE_EVERY,
    lazy: bool = False,
) -> DataFrame:
    """E5 + E9 per (student, window) with answers, from windowed events.

    * ``rapid_submissions``: adjacent answers whose event-time gap is below 5 s
      (negative gaps count).
    * ``consecutive_incorrect``: answers after the last correct one.
    * ``n_answers``: all answers.
    """
    answers = events.filter(_q()).withColumn("session_id", F.lit(None).cast("string"))  # not shuffled
    found = window_partials(answers, False, cfg, seq_bucket, hot_rows, every, lazy)
    return found.select(*GROUP, F.col("total_answers").alias("n_answers"), "rapid_submissions", "consecutive_incorrect")


def skill_attempts(events: DataFrame) -> DataFrame:
    """E10 + F6 per (student, window) that has at least one tagged answer.

    Two-level aggregation: counts per (student, window, tag) first, so the map
    per group only holds distinct tags (bounded by the tag vocabulary).
    """
    per_tag = (
        events.filter(_q() & F.col("skill_tag").isNotNull())
        .groupBy(*GROUP, "skill_tag")
        .agg(F.count(F.lit(1)).alias("attempts"))
    )
    return per_tag.groupBy(*GROUP).agg(
        F.map_from_entries(F.collect_list(F.struct("skill_tag", "attempts"))).alias("skill_tag_attempts"),
        F.count(F.lit(1)).alias("unique_skills_attempted"),
    )


def window_state(
    events: DataFrame,
    cfg: ScoringConfig = DEFAULT_CONFIG,
    with_skills: bool = False,
    seq_bucket: int | None = None,
    windowed: bool = False,
    one_pass: bool = False,
    order: bool = True,
) -> DataFrame:
    """Final state per (student, window) from valid classified events.

    ``windowed=True`` when ``events`` already carries ``window_start_ms``.
    Groups with no answers get 0 for E5/E9; with ``with_skills`` the state also
    carries the skill map (empty map when no tagged answer). ``one_pass`` computes
    all fields in one shuffle, for outputs that need the order fields; ``order=False``
    leaves E5/E9 out, for those that do not;
    ``seq_bucket`` cuts every window into buckets of that many offsets.
    """
    ev = events if windowed else assign_window(events, cfg)
    if one_pass:
        return partial_state(window_partials(ev, with_skills, cfg, seq_bucket), cfg)
    base = ev.groupBy(*GROUP).agg(*order_free_aggregates())
    state = base
    if order:
        metrics = order_metrics(ev, seq_bucket, cfg, lazy=True)
        # one row per group already; said once more, so that an unused join can go
        metrics = metrics.groupBy(*GROUP).agg(*[F.max(c).alias(c) for c in ("consecutive_incorrect", "rapid_submissions")])
        state = base.join(metrics, GROUP, "left").select(
            *[F.col(c) for c in base.columns],
            F.coalesce(F.col("consecutive_incorrect"), F.lit(0).cast("bigint")).alias("consecutive_incorrect"),
            F.coalesce(F.col("rapid_submissions"), F.lit(0).cast("bigint")).alias("rapid_submissions"),
        )
    if with_skills:
        skills = skill_attempts(ev)
        state = state.join(skills, GROUP, "left").select(
            *[F.col(c) for c in state.columns],
            F.coalesce(F.col("skill_tag_attempts"), F.create_map().cast("map<string,bigint>")).alias(
                "skill_tag_attempts"
            ),
            F.coalesce(F.col("unique_skills_attempted"), F.lit(0).cast("bigint")).alias("unique_skills_attempted"),
        )
    return state.withColumn("window_end_ms", F.col("window_start_ms") + F.lit(cfg.window.duration_ms))


def window_state_lists(events: DataFrame, cfg: ScoringConfig = DEFAULT_CONFIG) -> DataFrame:
    """Same state in one aggregate (streaming-capable); needs ``record_ts``.

    Groups on ``F.window(record_ts)`` so a watermark on ``record_ts`` bounds the
    state. Extra list columns: ``answer_timestamps`` (E6) and
    ``time_spent_values`` (E7), both in arrival order.
    """
    dur = f"{cfg.window.duration_seconds} seconds"
    q = _q()
    answer = F.struct(F.col("arrival_seq"), F.col("event_ms"), _ok().alias("ok"), F.col("time_spent_ms"))
    agg = events.groupBy(F.window("record_ts", dur).alias("w"), "student_id").agg(
        *order_free_aggregates(),
        F.array_sort(F.collect_list(F.when(q, answer))).alias("_answers"),
        F.collect_list(F.when(q, F.col("skill_tag"))).alias("_tags"),
    )
    ans = F.col("_answers")
    tags = A.tag_counts(F.col("_tags"))
    return agg.select(
        "student_id",
        F.unix_millis(F.col("w.start")).alias("window_start_ms"),
        F.unix_millis(F.col("w.end")).alias("window_end_ms"),
        *[c for c in agg.columns if c not in ("w", "student_id", "_answers", "_tags")],
        A.trailing_incorrect(ans).alias("consecutive_incorrect"),
        A.rapid_count(ans).alias("rapid_submissions"),
        tags.alias("skill_tag_attempts"),
        F.size(tags).cast("bigint").alias("unique_skills_attempted"),
        A.event_times(ans).alias("answer_timestamps"),
        F.filter(F.transform(ans, lambda x: x["time_spent_ms"]), lambda t: t.isNotNull()).alias(
            "time_spent_values"
        ),
    )

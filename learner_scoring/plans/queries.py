"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

All read the ``events`` table of ``sf_dir`` through the fixture adapter (two
topic frames) and run over the whole table. Output conventions, shared with
the DuckDB oracle: epoch-ms BIGINT instead of timestamps, integers as BIGINT,
lists/sets/maps as one canonical text, no random ids or wall-clock times.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learner_scoring.config import DEFAULT_CONFIG, TUNED_CONFIG, ScoringConfig
from learner_scoring.functions import arrays as A
from learner_scoring.functions.scoring import with_metrics
from learner_scoring.operators import enrich as E
from learner_scoring.operators import partials
from learner_scoring.operators.changelog import score_changelog
from learner_scoring.operators.fold import (
    GROUP,
    order_free_aggregates,
    order_metrics,
    skill_attempts,
    window_state,
)
from learner_scoring.operators.sequence import answer_positions
from learner_scoring.operators.windows import late_records
from learner_scoring.plans import monitor
from learner_scoring.plans.pipeline import build_scores, build_state, score_messages, windowed_events, with_zone
from learner_scoring.sources import decode
from learner_scoring.sources.fixture import framed_records, kafka_records, load_topics, staged_fixture
from learner_scoring.schemas import QUIZ_ANSWER, SESSION_EVENT

Query = Callable[[SparkSession, str], DataFrame]


def _events(spark: SparkSession, sf_dir: str, cfg: ScoringConfig = DEFAULT_CONFIG, late: str = "keep") -> DataFrame:
    q, s = load_topics(spark, sf_dir)
    return windowed_events(q, s, cfg, late)


def _bigint(*names: str) -> list:
    return [F.col(n).cast("bigint").alias(n) for n in names]


# ------------------------------------------------------------ sources (A)


def _decoded(spark: SparkSession, sf_dir: str):
    flat = staged_fixture(spark, sf_dir)
    quiz_rec, session_rec = kafka_records(flat, defects=True)
    quiz, quiz_bad = decode.split_decoded(decode.decode_json(quiz_rec, QUIZ_ANSWER))
    session, session_bad = decode.split_decoded(decode.decode_json(session_rec, SESSION_EVENT))
    return quiz, session, quiz_bad.unionByName(session_bad)


def q_decode_json_skip_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4/A5: decode JSON payloads of both topics; undecodable records skipped."""
    quiz, session, _ = _decoded(spark, sf_dir)
    u = E.merge_streams(E.flatten_quiz(quiz), E.flatten_session(session))
    return u.select(
        "event_id",
        "topic",
        "student_id",
        "session_id",
        "event_type",
        F.unix_millis("event_ts").alias("event_ms"),
        "question_id",
        "is_correct",
        "time_spent_ms",
        *_bigint("hints_used", "difficulty_level"),
        "skill_tag",
        "session_event_type",
        "page_id",
        "dwell_time_ms",
        *_bigint("kafka_partition"),
        "kafka_offset",
        F.unix_millis("record_ts").alias("record_ms"),
    )


def q_malformed_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 + B12: dead letters (undecodable payloads and rows the fold cannot take)."""
    quiz, session, bad_payloads = _decoded(spark, sf_dir)
    keys = ["record_key", "topic"]
    _, dead = E.split_valid(E.unified_events(quiz, session))
    guard = dead.select(*keys, "kafka_partition", "kafka_offset", F.col("invalid_reason").alias("reason"))
    allbad = guard.unionByName(bad_payloads.select(*keys, "kafka_partition", "kafka_offset", "reason"))
    return allbad.select(
        F.col("record_key").cast("bigint").alias("event_id"),
        "topic",
        *_bigint("kafka_partition"),
        "kafka_offset",
        "reason",
    )


# ------------------------------------------------------------ enrichment (B, C)


def q_enrich_quiz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quiz topic re-keyed by student and flattened."""
    quiz, _ = load_topics(spark, sf_dir)
    u = E.flatten_quiz(quiz)
    return u.select(
        "event_id",
        "student_id",
        "session_id",
        F.unix_millis("event_ts").alias("event_ms"),
        "event_type",
        "question_id",
        "is_correct",
        "time_spent_ms",
        *_bigint("hints_used", "difficulty_level"),
        "skill_tag",
        "source",
        F.unix_millis("record_ts").alias("record_ms"),
        *_bigint("kafka_partition"),
        "kafka_offset",
    )


def q_enrich_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session topic re-keyed by student and flattened."""
    _, session = load_topics(spark, sf_dir)
    u = E.flatten_session(session)
    return u.select(
        "event_id",
        "student_id",
        "session_id",
        F.unix_millis("event_ts").alias("event_ms"),
        "event_type",
        "session_event_type",
        "page_id",
        "dwell_time_ms",
        "source",
        F.unix_millis("record_ts").alias("record_ms"),
        *_bigint("kafka_partition"),
        "kafka_offset",
    )


def q_merge_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union of both unified streams, null students dropped."""
    q, s = load_topics(spark, sf_dir)
    v = E.valid_events(q, s)
    return v.select("event_id", "student_id", "event_type", "event_ms", "record_ms", "kafka_offset", "is_quiz", "is_session")


def q_event_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each event type is routed; unknown types still open windows."""
    ev = _events(spark, sf_dir)
    # the route is a function of the type: taken once per type, after the counts
    route = F.when(E.is_quiz(), "quiz").when(E.is_session(), "session").otherwise("none")
    per_window = ev.groupBy("event_type", *GROUP).agg(F.count(F.lit(1)).alias("n"))
    events = per_window.groupBy("event_type").agg(
        F.sum("n").cast("bigint").alias("events"), F.count(F.lit(1)).alias("windows")
    )
    return events.withColumn("route", route)


# ------------------------------------------------------------ fold (D, E)


def q_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1/D2/H6/E2-E4/E12/E14/E15/E20."""
    st = window_state(_events(spark, sf_dir), windowed=True, order=False)
    return st.select(
        "student_id",
        "window_start_ms",
        "window_end_ms",
        "total_answers",
        "correct_answers",
        "incorrect_answers",
        "navigation_events",
        "pause_events",
        "resume_events",
    )


def q_window_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E7 (count)/E8/E11/E16."""
    ev = _events(spark, sf_dir)
    st = ev.groupBy(*GROUP).agg(*order_free_aggregates())
    return st.select("student_id", "window_start_ms", "n_time_values", "total_time_spent", "total_hints_used", "total_dwell_time")


def q_window_first_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session of the first record to arrive in the window, any type."""
    ev = _events(spark, sf_dir)
    return ev.groupBy(*GROUP).agg(F.min_by("session_id", "arrival_seq").alias("session_id"))


def q_window_time_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """first/last event time over quiz and session records."""
    ev = _events(spark, sf_dir)
    routed = F.col("is_quiz") | F.col("is_session")
    st = ev.groupBy(*GROUP).agg(
        F.min(F.when(routed, F.col("event_ms"))).alias("first_event_ms"),
        F.max(F.when(routed, F.col("event_ms"))).alias("last_event_ms"),
    )
    return st.withColumn(
        "active_time_ms", F.coalesce(F.col("last_event_ms") - F.col("first_event_ms"), F.lit(0).cast("bigint"))
    )


def q_answer_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6/E7 as a table: each answer with its arrival position in the window."""
    ev = _events(spark, sf_dir)
    answers = ev.filter(F.col("is_quiz")).select(*GROUP, "arrival_seq", "event_ms", "time_spent_ms")
    pos = answer_positions(answers, GROUP, DEFAULT_CONFIG.window.duration_ms)
    return pos.select(*GROUP, "position", "event_ms", "time_spent_ms")


def q_incorrect_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5: trailing run of wrong answers, for windows with answers."""
    ev = _events(spark, sf_dir)
    return order_metrics(ev).select(*GROUP, F.col("n_answers").alias("total_answers"), "consecutive_incorrect")


def q_rapid_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjacent answers less than 5 s apart, arrival order."""
    ev = _events(spark, sf_dir)
    return order_metrics(ev).select(*GROUP, F.col("n_answers").alias("total_answers"), "rapid_submissions")


def q_skill_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts per skill tag (canonical text) and distinct skills."""
    sk = skill_attempts(_events(spark, sf_dir))
    return sk.select(*GROUP, "unique_skills_attempted", A.map_to_text(F.col("skill_tag_attempts")).alias("skill_tag_attempts"))


def q_pages_visited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct pages of NAVIGATION events, for windows with navigation."""
    ev = _events(spark, sf_dir)
    st = ev.groupBy(*GROUP).agg(*order_free_aggregates()).filter(F.col("navigation_events") > 0)
    return st.select(
        *GROUP,
        "navigation_events",
        F.size("pages_visited").cast("bigint").alias("n_pages"),
        F.array_join("pages_visited", ",").alias("pages_visited"),
    )


def q_window_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The complete final state per (student, window), from
    one shuffle of the records (skill map and page set as canonical text)."""
    return _state_out(build_state(*load_topics(spark, sf_dir), with_skills=True, late="keep", one_pass=True))


def _state_out(st: DataFrame) -> DataFrame:
    return st.select(
        "student_id",
        "session_id",
        "window_start_ms",
        "window_end_ms",
        "total_answers",
        "correct_answers",
        "incorrect_answers",
        "consecutive_incorrect",
        "rapid_submissions",
        "n_time_values",
        "total_time_spent",
        "total_hints_used",
        "navigation_events",
        "pause_events",
        "resume_events",
        "total_dwell_time",
        "first_event_ms",
        "last_event_ms",
        "active_time_ms",
        "unique_skills_attempted",
        A.map_to_text(F.col("skill_tag_attempts")).alias("skill_tag_attempts"),
        F.array_join("pages_visited", ",").alias("pages_visited"),
    )


# ------------------------------------------------------------ metrics / scores (F, G)


def q_window_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1-F3."""
    q, s = load_topics(spark, sf_dir)
    st = build_state(q, s, late="keep", order=False)
    return st.select(*GROUP, "correctness_rate", "average_time_spent", "questions_per_minute")


def q_pattern_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4/F5 (computed, not used by the score)."""
    q, s = load_topics(spark, sf_dir)
    st = build_state(q, s, late="keep", one_pass=True)
    return st.select(
        *GROUP, "consecutive_incorrect", "rapid_submissions", "rapid_incorrect_pattern", "struggling_pattern"
    )


def q_score_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1-G4."""
    q, s = load_topics(spark, sf_dir)
    sc = build_scores(q, s, late="keep", order=False)
    return sc.select(*GROUP, "accuracy_score", "dwell_score", "pacing_score", "attention_score")


SCORE_OUT = [
    "student_id",
    "session_id",
    "window_start_ms",
    "window_end_ms",
    "total_answers",
    "accuracy_score",
    "dwell_score",
    "pacing_score",
    "score",
    "trend",
    "alert_threshold_crossed",
]


def q_engagement_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: D5/D7/G5-G11/B8/B9 — final score per student and minute."""
    q, s = load_topics(spark, sf_dir)
    return build_scores(q, s, late="keep", order=False).select(*SCORE_OUT)


def q_engagement_scores_tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same with yellow 0.7, 4 answers/min expected, tolerance 0.5."""
    q, s = load_topics(spark, sf_dir)
    return build_scores(q, s, TUNED_CONFIG, late="keep", order=False).select(*SCORE_OUT)


def q_late_filtered_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores after the per-record grace rule dropped late records."""
    q, s = load_topics(spark, sf_dir)
    return build_scores(q, s, late="drop", order=False).select(*SCORE_OUT)


def q_late_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records the grace rule rejects, with the stream time that closed them."""
    ev = _events(spark, sf_dir)
    return late_records(ev).select(
        "event_id", *_bigint("kafka_partition"), "kafka_offset", "record_ms", "window_end_ms", "stream_time_ms"
    )


CHANGE_OUT = [
    "event_id",
    *GROUP,
    "kafka_offset",
    "total_answers",
    "correct_answers",
    "consecutive_incorrect",
    "rapid_submissions",
    "score",
    "trend",
    "alert_threshold_crossed",
]


def q_score_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One score per input record (the update stream without cache merging)."""
    ev = _events(spark, sf_dir)
    return score_changelog(ev).select(*CHANGE_OUT)


def q_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert stream."""
    q, s = load_topics(spark, sf_dir)
    return monitor.alerts(build_scores(q, s, late="keep", order=False)).select(*GROUP, "score", "trend", "total_answers")


def q_score_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Green / yellow / alert band per window."""
    q, s = load_topics(spark, sf_dir)
    return with_zone(build_scores(q, s, late="keep", order=False)).select(*GROUP, "score", "zone")


def q_score_monitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H7: scores, alerts and score distribution per minute."""
    q, s = load_topics(spark, sf_dir)
    return monitor.score_summary(build_scores(q, s, late="keep", order=False))


def q_score_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H7: score distribution in ten buckets."""
    q, s = load_topics(spark, sf_dir)
    return monitor.score_histogram(build_scores(q, s, late="keep", order=False))


def q_score_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outgoing records (deterministic ids; time left out)."""
    q, s = load_topics(spark, sf_dir)
    m = score_messages(build_scores(q, s, late="keep", order=False))
    v = "value"
    return m.select(
        "key",
        "window_start_ms",
        F.col(f"{v}.envelope.id").alias("envelope_id"),
        F.col(f"{v}.envelope.type").alias("envelope_type"),
        F.col(f"{v}.envelope.source").alias("envelope_source"),
        F.col(f"{v}.envelope.specversion").alias("specversion"),
        F.col(f"{v}.envelope.sessionId").alias("session_id"),
        F.col(f"{v}.score").alias("score"),
        F.col(f"{v}.scoreComponents.accuracyScore").alias("accuracy_score"),
        F.col(f"{v}.scoreComponents.attentionScore").alias("attention_score"),
        F.col(f"{v}.trend").alias("trend"),
        F.col(f"{v}.alertThresholdCrossed").alias("alert_threshold_crossed"),
    )


def q_streaming_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D5/D6/D10/D12 + A7: the Structured Streaming query over file-backed
    topics landed in slices, started again after each from its checkpoint and
    RocksDB state with an available-now trigger; returns the upserted score
    table it wrote. The timed cadence (D9) is not run."""
    from learner_scoring.streaming.pipeline import run_file_backed_stream

    return run_file_backed_stream(spark, sf_dir).select(*SCORE_OUT)


def q_window_state_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partials of nine-second slices, stored per slice, merged in
    pairs and then to windows; the same state as ``window_state``."""
    from learner_scoring.streaming.runs import new_run

    ev = _events(spark, sf_dir).withColumn("slice", F.expr("(record_ms - window_start_ms) div 9000"))
    store = new_run(spark, "partials")
    partials.fold(ev, [*GROUP, "slice"], words=True).write.partitionBy("slice").parquet(store)
    pairs = spark.read.parquet(store).withColumn("slice", F.expr("slice div 2"))
    merged = partials.merge(partials.merge(pairs, [*GROUP, "slice"]).drop("slice"))
    return _state_out(with_metrics(partials.state(merged)))


# (application id, sf_dir) -> (late records, scores) of the clocked stream, per process
_CLOCKED: dict[tuple[str, str], tuple[DataFrame, DataFrame]] = {}


def _clocked(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    from learner_scoring.streaming.runs import clocked_run

    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CLOCKED:
        _CLOCKED[key] = clocked_run(spark, _events(spark, sf_dir))
    return _CLOCKED[key]


def q_streaming_late_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in the order they come to a consumer, late ones among
    them, clocked per partition and folded out of compact keyed state, four restarts."""
    return _clocked(spark, sf_dir)[1].select(*SCORE_OUT)


def q_streaming_late_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: the same stream's side output, late records with the time that closed them."""
    return _clocked(spark, sf_dir)[0].select(
        "event_id", *_bigint("kafka_partition"), "kafka_offset", "record_ms", "window_end_ms", "stream_time_ms"
    )


def q_streaming_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D6/D8 on a stream: one scored state per record, out of keyed state, in arrival order."""
    from learner_scoring.streaming.runs import changelog_run

    return changelog_run(spark, _events(spark, sf_dir)).select(*CHANGE_OUT)


def q_backfill_then_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch fold of the first quarter of every partition hands its state to a stream of the rest."""
    from learner_scoring.streaming.runs import handover_run

    return handover_run(spark, _events(spark, sf_dir)).select(*SCORE_OUT)


def q_open_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows that a stopped stream still holds, read from its checkpoint."""
    from learner_scoring.streaming.runs import open_windows_run

    return open_windows_run(spark, _events(spark, sf_dir)).select(
        "student_id", "window_start_ms", "window_end_ms", "total_answers", "correct_answers", "incorrect_answers", "navigation_events",
        "pause_events", "resume_events",
    )


def q_committed_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of growing parts of the records, written batch by batch to the table with a
    commit log; one batch dies before its commit and is replayed, batches are compacted."""
    from learner_scoring.streaming.runs import committed_run

    return committed_run(spark, _events(spark, sf_dir)).select(*SCORE_OUT)


def q_score_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H7: score quantiles per five minutes, from sketches kept per minute."""
    q, s = load_topics(spark, sf_dir)
    per_minute = monitor.score_sketches(build_scores(q, s, late="keep", order=False))
    return monitor.sketch_quantiles(monitor.merge_sketches(per_minute, 5 * 60_000))


def q_decode_by_schema_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4/A5: framed payloads routed by schema id to the reader of their version; what has no
    known reader goes to the dead letters."""
    out = []
    for records, schema, newest in zip(kafka_records(staged_fixture(spark, sf_dir)), (QUIZ_ANSWER, SESSION_EVENT), ("skillTag", "pageId")):
        older = T.StructType([f for f in schema.fields if f.name != newest])
        readers = {1: decode.json_reader(schema), 2: decode.json_reader(older)}
        d = decode.decode_framed(framed_records(records), readers, schema)
        out.append(d.select(
            F.col("record_key").cast("bigint").alias("event_id"), "topic", "schema_id", F.col("_decode_error").alias("reason"),
            F.col("envelope.studentId").alias("student_id"), F.col(newest).alias("newest"),
        ))
    return out[0].unionByName(out[1])


def queries() -> dict[str, Query]:
    return {
        "decode_json_skip_bad": q_decode_json_skip_bad,
        "malformed_split": q_malformed_split,
        "enrich_quiz": q_enrich_quiz,
        "enrich_session": q_enrich_session,
        "merge_streams": q_merge_streams,
        "event_routing": q_event_routing,
        "window_counts": q_window_counts,
        "window_sums": q_window_sums,
        "window_first_session": q_window_first_session,
        "window_time_bounds": q_window_time_bounds,
        "answer_lists": q_answer_lists,
        "incorrect_streak": q_incorrect_streak,
        "rapid_submissions": q_rapid_submissions,
        "skill_attempts": q_skill_attempts,
        "pages_visited": q_pages_visited,
        "window_state": q_window_state,
        "window_metrics": q_window_metrics,
        "pattern_flags": q_pattern_flags,
        "score_components": q_score_components,
        "engagement_scores": q_engagement_scores,
        "engagement_scores_tuned": q_engagement_scores_tuned,
        "late_filtered_scores": q_late_filtered_scores,
        "late_records": q_late_records,
        "score_changelog": q_score_changelog,
        "alerts": q_alerts,
        "score_zones": q_score_zones,
        "score_monitor": q_score_monitor,
        "score_histogram": q_score_histogram,
        "score_messages": q_score_messages,
        "streaming_scores": q_streaming_scores,
        "window_state_merged": q_window_state_merged,
        "streaming_late_scores": q_streaming_late_scores,
        "streaming_late_records": q_streaming_late_records,
        "streaming_changelog": q_streaming_changelog,
        "backfill_then_stream": q_backfill_then_stream,
        "open_windows": q_open_windows,
        "committed_scores": q_committed_scores,
        "score_quantiles": q_score_quantiles,
        "decode_by_schema_id": q_decode_by_schema_id,
    }

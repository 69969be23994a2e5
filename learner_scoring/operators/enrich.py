"""Topic frames -> unified event rows (re-key, flatten, merge, route, guard).

All functions are narrow projections/filters (no shuffle) and work on static
and streaming frames alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learner_scoring import config as C
from learner_scoring.functions import column_cache
from learner_scoring.schemas import TRANSPORT_COLUMNS


@column_cache
def _envelope_fields() -> tuple[Column, ...]:
    """Envelope -> event id, student (the new key), session, time, type, source."""
    e = "envelope"
    return (
        F.col(f"{e}.id").alias("event_id"),
        F.col(f"{e}.studentId").alias("student_id"),
        F.col(f"{e}.sessionId").alias("session_id"),
        F.col(f"{e}.timestamp").alias("event_ts"),
        F.col(f"{e}.type").alias("event_type"),
    )


# Record identity carried through when present (decoded Kafka frames).
PASSTHROUGH = ["record_key", "topic", "payload"]


def _transport(df: DataFrame) -> list[Column]:
    return [F.col(c) for c in [*PASSTHROUGH, *TRANSPORT_COLUMNS] if c in df.columns]


@column_cache
def _payload_flags() -> tuple[Column, ...]:
    # null payload/envelope: what a failed decode or a tombstone leaves behind
    return (F.col("envelope").isNull().alias("_no_envelope"),)


@column_cache
def _quiz_fields() -> tuple[Column, ...]:
    return (
        *_envelope_fields(),
        F.col("questionId").alias("question_id"),
        F.col("isCorrect").alias("is_correct"),
        F.col("timeSpentMs").alias("time_spent_ms"),
        F.col("contextualData.hintsUsed").alias("hints_used"),
        F.col("skillTag").alias("skill_tag"),
        F.col("difficultyLevel").alias("difficulty_level"),
        F.lit(None).cast("string").alias("session_event_type"),
        F.lit(None).cast("string").alias("page_id"),
        F.lit(None).cast("bigint").alias("dwell_time_ms"),
        F.col("envelope.source").alias("source"),
        *_payload_flags(),
    )


def flatten_quiz(quiz: DataFrame) -> DataFrame:
    """Quiz answer -> unified row; hints come from ``contextualData``."""
    return quiz.select(*_quiz_fields(), *_transport(quiz))


@column_cache
def _session_fields() -> tuple[Column, ...]:
    return (
        *_envelope_fields(),
        F.lit(None).cast("string").alias("question_id"),
        F.lit(None).cast("boolean").alias("is_correct"),
        F.lit(None).cast("bigint").alias("time_spent_ms"),
        F.lit(None).cast("int").alias("hints_used"),
        F.lit(None).cast("string").alias("skill_tag"),
        F.lit(None).cast("int").alias("difficulty_level"),
        F.col("eventType").alias("session_event_type"),
        F.col("pageId").alias("page_id"),
        F.col("dwellTimeMs").alias("dwell_time_ms"),
        F.col("envelope.source").alias("source"),
        *_payload_flags(),
    )


def flatten_session(session: DataFrame) -> DataFrame:
    """Session event -> unified row; quiz fields null."""
    return session.select(*_session_fields(), *_transport(session))


def merge_streams(quiz_rows: DataFrame, session_rows: DataFrame) -> DataFrame:
    """UNION ALL of the two unified streams (no dedup, no order)."""
    return quiz_rows.unionByName(session_rows)


def is_quiz() -> Column:
    """Exactly ``quiz.answered``."""
    return F.coalesce(F.col("event_type") == C.QUIZ_EVENT_TYPE, F.lit(False))


def is_session() -> Column:
    """Any type starting with ``session.``."""
    return F.coalesce(F.col("event_type").startswith(C.SESSION_EVENT_PREFIX), F.lit(False))


def invalid_reason() -> Column:
    """Why a row cannot be folded (null = valid).

    The reference would throw on these and stop its stream thread; here they go
    to a dead-letter frame instead.
    """
    routed = is_quiz() | is_session()
    return (
        F.when(F.col("_no_envelope"), F.lit("null_envelope"))
        .when(F.col("student_id").isNull(), F.lit("null_student_id"))
        .when(F.col("event_type").isNull(), F.lit("null_event_type"))
        .when(routed & F.col("event_ts").isNull(), F.lit("null_event_time"))
        .when(is_session() & F.col("session_event_type").isNull(), F.lit("null_session_type"))
    )


@column_cache
def _classify_columns(with_record: bool) -> tuple[Column, ...]:
    reason = invalid_reason()
    if with_record:  # a row without record time fits no window
        reason = F.coalesce(reason, F.when(F.col("record_ts").isNull(), F.lit("null_record_time")))
    extra = (
        is_quiz().alias("is_quiz"),
        is_session().alias("is_session"),
        F.unix_millis("event_ts").alias("event_ms"),
        reason.alias("invalid_reason"),
    )
    return extra + ((F.unix_millis("record_ts").alias("record_ms"),) if with_record else ())


def classify(events: DataFrame) -> DataFrame:
    """Add routing flags, ``event_ms`` / ``record_ms`` and ``invalid_reason``."""
    extra = _classify_columns("record_ts" in events.columns)
    return events.select("*", *extra).drop("_no_envelope")


def split_valid(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """B6 + B12: (rows to fold, dead letters). Both are lazy filters of one plan."""
    ok = F.col("invalid_reason").isNull()
    return classified.filter(ok).drop("invalid_reason"), classified.filter(~ok)


def unified_events(quiz: DataFrame, session: DataFrame) -> DataFrame:
    """Topic frames -> classified unified rows (valid and invalid together)."""
    return classify(merge_streams(flatten_quiz(quiz), flatten_session(session)))


def valid_events(quiz: DataFrame, session: DataFrame) -> DataFrame:
    return split_valid(unified_events(quiz, session))[0]

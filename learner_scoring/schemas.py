"""Record schemas: topic payloads, the unified event row, window state, score."""

from __future__ import annotations

from pyspark.sql import types as T

ENVELOPE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("specversion", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("studentId", T.StringType()),
        T.StructField("sessionId", T.StringType()),
        T.StructField("correlationId", T.StringType()),
    ]
)

QUIZ_ANSWER = T.StructType(
    [
        T.StructField("envelope", ENVELOPE),
        T.StructField("questionId", T.StringType()),
        T.StructField("isCorrect", T.BooleanType()),
        T.StructField("timeSpentMs", T.LongType()),
        T.StructField("skillTag", T.StringType()),
        T.StructField("difficultyLevel", T.IntegerType()),
        T.StructField("contextualData", T.StructType([T.StructField("hintsUsed", T.IntegerType())])),
    ]
)

SESSION_EVENT = T.StructType(
    [
        T.StructField("envelope", ENVELOPE),
        T.StructField("eventType", T.StringType()),
        T.StructField("pageId", T.StringType()),
        T.StructField("dwellTimeMs", T.LongType()),
    ]
)

# Transport columns every decoded topic frame carries (Kafka metadata or an
# equivalent): record time (the windowing clock), partition, offset and an
# orderable arrival sequence that is a total order per student (see
# ``operators.sequence.arrival_order``). Frames also carry ``topic``.
TRANSPORT_COLUMNS = ["record_ts", "kafka_partition", "kafka_offset", "arrival_seq"]

UNIFIED_EVENT_COLUMNS = [
    "event_id",
    "student_id",
    "session_id",
    "event_ts",
    "event_type",
    "question_id",
    "is_correct",
    "time_spent_ms",
    "hints_used",
    "skill_tag",
    "difficulty_level",
    "session_event_type",
    "page_id",
    "dwell_time_ms",
    "source",
]

SCORE_COMPONENTS = T.StructType(
    [
        T.StructField("accuracyScore", T.DoubleType()),
        T.StructField("dwellScore", T.DoubleType()),
        T.StructField("pacingScore", T.DoubleType()),
        T.StructField("attentionScore", T.DoubleType()),
    ]
)

ENGAGEMENT_SCORE = T.StructType(
    [
        T.StructField("envelope", ENVELOPE),
        T.StructField("score", T.DoubleType()),
        T.StructField("scoreComponents", SCORE_COMPONENTS),
        T.StructField("trend", T.StringType()),
        T.StructField("alertThresholdCrossed", T.BooleanType()),
    ]
)

# Window state as produced by the fold (one row per student and window).
WINDOW_STATE_COLUMNS = [
    "student_id",
    "session_id",
    "window_start_ms",
    "window_end_ms",
    "total_answers",
    "correct_answers",
    "incorrect_answers",
    "n_time_values",
    "total_time_spent",
    "navigation_events",
    "pause_events",
    "resume_events",
    "total_dwell_time",
    "pages_visited",
    "consecutive_incorrect",
    "rapid_submissions",
    "skill_tag_attempts",
    "first_event_ms",
    "last_event_ms",
    "total_hints_used",
]

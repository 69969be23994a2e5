"""Build topic frames from compact event tuples for hand-written cases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from learner_scoring.sources.fixture import topic_frames

FLAT_DDL = (
    "event_id bigint, kafka_partition int, kafka_offset bigint, record_ms bigint, event_ms bigint, "
    "student_id string, session_id string, event_type string, question_id string, is_correct boolean, "
    "time_spent_ms bigint, hints_used int, skill_tag string, difficulty_level int, session_event_type string, "
    "page_id string, dwell_time_ms bigint"
)


def ev(
    offset,
    event_type,
    event_ms,
    record_ms=None,
    student="s1",
    session="A",
    ok=None,
    time_ms=None,
    hints=None,
    skill=None,
    stype=None,
    page=None,
    dwell=None,
    partition=0,
):
    return (
        offset,
        partition,
        offset,
        event_ms if record_ms is None else record_ms,
        event_ms,
        student,
        session,
        event_type,
        f"q{offset}" if event_type == "quiz.answered" else None,
        ok,
        time_ms,
        hints,
        skill,
        1 if event_type == "quiz.answered" else None,
        stype,
        page,
        dwell,
    )


def quiz(offset, event_ms, ok, time_ms=None, **kw):
    return ev(offset, "quiz.answered", event_ms, ok=ok, time_ms=time_ms, **kw)


def sess(offset, stype, event_ms, **kw):
    return ev(offset, f"session.{stype.lower()}", event_ms, stype=stype, **kw)


def topics(spark: SparkSession, rows) -> tuple[DataFrame, DataFrame]:
    """Topic frames of hand-written rows; their offset is the arrival order of both topics."""
    flat = spark.createDataFrame(rows, FLAT_DDL)
    quiz, session = topic_frames(flat)
    seq = F.col("kafka_offset")
    return quiz.withColumn("arrival_seq", seq), session.withColumn("arrival_seq", seq)

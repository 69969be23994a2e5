"""Tumbling windows on the record clock (D2) and the per-record late rule.

Batch code assigns windows arithmetically on epoch milliseconds
(``record_ms - pmod(record_ms, W)``): exact, time-zone free, and the same
number the streaming ``F.window`` produces for an epoch-aligned tumbling
window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learner_scoring.config import DEFAULT_CONFIG, ScoringConfig
from learner_scoring.operators.sequence import running_max

# Offsets per bucket for the distributed running max over a Kafka partition.
OFFSET_BUCKET = 1 << 16


def window_start_ms(record_ms: Column, cfg: ScoringConfig = DEFAULT_CONFIG) -> Column:
    w = cfg.window.duration_ms
    return record_ms - F.pmod(record_ms, F.lit(w))


def assign_window(events: DataFrame, cfg: ScoringConfig = DEFAULT_CONFIG) -> DataFrame:
    """D2 (+E20): ``window_start_ms`` / ``window_end_ms`` from ``record_ms``, [start, end)."""
    start = window_start_ms(F.col("record_ms"), cfg)
    return events.withColumn("window_start_ms", start).withColumn(
        "window_end_ms", F.col("window_start_ms") + F.lit(cfg.window.duration_ms)
    )


def with_stream_time(events: DataFrame, bucket_width: int = OFFSET_BUCKET) -> DataFrame:
    """``stream_time_ms``: max record time seen in the record's (topic, partition)
    up to and including the record, in offset order (per-record stream time).

    Merging the partitions by that running max gives one clock: no record merged
    earlier is ahead of it, so it is the stream time of the merged stream too.
    Distributed prefix max: partitions are cut into offset buckets so no Kafka
    partition lands in a single task.
    """
    return running_max(
        events,
        ["topic", "kafka_partition"],
        "kafka_offset",
        "record_ms",
        F.floor(F.col("kafka_offset") / F.lit(bucket_width)),
        "stream_time_ms",
    )


def drop_late(events: DataFrame, cfg: ScoringConfig = DEFAULT_CONFIG, bucket_width: int = OFFSET_BUCKET) -> DataFrame:
    """Batch replay of the grace rule, record by record.

    A record is dropped when its window has closed, i.e. when
    ``window_end <= stream_time - grace``. Needs ``window_end_ms``.
    """
    timed = with_stream_time(events, bucket_width)
    keep = F.col("window_end_ms") > F.col("stream_time_ms") - F.lit(cfg.window.grace_ms)
    return timed.filter(keep).drop("stream_time_ms")


def late_records(events: DataFrame, cfg: ScoringConfig = DEFAULT_CONFIG, bucket_width: int = OFFSET_BUCKET) -> DataFrame:
    """The complement of ``drop_late``: records the grace rule rejects."""
    timed = with_stream_time(events, bucket_width)
    late = F.col("window_end_ms") <= F.col("stream_time_ms") - F.lit(cfg.window.grace_ms)
    return timed.filter(late)

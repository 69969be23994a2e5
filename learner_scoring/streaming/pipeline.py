"""The scoring topology as a Structured Streaming query.

quiz stream ─┐
             ├─ unionByName ─ withWatermark(record_ts, grace) ─ groupBy(window, student)
session ─────┘      .agg(fold, list form) ─ score ─ update/append ─ sink

The watermark sits after the union (one stream clock, T6). Update mode emits
every changed window per micro-batch (D6); append mode emits each window once
after it closes (D7). State is evicted once the watermark passes a window's
end; the checkpoint holds offsets and state so a restart resumes.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from learner_scoring.config import DEFAULT_CONFIG, ScoringConfig
from learner_scoring.functions.scoring import with_metrics, with_score
from learner_scoring.operators.enrich import valid_events
from learner_scoring.operators.fold import window_state_lists
from learner_scoring.session import ensure_checkpoint_dir
from learner_scoring.streaming.sinks import BatchUpsert, latest_scores

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
#: Slices of record time in which the file-backed stream lands its topics.
SLICES = 4


def stream_scores(quiz: DataFrame, session: DataFrame, cfg: ScoringConfig = DEFAULT_CONFIG, tap=None) -> DataFrame:
    """Streaming (or static) topic frames -> scored window states; ``tap`` sees the events consumed."""
    ev = valid_events(quiz, session)
    if tap is not None:
        ev = tap(ev)
    ev = ev.withWatermark("record_ts", f"{cfg.window.grace_period_seconds} seconds")
    return with_score(with_metrics(window_state_lists(ev, cfg)), cfg)


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep keyed state in RocksDB (off-heap, spills to local disk, checkpointed)."""
    spark.conf.set(PROVIDER_KEY, ROCKSDB_PROVIDER)


@contextmanager
def rocksdb_state(spark: SparkSession):
    """``use_rocksdb_state`` for the queries run inside; the session's own setting comes back."""
    before = spark.conf.get(PROVIDER_KEY, None)
    use_rocksdb_state(spark)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER_KEY)
        else:
            spark.conf.set(PROVIDER_KEY, before)


def start_query(
    scored: DataFrame,
    sink,
    checkpoint: str,
    output_mode: str = "update",
    processing_time: str | None = "1 second",
    available_now: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """Start the query with a ``foreachBatch`` sink.

    ``processing_time`` is the emission cadence (1 s like the reference's
    commit interval); ``available_now`` processes what is there and stops
    (backfill, tests).
    """
    w = scored.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).foreachBatch(sink)
    if name:
        w = w.queryName(name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def file_topics(spark: SparkSession, quiz_dir: str, session_dir: str, max_files_per_trigger: int | None = None):
    """Topic frames as streams over parquet folders (the test/backfill source)."""
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    # the landed files say how they number arrival (a struct or a bigint)
    quiz, session = (spark.read.parquet(d).schema for d in (quiz_dir, session_dir))
    return r.schema(quiz).parquet(quiz_dir), r.schema(session).parquet(session_dir)


def run_file_backed_stream(
    spark: SparkSession,
    sf_dir: str,
    cfg: ScoringConfig = DEFAULT_CONFIG,
    output_mode: str = "update",
    slices: int = SLICES,
    run: str | None = None,
) -> DataFrame:
    """Stream the fixture topics of ``sf_dir`` through ``stream_scores`` and
    return the upserted score table.

    The topics are landed under the shared checkpoint root in ``slices`` of
    record time, the same for both, so no record comes after the watermark.
    After each slice the query is started again from its checkpoint (offsets and
    RocksDB state), reads what is new and stops. ``run`` is a new folder for all
    of it.
    """
    from learner_scoring.sources.fixture import load_topics

    run = run or f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    topics = dict(zip(("quiz", "session"), load_topics(spark, sf_dir)))
    times = topics["quiz"].select("record_ts").union(topics["session"].select("record_ts"))
    at = [i / slices for i in range(1, slices)]
    ends = times.agg(F.percentile_approx(F.unix_micros("record_ts"), at).alias("p")).first()["p"] if at else []
    micros = F.unix_micros("record_ts")
    place = sum((F.when(micros > end, 1).otherwise(0) for end in ends or []), F.lit(0))  # null times come first
    with rocksdb_state(spark):
        for i in range(slices):
            for name, topic in topics.items():
                topic.filter(place == i).write.mode("append").parquet(f"{run}/{name}")
            qs, ss = file_topics(spark, f"{run}/quiz", f"{run}/session")
            sink = BatchUpsert(f"{run}/scores")
            start_query(stream_scores(qs, ss, cfg), sink, f"{run}/checkpoint", output_mode, available_now=True).awaitTermination()
    return latest_scores(spark, f"{run}/scores")

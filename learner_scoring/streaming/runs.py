"""File-backed runs of the stateful streams: landed slices, restarts, tables read back.

Each run lands events of a table in slices under the shared checkpoint folder
and starts its queries again from their checkpoints after every slice, like a
job that is stopped and started while its topics grow.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from learner_scoring.config import DEFAULT_CONFIG, ScoringConfig
from learner_scoring.functions.scoring import with_metrics, with_score
from learner_scoring.operators.partials import state as window_state_of
from learner_scoring.operators.partials import window_partials
from learner_scoring.session import ensure_checkpoint_dir
from learner_scoring.streaming import stateful as S
from learner_scoring.streaming.pipeline import rocksdb_state, start_query
from learner_scoring.streaming.sinks import BatchUpsert, latest_scores
from learner_scoring.streaming.table import CommittedTable

SLICES = 4


def new_run(spark: SparkSession, kind: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def by_offset(events: DataFrame, slices: int) -> DataFrame:
    """``slice``: each partition's offsets in equal parts, as records come to a consumer."""
    ends = events.groupBy("topic", "kafka_partition").agg(F.max("kafka_offset").alias("_end"))
    cut = events.join(ends, ["topic", "kafka_partition"])
    return cut.withColumn("slice", F.expr(f"least((kafka_offset - 1) * {slices} div _end, {slices - 1})")).drop("_end")


def by_record_time(events: DataFrame, slices: int) -> DataFrame:
    """``slice``: equal parts of the records in record time, so no slice has a record before the last one's."""
    at = [i / slices for i in range(1, slices)]
    ends = events.agg(F.percentile_approx("record_ms", at).alias("p")).first()["p"] if at else []
    place = sum((F.when(F.col("record_ms") > end, 1).otherwise(0) for end in ends or []), F.lit(0))
    return events.withColumn("slice", place)


def landed(spark: SparkSession, sliced: DataFrame, run: str, slices: int) -> Iterator[DataFrame]:
    """The landing folder as a stream, once more after each slice has been added to it."""
    all_of_it = f"{run}/slices"
    sliced.select(*S.EVENT_COLUMNS, "event_type", "slice").write.partitionBy("slice").parquet(all_of_it)
    parts = spark.read.parquet(all_of_it)
    schema = parts.drop("slice").schema
    for i in range(slices):
        parts.filter(F.col("slice") == i).drop("slice").write.mode("append").parquet(f"{run}/landed")
        yield spark.readStream.schema(schema).parquet(f"{run}/landed")


def clocked_run(
    spark: SparkSession, events: DataFrame, cfg: ScoringConfig = DEFAULT_CONFIG, slices: int = SLICES, run: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(late records, latest scores) of events that come in offset order.

    Two queries: the first clocks the records of each micro-batch and writes them,
    late ones apart; the second folds and scores what was on time.
    """
    run = run or new_run(spark, "clocked")
    clock = S.ClockedBatches(f"{run}/clocked", cfg)
    clocked = f"{clock.path}/rows"
    with rocksdb_state(spark):
        for stream in landed(spark, by_offset(events, slices), run, slices):
            schema = clock.schema(stream)
            start_query(stream, clock, f"{run}/clock-checkpoint", output_mode="append", available_now=True).awaitTermination()
            on_time = spark.readStream.schema(schema).parquet(clocked).filter("late = 0")
            scored = with_score(with_metrics(S.fold_windows(on_time, cfg)), cfg)
            start_query(scored, BatchUpsert(f"{run}/scores"), f"{run}/checkpoint", available_now=True).awaitTermination()
    late = spark.read.schema(schema).parquet(clocked).filter("late = 1").drop("late", "batch_id")
    return late, latest_scores(spark, f"{run}/scores")


def changelog_run(
    spark: SparkSession, events: DataFrame, cfg: ScoringConfig = DEFAULT_CONFIG, slices: int = SLICES, run: str | None = None
) -> DataFrame:
    """The scored state after each record, of events that come in arrival order."""
    run = run or new_run(spark, "changelog")
    with rocksdb_state(spark):
        for stream in landed(spark, by_record_time(events, slices), run, slices):
            scored = with_score(with_metrics(S.fold_windows(stream, cfg, emit="every")), cfg)
            start_query(scored, BatchUpsert(f"{run}/changes"), f"{run}/checkpoint", available_now=True).awaitTermination()
    return spark.read.parquet(f"{run}/changes")


def handover_run(
    spark: SparkSession, events: DataFrame, cfg: ScoringConfig = DEFAULT_CONFIG, slices: int = SLICES, run: str | None = None
) -> DataFrame:
    """Scores of a batch fold of the first slice that a stream goes on from with the others.

    The table starts with the batch's scores; the stream's state starts with its
    partials, written once so that both tell of the same records.
    """
    run = run or new_run(spark, "handover")
    sliced = by_offset(events, slices)
    first, rest = F.col("slice") == 0, F.col("slice") - 1
    window_partials(sliced.filter(first), cfg=cfg).write.parquet(f"{run}/partials")
    partials = spark.read.parquet(f"{run}/partials")
    backfill = with_score(with_metrics(window_state_of(partials, cfg)), cfg)
    backfill.withColumn("batch_id", F.lit(-1).cast("bigint")).write.parquet(f"{run}/scores/batch_id=-1")
    with rocksdb_state(spark):
        for stream in landed(spark, sliced.filter(~first).withColumn("slice", rest), run, slices - 1):
            folded = S.fold_windows(stream, cfg, initial=S.handover_state(partials))
            scored = with_score(with_metrics(folded), cfg)
            columns = backfill.columns
            start_query(scored, BatchUpsert(f"{run}/scores", columns), f"{run}/checkpoint", available_now=True).awaitTermination()
    return latest_scores(spark, f"{run}/scores")


def open_windows_run(
    spark: SparkSession, events: DataFrame, cfg: ScoringConfig = DEFAULT_CONFIG, slices: int = SLICES, run: str | None = None
) -> DataFrame:
    """What a stopped query holds: the windows no timer has ended, read from its checkpoint."""
    run = run or new_run(spark, "open")
    with rocksdb_state(spark):
        for stream in landed(spark, by_record_time(events, slices), run, slices):
            folded = S.fold_windows(stream, cfg, lag_seconds=0)
            start_query(folded, BatchUpsert(f"{run}/states"), f"{run}/checkpoint", available_now=True).awaitTermination()
        return S.read_windows(spark, f"{run}/checkpoint", cfg)


def committed_run(
    spark: SparkSession, events: DataFrame, cfg: ScoringConfig = DEFAULT_CONFIG, slices: int = SLICES, run: str | None = None
) -> DataFrame:
    """The score table after an update stream whose writer dies before one commit.

    The second batch's rows are staged and not committed; the next query starts
    from the checkpoint, replays the batch, and later batches are compacted.
    """
    run = run or new_run(spark, "committed")
    table = CommittedTable(f"{run}/scores", compact_every=3)
    died = []

    def dies_once(batch: DataFrame, batch_id: int) -> None:
        if batch_id == 1 and not died:
            died.append(table._stage(batch.limit(5).withColumn("batch_id", F.lit(batch_id).cast("bigint")), "batch", batch_id))
            raise RuntimeError("writer stopped between write and commit")
        table(batch, batch_id)

    def go(stream: DataFrame) -> None:
        scored = with_score(with_metrics(S.fold_windows(stream, cfg)), cfg)
        start_query(scored, dies_once, f"{run}/checkpoint", available_now=True).awaitTermination()

    with rocksdb_state(spark):
        for stream in landed(spark, by_record_time(events, slices), run, slices):
            try:
                go(stream)
            except StreamingQueryException as e:
                if "between write and commit" not in str(e):
                    raise
                go(stream)
    return table.read(spark)

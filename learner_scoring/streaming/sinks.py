"""Sinks for the score stream.

* Kafka: ``kafka_frame`` builds the ``key``/``value`` columns the Kafka sink
  expects (value = JSON score record). Spark's Kafka sink is at-least-once; the
  deterministic envelope id (student, window, batch) lets consumers drop
  re-deliveries and keep every update.
* Files: ``BatchUpsert`` is a ``foreachBatch`` writer that makes every
  micro-batch idempotent — a replayed batch id overwrites its own folder — and
  ``latest_scores`` reads the table back keeping the last update per
  (student, window).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from learner_scoring.config import DEFAULT_CONFIG, ScoringConfig
from learner_scoring.functions.scoring import deterministic_score_id, score_envelope, score_record


def kafka_frame(
    scored: DataFrame, cfg: ScoringConfig = DEFAULT_CONFIG, deterministic: bool = True, batch_id: int | None = None
) -> DataFrame:
    """key = student id, value = JSON score record.

    With a batch id every update of a window has its own id, and a replayed
    batch has the ids it had before.
    """
    batch = None if batch_id is None else F.lit(batch_id)
    env = score_envelope(cfg, deterministic_score_id(batch) if deterministic else None)
    return scored.filter(F.col("score").isNotNull()).select(
        F.col("student_id").alias("key"), F.to_json(score_record(env)).alias("value")
    )


class BatchUpsert:
    """``foreachBatch`` target: ``<path>/batch_id=<n>`` per micro-batch, overwritten on replay."""

    def __init__(self, path: str, columns: list[str] | None = None):
        self.path = path.rstrip("/")
        self.columns = columns

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        out = batch if self.columns is None else batch.select(*self.columns)
        out.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(
            f"{self.path}/batch_id={batch_id}"
        )


class KafkaBatchWriter:
    """``foreachBatch`` target writing score records to a Kafka topic (at-least-once)."""

    def __init__(self, options: dict[str, str], cfg: ScoringConfig = DEFAULT_CONFIG):
        self.options = dict(options)
        self.cfg = cfg

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        kafka_frame(batch, self.cfg, batch_id=batch_id).write.format("kafka").options(**self.options).save()


class FanOut:
    """``foreachBatch`` target feeding several sinks from one micro-batch.

    The batch is persisted once so the stateful part of the query runs once
    per trigger, whatever the number of outputs; each output may filter it.
    """

    def __init__(self, *outputs):
        self.outputs = outputs  # (sink, filter Column or None)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for sink, cond in self.outputs:
                sink(batch if cond is None else batch.filter(cond), batch_id)
        finally:
            batch.unpersist()


def latest_scores(spark: SparkSession, path: str, keys: tuple[str, ...] = ("student_id", "window_start_ms")) -> DataFrame:
    """Current table state: the row of the latest batch per key."""
    raw = spark.read.option("basePath", path).parquet(f"{path.rstrip('/')}/batch_id=*")
    rest = [c for c in raw.columns if c not in (*keys, "batch_id")]
    last = raw.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("batch_id")).alias("last"))
    return last.select(*keys, "last.*")

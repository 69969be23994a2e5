"""Kafka topics as Spark sources and sinks.

The two input topics are read with ``format("kafka")``. The Kafka connector
jar (``spark-sql-kafka``) must be on the cluster's classpath; it is not
bundled here, so these readers are exercised in tests only through frames that
have the Kafka source schema (``key, value, topic, partition, offset,
timestamp``), which is all the decoding layer depends on.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Topic names and settings of the reference deployment.
QUIZ_TOPIC = "quiz.answers"
SESSION_TOPIC = "session.events"
SCORE_TOPIC = "engagement.scores"


def kafka_options(
    bootstrap_servers: str,
    topics: str | list[str],
    client_properties: Mapping[str, str] | None = None,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    fail_on_data_loss: bool = True,
) -> dict[str, str]:
    """Reader options: subscribe, start at the earliest offset when no checkpoint
    exists (A3; later runs resume from the checkpoint) and pass client settings
    (security, SASL, ...) through with the ``kafka.`` prefix (A6). Records that
    vanished before they were read fail the query unless the caller allows it."""
    topic_list = topics if isinstance(topics, str) else ",".join(topics)
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic_list,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        "includeHeaders": "false",
    }
    if max_offsets_per_trigger is not None:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    for k, v in (client_properties or {}).items():
        opts[k if k.startswith("kafka.") else f"kafka.{k}"] = v
    return opts


def read_topic_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """A1/A2: a topic as a streaming frame of raw Kafka records."""
    return spark.readStream.format("kafka").options(**options).load()


def read_topic_batch(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Backfill: the same records as a bounded batch frame."""
    opts = dict(options)
    opts.setdefault("endingOffsets", "latest")
    return spark.read.format("kafka").options(**opts).load()


def offsets_after(records: DataFrame) -> str:
    """Where a stream goes on after a batch of ``records`` (topic, partition, offset): its ``startingOffsets``.

    One number per topic and partition reaches the driver.
    """
    ends = records.groupBy("topic", "partition").agg(F.max("offset").alias("offset")).collect()
    out: dict[str, dict[str, int]] = {}
    for r in ends:
        out.setdefault(r["topic"], {})[str(r["partition"])] = r["offset"] + 1
    return json.dumps(out, sort_keys=True)


def writer_options(bootstrap_servers: str, topic: str = SCORE_TOPIC, client_properties: Mapping[str, str] | None = None) -> dict[str, str]:
    """Sink options for ``writeStream.format("kafka")`` (key/value columns)."""
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic}
    for k, v in (client_properties or {}).items():
        opts[k if k.startswith("kafka.") else f"kafka.{k}"] = v
    return opts

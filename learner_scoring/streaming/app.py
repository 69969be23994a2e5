"""The scoring service as a Structured Streaming job.

    python -m learner_scoring.streaming.app --source kafka --bootstrap broker:9092 \
        --sink kafka --checkpoint-name scores

Reads the quiz-answer and session-event topics (Kafka, or parquet folders of
records with the Kafka source schema), decodes JSON or framed Avro payloads
(undecodable and unfoldable records go to a dead-letter sink with their
payload), scores windows and writes the score stream (Kafka topic, or a parquet
table with a commit log). Settings come from a JSON file and from arguments:

    --config scoring.json --set thresholds.yellow=0.7 --set window.duration_seconds=30
    --client security.protocol=SASL_SSL --client sasl.mechanism=PLAIN
    --format avro --quiz-schema 7=quiz-v1.avsc --quiz-schema 9=quiz-v2.avsc --session-schema 8=session.avsc

Checkpoints live under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from learner_scoring.config import DEFAULT_CONFIG, ScoringConfig
from learner_scoring.operators.enrich import split_valid, unified_events
from learner_scoring.schemas import QUIZ_ANSWER, SESSION_EVENT
from learner_scoring.session import checkpoint_location
from learner_scoring.sources import decode, kafka
from learner_scoring.streaming.pipeline import start_query, stream_scores, use_rocksdb_state
from learner_scoring.streaming.observe import observe_events, observe_scores
from learner_scoring.streaming.sinks import BatchUpsert, FanOut, KafkaBatchWriter


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="Stream engagement scores from quiz answers and session events.")
    p.add_argument("--source", choices=["kafka", "files"], default="kafka")
    p.add_argument("--bootstrap", default="localhost:9092")
    p.add_argument("--quiz-topic", default=kafka.QUIZ_TOPIC)
    p.add_argument("--session-topic", default=kafka.SESSION_TOPIC)
    p.add_argument("--quiz-path", help="files source: parquet folder of quiz records")
    p.add_argument("--session-path", help="files source: parquet folder of session records")
    p.add_argument("--max-offsets-per-trigger", type=int, default=5_000_000, help="bound of a micro-batch, the first one too")
    p.add_argument("--max-files-per-trigger", type=int, default=1000, help="files source: bound of a micro-batch")
    p.add_argument("--sink", choices=["kafka", "files"], default="kafka")
    p.add_argument("--score-topic", default=kafka.SCORE_TOPIC)
    p.add_argument("--out", help="files sink: folder of the score table")
    p.add_argument("--dead-letters", help="folder for undecodable / unfoldable records")
    p.add_argument("--alerts", help="folder of the alert flag per window; filter alert_threshold_crossed on reading")
    p.add_argument("--checkpoint-name", default="engagement-scores")
    p.add_argument("--mode", choices=["update", "append"], default="update")
    p.add_argument("--trigger-seconds", type=float, default=1.0)
    p.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    p.add_argument("--rocksdb", action="store_true")
    p.add_argument("--config", help="JSON file: sections weights, thresholds, window")
    p.add_argument("--set", dest="settings", action="append", default=[], metavar="SECTION.NAME=VALUE", help="one setting, over --config")
    p.add_argument("--client", action="append", default=[], metavar="NAME=VALUE", help="Kafka client property of sources and sink")
    p.add_argument("--format", choices=["json", "avro"], default="json", help="payloads of both topics")
    p.add_argument("--quiz-schema", action="append", default=[], metavar="ID=FILE", help="avro: schema id and schema file")
    p.add_argument("--session-schema", action="append", default=[], metavar="ID=FILE")
    return p.parse_args(argv)


def _pairs(items: list[str], option: str) -> dict[str, str]:
    bad = [x for x in items if "=" not in x]
    if bad:
        raise ValueError(f"{option} takes NAME=VALUE, not {bad[0]!r}")
    return dict(x.split("=", 1) for x in items)


def scoring_config(a: argparse.Namespace) -> ScoringConfig:
    """The settings of the job: defaults, then the file, then single arguments."""
    cfg = DEFAULT_CONFIG
    if a.config:
        with open(a.config) as f:
            cfg = cfg.with_settings(json.load(f))
    for name, value in _pairs(a.settings, "--set").items():
        section, _, field = name.partition(".")
        cfg = cfg.with_settings({section: {field: float(value) if section != "window" else int(value)}})
    return cfg


def _records(spark: SparkSession, a: argparse.Namespace, topic: str, path: str | None) -> DataFrame:
    if a.source == "kafka":
        opts = kafka.kafka_options(a.bootstrap, topic, _pairs(a.client, "--client"), max_offsets_per_trigger=a.max_offsets_per_trigger)
        return kafka.read_topic_stream(spark, opts)
    schema = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", a.max_files_per_trigger).parquet(path)


def _decoded(records: DataFrame, a: argparse.Namespace, schema, schema_files: list[str]) -> tuple[DataFrame, DataFrame]:
    if a.format == "json":
        return decode.split_decoded(decode.decode_json(records, schema))
    schemas = {int(i): open(path).read() for i, path in _pairs(schema_files, "--quiz-schema/--session-schema").items()}
    if not schemas:
        raise ValueError("--format avro needs the schema ids of both topics")
    return decode.split_decoded(decode.decode_avro_by_id(records, schemas, schema))


def build(spark: SparkSession, a: argparse.Namespace) -> tuple[DataFrame, DataFrame]:
    """(scored windows, dead letters) as streaming frames."""
    cfg = scoring_config(a)
    quiz, quiz_bad = _decoded(_records(spark, a, a.quiz_topic, a.quiz_path), a, QUIZ_ANSWER, a.quiz_schema)
    session, session_bad = _decoded(_records(spark, a, a.session_topic, a.session_path), a, SESSION_EVENT, a.session_schema)
    _, unfoldable = split_valid(unified_events(quiz, session))
    dead = quiz_bad.unionByName(session_bad).unionByName(
        unfoldable.select(
            "record_key", "topic", "kafka_partition", "kafka_offset", "record_ts", "payload", F.col("invalid_reason").alias("reason")
        )
    )
    # per-micro-batch monitoring (events by route, scores, alerts, score range) rides along in the query's own tasks
    return observe_scores(stream_scores(quiz, session, cfg, tap=observe_events)), dead


def run(spark: SparkSession, argv: list[str] | None = None) -> list[StreamingQuery]:
    """Start the scoring query (scores + optional alerts from the same
    micro-batch) and, if asked, the dead-letter query."""
    a = parse_args(argv)
    if a.rocksdb:
        use_rocksdb_state(spark)
    scored, dead = build(spark, a)
    trigger = dict(available_now=True) if a.available_now else dict(processing_time=f"{a.trigger_seconds} seconds")
    if a.sink == "kafka":
        score_sink = KafkaBatchWriter(kafka.writer_options(a.bootstrap, a.score_topic, _pairs(a.client, "--client")), scoring_config(a))
    else:
        score_sink = BatchUpsert(a.out)
    outputs = [(score_sink, None)]
    if a.alerts:
        cols = ["student_id", "session_id", "window_start_ms", "score", "trend", "total_answers", "alert_threshold_crossed"]
        # every update carries the flag, so a window that recovers is no longer listed by its latest row
        outputs.append((BatchUpsert(a.alerts, cols), None))
    queries = [start_query(scored, FanOut(*outputs), checkpoint_location(spark, a.checkpoint_name), a.mode, **trigger)]
    if a.dead_letters:
        queries.append(
            start_query(
                dead, BatchUpsert(a.dead_letters), checkpoint_location(spark, a.checkpoint_name + "-dead"), "append", **trigger
            )
        )
    return queries


def main(argv: list[str] | None = None) -> None:
    spark = SparkSession.builder.appName("engagement-scores").getOrCreate()
    run(spark, argv)
    spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()

"""Payload decoding with dead letters (A4, A5, B12 input side).

Input: frames with the Kafka source schema (``key, value, topic, partition,
offset, timestamp``). Output: topic frames (nested payload columns plus the
transport columns ``record_ts, kafka_partition, kafka_offset, arrival_seq``).

Undecodable records are skipped by the scoring path and kept in a dead-letter
frame. For JSON, ``from_json`` in PERMISSIVE mode with a corrupt-record column
separates them: malformed text gives a struct of nulls with the raw text in
``_corrupt_record``; empty or null text gives a null struct. Both go to the
dead letters, with their payload. Framed payloads (magic byte 0, 4-byte schema
id, body) go to the reader of their schema id, so a topic may hold several
versions; frames without a known id go to the dead letters.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learner_scoring.operators.sequence import arrival_order

CORRUPT = "_corrupt_record"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def transport(arrival_seq: Column | None = None) -> list[Column]:
    """Kafka metadata -> transport columns. ``arrival_seq`` defaults to record time,
    topic, partition, offset: a student's records come from any partition of both topics."""
    if arrival_seq is None:
        arrival_seq = arrival_order(F.unix_millis("timestamp"), F.col("topic"), F.col("partition"), F.col("offset"))
    return [
        F.col("timestamp").alias("record_ts"),
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("bigint").alias("kafka_offset"),
        arrival_seq.alias("arrival_seq"),
    ]


def decode_json(records: DataFrame, schema: T.StructType, arrival_seq: Column | None = None) -> DataFrame:
    """Parse ``value`` as JSON into ``schema``; adds ``_decode_error`` (null = ok)."""
    parsed = F.from_json(
        F.col("value").cast("string"),
        _with_corrupt(schema),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    # The parse runs inside a one-row generator: a filter on the parsed struct
    # (the good/dead-letter split) cannot be pushed below a generator, so the
    # optimizer never copies the parse into the filter — each payload is
    # parsed exactly once.
    p = records.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("key").cast("string").alias("record_key"),
                    F.col("topic"),
                    F.col("value").alias("payload"),
                    parsed.alias("_p"),
                    *transport(arrival_seq),
                )
            )
        )
    )
    error = (
        F.when(F.col("_p").isNull(), F.lit("empty_payload"))
        .when(F.col(f"_p.{CORRUPT}").isNotNull(), F.lit("corrupt_payload"))
    )
    return p.select(
        "record_key",
        "topic",
        "payload",
        *[F.col(f"_p.{f.name}").alias(f.name) for f in schema.fields],
        "record_ts",
        "kafka_partition",
        "kafka_offset",
        "arrival_seq",
        error.alias("_decode_error"),
    )


def strip_confluent_header(value: Column) -> Column:
    """Confluent wire format: 1 magic byte + 4 schema-id bytes, then Avro."""
    return F.substring(value, 6, 1 << 30)


#: Bytes before the body of a frame.
HEADER = 5
#: Reads a body into a struct; null where it cannot.
Reader = Callable[[Column], Column]


def schema_id(value: Column) -> Column:
    """The schema id of a frame (4 bytes, big-endian); null for what is no frame."""
    framed = (F.length(value) >= HEADER) & (F.substring(F.hex(value), 1, 2) == "00")
    return F.when(framed, F.conv(F.substring(F.hex(F.substring(value, 2, 4)), 1, 8), 16, 10).cast("bigint"))


def decode_framed(
    records: DataFrame, readers: Mapping[int, Reader], schema: T.StructType, arrival_seq: Column | None = None
) -> DataFrame:
    """Decode framed payloads, each with the reader of its schema id, into ``schema``.

    Readers may give structs of their own: fields are taken by name and cast,
    missing ones are null, further ones are left out. A record is parsed once, by
    one reader. Adds ``schema_id`` and ``_decode_error``: ``empty_payload``,
    ``no_frame``, ``unknown_schema_id`` or ``corrupt_payload``.
    """
    sid = schema_id(F.col("value"))
    body = strip_confluent_header(F.col("value"))
    head = records.limit(0)
    parsed = F.lit(None).cast(schema)
    for one, reader in readers.items():
        has = head.select(reader(body).alias("_p")).schema["_p"].dataType.fieldNames()
        p = reader(body)
        fields = [(p[f.name] if f.name in has else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
        parsed = F.when(sid == one, F.when(p.isNotNull(), F.struct(*fields))).otherwise(parsed)
    # same one-row generator fence as decode_json: parse once per record
    p = records.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("key").cast("string").alias("record_key"),
                    F.col("topic"),
                    F.col("value").alias("payload"),
                    sid.alias("schema_id"),
                    parsed.alias("_p"),
                    *transport(arrival_seq),
                )
            )
        )
    )
    known = F.col("schema_id").isin(*readers) if readers else F.lit(False)
    error = (
        F.when(F.col("payload").isNull() | (F.length("payload") == 0), F.lit("empty_payload"))
        .when(F.col("schema_id").isNull(), F.lit("no_frame"))
        .when(~known, F.lit("unknown_schema_id"))
        .when(F.col("_p").isNull(), F.lit("corrupt_payload"))
    )
    return p.select(
        "record_key", "topic", "payload", "schema_id", *[F.col(f"_p.{f.name}").alias(f.name) for f in schema.fields],
        "record_ts", "kafka_partition", "kafka_offset", "arrival_seq", error.alias("_decode_error"),
    )


def json_reader(schema: T.StructType) -> Reader:
    """Reader of JSON bodies; null for what is no object of the schema."""

    def read(body: Column) -> Column:
        p = F.from_json(body.cast("string"), _with_corrupt(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
        return F.when(p[CORRUPT].isNull(), p)

    return read


def avro_reader(avro_schema_json: str) -> Reader:
    """Reader of Avro bodies of one schema; needs the spark-avro package on the cluster."""

    def read(body: Column) -> Column:
        from pyspark.sql.avro.functions import from_avro

        return from_avro(body, avro_schema_json, {"mode": "PERMISSIVE"})

    return read


def decode_avro_by_id(
    records: DataFrame, schemas: Mapping[int, str], schema: T.StructType, arrival_seq: Column | None = None
) -> DataFrame:
    """Framed Avro records of several schema ids (id -> Avro schema) as one topic frame."""
    return decode_framed(records, {i: avro_reader(text) for i, text in schemas.items()}, schema, arrival_seq)


def decode_avro(records: DataFrame, avro_schema_json: str, arrival_seq: Column | None = None) -> DataFrame:
    """Avro counterpart of ``decode_json``. Needs the spark-avro package on the
    cluster; without it Spark raises AVRO_NOT_LOADED_SQL_FUNCTIONS_UNUSABLE."""
    try:
        from pyspark.sql.avro.functions import from_avro
    except ImportError as e:  # pragma: no cover - depends on the installation
        raise RuntimeError("spark-avro is not available in this environment") from e
    parsed = from_avro(strip_confluent_header(F.col("value")), avro_schema_json, {"mode": "PERMISSIVE"})
    # same one-row generator fence as decode_json: parse once per record
    p = records.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("key").cast("string").alias("record_key"),
                    F.col("topic"),
                    F.col("value").alias("payload"),
                    parsed.alias("_p"),
                    *transport(arrival_seq),
                )
            )
        )
    )
    return p.select(
        "record_key",
        "topic",
        "payload",
        "_p.*",
        "record_ts",
        "kafka_partition",
        "kafka_offset",
        "arrival_seq",
        F.when(F.col("_p").isNull(), F.lit("corrupt_payload")).alias("_decode_error"),
    )


def split_decoded(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(decoded topic frame, undecodable records)."""
    ok = F.col("_decode_error").isNull()
    good = decoded.filter(ok).drop("_decode_error")
    bad = decoded.filter(~ok).select(
        "record_key", "topic", "kafka_partition", "kafka_offset", "record_ts", "payload", F.col("_decode_error").alias("reason")
    )
    return good, bad

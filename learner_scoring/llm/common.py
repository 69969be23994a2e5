"""Helpers shared by the corpus operators: words, shared checkpoints, Arrow maps."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words (fixed by the contracts); ``bytes.split()`` and
#: ``bytes.strip()`` use exactly this set.
SPACE = " \t\n\x0b\x0c\r"
#: One word, as a Java / RE2 regular expression.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of an Arrow batch between JVM and Python; batches are handled in slices of no more.
BATCH_BYTES = 4 << 20


def ship_by_value(module: str) -> None:
    """Send a module's functions to Python workers with the task.

    Executors then need no copy of this package on their import path.
    """
    cloudpickle.register_pickle_by_value(sys.modules[module])


def is_local(spark: SparkSession) -> bool:
    """True for ``local`` and ``local[n]`` masters: driver and tasks share one machine."""
    master = spark.conf.get("spark.master", "")
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, a temporary folder is made for a local session only
    (tests); on a cluster that is an error, because executors could not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="corpus-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: for wide rows of which some readers need few columns."""
    out = f"{checkpoint_root(df.sparkSession).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    df.write.parquet(out)
    return df.sparkSession.read.schema(df.schema).parquet(out)


#: Rows up to which a written table of narrow rows is sent to all executors.
BROADCAST_ROWS = 50_000


def small(df: DataFrame) -> DataFrame:
    """A written table, to be broadcast if its counted rows are few, else joined by shuffle."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_key(col: str = "text"):
    """16-byte identity of a text (half of its SHA-256; null like the empty text)."""
    return F.unhex(F.substring(F.sha2(F.coalesce(F.col(col), F.lit("")), 256), 1, 32))


def bounded_batches(spark: SparkSession) -> None:
    """Hold Arrow batches to ``BATCH_BYTES`` where the session allows larger ones.

    The usual bound counts rows, and rows of text may be long.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).lower().rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def sliced(batches: Iterator[pa.RecordBatch], size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into zero-copy slices of about ``size`` bytes, one row at least."""
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        step = max(1, min(n, int(n * size / max(1, b.nbytes))))
        for i in range(0, n, step):
            yield b.slice(i, step)


def raw_texts(batch: pa.RecordBatch, col: str = "text") -> list[bytes]:
    """The UTF-8 bytes of each row's text; null counts as empty."""
    return [x or b"" for x in batch.column(col).cast(pa.binary()).to_pylist()]


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``mapInArrow`` over slices; ``fn`` turns one slice into one output batch."""

    bounded_batches(df.sparkSession)

    def run(batches):
        for b in sliced(batches):
            out = fn(b)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


ship_by_value(__name__)

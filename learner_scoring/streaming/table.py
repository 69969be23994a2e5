"""A score table with a commit log: staged writes, atomic batches, compaction.

``<path>/data/<name>`` holds the rows of one write, ``<path>/commits/<name>`` one
small record that says the write counts. Rows become visible with their commit
record alone, which is moved into place as one file, so a writer that dies at
any point leaves the table as it was. A batch that is replayed after its commit
is not written again; one that died before it is written anew, under a new name,
and what it left behind is never read. ``compact`` merges all rows so far into
one write that replaces them, again by one commit record.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("student_id", "window_start_ms")
COMMIT_DDL = "name string, kind string, batch_id bigint"
BATCH, BASE = "batch", "base"


class CommittedTable:
    """Upsert table over parquet folders; also a ``foreachBatch`` target.

    One writer at a time, as a streaming query is. ``compact_every`` batches are
    merged into one write, so a reader opens that many small writes at most.
    """

    def __init__(self, path: str, keys: tuple[str, ...] = KEYS, columns: list[str] | None = None, compact_every: int | None = 50):
        self.path, self.keys, self.columns, self.compact_every = path.rstrip("/"), tuple(keys), columns, compact_every

    # -------------------------------------------------------- commit log

    def commits(self, spark: SparkSession) -> list[tuple[str, str, int]]:
        """(name, kind, batch id) of the writes that count: the last base and the batches after it.

        Their number is bounded by ``compact_every``; older commit records are
        read as well, one line each.
        """
        folder = f"{self.path}/commits"
        if not _exists(spark, folder):
            return []
        rows = spark.read.schema(COMMIT_DDL).json(f"{folder}/*")
        upto = rows.agg(F.max(F.when(F.col("kind") == BASE, F.col("batch_id"))).alias("b")).first()["b"]
        live = rows if upto is None else rows.filter((F.col("batch_id") > upto) | ((F.col("kind") == BASE) & (F.col("batch_id") == upto)))
        return sorted(map(tuple, live.collect()), key=lambda c: (c[2], c[1]))

    def _stage(self, rows: DataFrame, kind: str, batch_id: int) -> str:
        name = f"{kind}-{batch_id}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/data/{name}")
        return name

    def _commit(self, spark: SparkSession, name: str, kind: str, batch_id: int) -> None:
        one = spark.createDataFrame([(name, kind, batch_id)], COMMIT_DDL).coalesce(1)
        one.write.json(f"{self.path}/commits/{name}")

    # -------------------------------------------------------- writing

    def write(self, batch: DataFrame, batch_id: int) -> bool:
        """Add a batch; False where it is in the table already."""
        spark = batch.sparkSession
        live = self.commits(spark)
        if any(done >= batch_id for _, _, done in live):
            return False
        rows = batch if self.columns is None else batch.select(*self.columns)
        name = self._stage(rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")), BATCH, batch_id)
        self._commit(spark, name, BATCH, batch_id)
        if self.compact_every and sum(kind == BATCH for _, kind, _ in live) + 1 >= self.compact_every:
            self.compact(spark)
        return True

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.write(batch, batch_id)

    def compact(self, spark: SparkSession) -> None:
        """Replace all writes so far by one with the last row of every key."""
        live = self.commits(spark)
        if len(live) < 2:
            return
        upto = live[-1][2]
        name = self._stage(self._latest(spark, live), BASE, upto)
        self._commit(spark, name, BASE, upto)

    # -------------------------------------------------------- reading

    def _latest(self, spark: SparkSession, live) -> DataFrame:
        rows = spark.read.parquet(*[f"{self.path}/data/{name}" for name, _, _ in live])
        rest = [c for c in rows.columns if c not in (*self.keys, "batch_id")]
        last = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest, "batch_id"), "batch_id").alias("last"))
        return last.select(*self.keys, "last.*")

    def read(self, spark: SparkSession) -> DataFrame:
        """The table: the row of the last committed batch per key."""
        live = self.commits(spark)
        if not live:
            raise FileNotFoundError(f"no committed write in {self.path}")
        return self._latest(spark, live).drop("batch_id")

    def unused(self, spark: SparkSession) -> list[str]:
        """Data folders that no live commit names: replaced writes, and what dead writers left."""
        live = {name for name, _, _ in self.commits(spark)}
        return sorted(x for x in _children(spark, f"{self.path}/data") if x not in live)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

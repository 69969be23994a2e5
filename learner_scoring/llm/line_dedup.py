"""Line dedup with sharded cuckoo filters over exact reference-count tables.

A line's key is the line without outer white space, A-Z lower-cased; keys of at
least ``MIN_CHARS`` code points take part. Keys are dealt to shards by hash. In a
shard the cuckoo filter holds one fingerprint per key: a key that it has not
seen is new, and only keys that it may have seen go to the exact table of
reference counts, so the table in memory holds repeated keys alone.
``LineIndex`` keeps references and filters between batches: inserting documents
and deleting them again gives back the state before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from learner_scoring.llm.common import SPACE, arrow_map, bounded_batches, raw_texts, ship_by_value, sliced
from learner_scoring.llm.cuckoo import Cuckoo, filled

MIN_CHARS = 10
#: Documents without an id are one document that comes after all others.
NO_ID = (1 << 63) - 1
#: Rows of a shard that pass through its filter at a time.
CHUNK = 1 << 16

REFS = "h1 long, h2 long, doc long"
COUNTS = "h1 long, h2 long, refs long, first_doc long, last_doc long"


def line_hash(line: str) -> bytes | None:
    """128-bit hash of a line's key, None where the key is too short."""
    key = line.strip(SPACE)
    if len(key) < MIN_CHARS:
        return None
    return xxhash.xxh3_128_digest(key.encode().lower())  # bytes.lower() changes A-Z only


def _refs(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Distinct (key, document) pairs of each row."""
    out, docs = [], []
    for raw, doc in zip(raw_texts(batch), batch.column("doc").to_pylist()):
        keys = {k for line in raw.decode().split("\n") if (k := line_hash(line))}
        out.extend(keys)
        docs.extend([doc] * len(keys))
    h = np.frombuffer(b"".join(out), np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(docs, pa.int64())], names=["h1", "h2", "doc"])


def _narrow(docs: DataFrame) -> DataFrame:
    bounded_batches(docs.sparkSession)
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), "text")


def line_refs(docs: DataFrame) -> DataFrame:
    """(h1, h2, doc): every key with every document that holds it."""
    return arrow_map(_narrow(docs), _refs, REFS)


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per key within a task, given off whenever ``8 * CHUNK`` references have come.

    Reads texts, not references, so that a task needs one Python worker and not two in a row.
    """
    held: list[pa.RecordBatch] = []
    rows = 0

    def flush():
        t = pa.Table.from_batches(held).group_by(["h1", "h2"]).aggregate([("doc", "count"), ("doc", "min"), ("doc", "max")])
        return t.select(["h1", "h2", "doc_count", "doc_min", "doc_max"]).rename_columns(["h1", "h2", "refs", "first_doc", "last_doc"])

    for b in sliced(batches):
        held.append(_refs(b))
        rows += held[-1].num_rows
        if rows >= 8 * CHUNK:
            yield from flush().to_batches()
            held, rows = [], 0
    if rows:
        yield from flush().to_batches()


def _repeated(rows: pd.DataFrame) -> pd.DataFrame:
    """One shard: exact counts of the keys that the filter calls repeated.

    First pass: each chunk's keys are looked up and, where new, inserted; hits
    and keys that are already combined from several references are candidates.
    Second pass: all rows of the candidates are summed exactly.
    """
    h1 = rows.h1.to_numpy().view(np.uint64)
    cand = rows.refs.to_numpy() > 1
    seen = Cuckoo(min(len(h1), CHUNK))
    done: list[np.ndarray] = []
    hits: list[np.ndarray] = []
    for i in range(0, len(h1), CHUNK):
        keys, first, n = np.unique(h1[i : i + CHUNK], return_index=True, return_counts=True)
        hit = seen.contains(keys)
        hits.append(keys[hit | (n > 1)])
        done.append(keys[~hit])
        if not seen.insert(keys[~hit]):  # full: twice the room
            all_keys = np.concatenate(done)
            seen = filled(all_keys, 2 * len(all_keys))
    hits.append(h1[cand])
    t = rows[np.isin(h1, np.unique(np.concatenate(hits)))]
    t = t.groupby(["h1", "h2"], sort=False).agg(refs=("refs", "sum"), first_doc=("first_doc", "min"), last_doc=("last_doc", "max"))
    return t[t.first_doc != t.last_doc].reset_index()


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards one after another from rows sorted by shard."""
    held: list[pd.DataFrame] = []

    def out(frames):
        t = _repeated(pd.concat(frames))
        return pa.RecordBatch.from_pandas(t, preserve_index=False)

    for b in batches:
        for shard, part in b.to_pandas().groupby("shard", sort=True):
            if held and held[0].shard.iat[0] != shard:
                yield out(held)
                held = []
            held.append(part)
    if held:
        yield out(held)


def n_shards(spark: SparkSession) -> int:
    """Eight shards to a shuffle partition, so shards stay small as the cluster's setting grows with the data."""
    return 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def repeated_keys(docs: DataFrame) -> DataFrame:
    """Keys held by at least two documents: (h1, h2, refs, first_doc, last_doc).

    References are combined per task before the shuffle, so a line that a third
    of all documents share arrives as one row per task.
    """
    spark = docs.sparkSession
    parts = _narrow(docs).mapInArrow(_combined, COUNTS)
    dealt = parts.withColumn("shard", F.pmod("h1", F.lit(n_shards(spark)))).repartition("shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(_shards, COUNTS)


def drops(docs: DataFrame) -> DataFrame:
    """(doc, lost): per document the keys (h1, h2) that another, smaller document keeps."""
    keep = repeated_keys(docs).select("h1", "h2", "first_doc")
    return _lost(line_refs(docs).join(keep, ["h1", "h2"]).filter("doc != first_doc"))


def _lost(refs: DataFrame) -> DataFrame:
    return refs.groupBy("doc").agg(F.collect_list(F.struct("h1", "h2")).alias("lost"))


def _lost_sets(col: pa.ListArray) -> list[set[bytes] | None]:
    """Each row's lost keys as 16-byte strings."""
    keys = col.flatten()
    flat = np.stack([keys.field(0).to_numpy(), keys.field(1).to_numpy()], axis=1).astype(np.int64).tobytes() if len(keys) else b""
    out, at = [], 0
    for n in col.value_lengths().to_pylist():
        out.append({flat[i : i + 16] for i in range(at, at + 16 * n, 16)} if n else None)
        at += 16 * (n or 0)
    return out


def clean_lines(raw: bytes, lost: set[bytes] | None) -> tuple[str, int, int]:
    """(text without its lost lines, lines before, lines dropped)."""
    text = raw.decode()
    lines = text.split("\n")
    if not lost:
        return text, len(lines), 0
    kept = [x for x in lines if line_hash(x) not in lost]
    return "\n".join(kept), len(lines), len(lines) - len(kept)


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with every repeated line gone but in the smallest doc_id holding it.

    Adds n_lines and n_dropped to the columns of ``docs`` (replacing columns so
    named). Null and empty texts are one empty line and come out empty; rows
    without doc_id are one document after all others; rows with the same doc_id
    are one document, so lines they share with each other alone stay.
    """
    return without_lines(docs, drops(docs))


def without_lines(docs: DataFrame, lost: DataFrame) -> DataFrame:
    """``docs`` without the lines that :func:`drops` tells for each, with n_lines and n_dropped."""
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    text = f"c{names.index('text')}"
    keyed = docs.select(names).toDF(*[f"c{i}" for i in range(len(names))])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keyed.schema) + ", n_lines long, n_dropped long"
    fields = keyed.columns
    doc = F.coalesce(F.col(f"c{names.index('doc_id')}").cast("long"), F.lit(NO_ID))
    joined = keyed.withColumn("doc", doc).join(lost, "doc", "left").drop("doc")

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [clean_lines(r, x) for r, x in zip(raw_texts(batch, text), _lost_sets(batch.column("lost")))]
        cols = [pa.array([r[0] for r in rows], pa.string()) if f == text else batch.column(f) for f in fields]
        cols += [pa.array([r[i] for r in rows], pa.int64()) for i in (1, 2)]
        return pa.RecordBatch.from_arrays(cols, names=[*fields, "n_lines", "n_dropped"])

    return arrow_map(joined, apply, schema).toDF(*names, "n_lines", "n_dropped")


class LineIndex:
    """References and filters of the lines inserted so far, in a shared folder.

    ``refs`` holds the exact table (shard, h1, h2, doc, since), ``filters`` one
    cuckoo filter per shard; every change writes a new version and then adds its
    number to the table ``versions``, so a job that dies half-way leaves the last
    whole version in force, and an existing folder is gone on with. ``shards``
    holds for a new folder; one writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, shards: int = 64):
        self.spark, self.path, self.shards, self.version = spark, path.rstrip("/"), shards, 0
        last = self._last()
        if last:
            self.version, self.shards = last
        else:
            self._write(spark.createDataFrame([], self._REFS), spark.createDataFrame([], "shard long, filter binary"))

    _REFS = "shard long, " + REFS + ", since long"
    _VERSIONS = "version long, shards long"

    def _last(self) -> tuple[int, int] | None:
        """(version, shards) of the last whole version in the folder."""
        try:
            told = self.spark.read.schema(self._VERSIONS).parquet(f"{self.path}/versions")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        row = told.orderBy(F.desc("version")).first()
        return (row["version"], row["shards"]) if row else None

    def _write(self, refs: DataFrame, filters: DataFrame) -> None:
        to = f"{self.path}/v{self.version + 1}"
        refs.write.mode("overwrite").parquet(f"{to}/refs")
        filters.write.mode("overwrite").parquet(f"{to}/filters")
        row = self.spark.createDataFrame([(self.version + 1, self.shards)], self._VERSIONS)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/versions")
        self.version += 1

    def refs(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/v{self.version}/refs")

    def filters(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/v{self.version}/filters")

    def counts(self) -> DataFrame:
        """The exact reference counts: (h1, h2, refs, first_doc)."""
        return self.refs().groupBy("h1", "h2").agg(F.count("*").alias("refs"), F.min("doc").alias("first_doc"))

    def _sharded(self, refs: DataFrame) -> DataFrame:
        return refs.distinct().withColumn("shard", F.pmod("h1", F.lit(self.shards))).select("shard", "h1", "h2", "doc")

    def maybe_known(self, docs: DataFrame) -> DataFrame:
        """(h1, h2, known) of the documents' keys; known is exact.

        The filter answers first; only keys that it may hold are looked up in
        the exact table.
        """

        def probe(key, keys: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
            h = keys.h1.to_numpy().view(np.uint64)
            maybe = Cuckoo.of_bytes(state["filter"].iat[0]).contains(h) if len(state) else np.zeros(len(h), bool)
            return keys[["h1", "h2"]].assign(maybe=maybe)

        keys = self._sharded(line_refs(docs)).select("shard", "h1", "h2").distinct()
        probed = keys.groupBy("shard").cogroup(self.filters().groupBy("shard")).applyInPandas(probe, "h1 long, h2 long, maybe boolean")
        exact = self.counts().select("h1", "h2", F.lit(True).alias("held"))
        hits = probed.filter("maybe").join(exact, ["h1", "h2"], "left")
        return hits.select("h1", "h2", F.coalesce("held", F.lit(False)).alias("known")).union(
            probed.filter("not maybe").select("h1", "h2", F.lit(False))
        )

    def _change(self, keys: DataFrame, insert: bool) -> DataFrame:
        def change(key, rows: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
            h = np.sort(rows.h1.to_numpy().view(np.uint64))
            f = Cuckoo.of_bytes(state["filter"].iat[0]) if len(state) else Cuckoo(max(64, len(h)))
            if not insert:
                f.delete(h)
            elif not f.insert(h):
                return pd.DataFrame({"shard": [key[0]], "filter": [None]})  # built anew below
            return pd.DataFrame({"shard": [key[0]], "filter": [f.to_bytes()]})

        return keys.groupBy("shard").cogroup(self.filters().groupBy("shard")).applyInPandas(change, "shard long, filter binary")

    def insert(self, docs: DataFrame) -> None:
        """Add documents; a document already held adds nothing."""
        new = self._sharded(line_refs(docs)).join(self.refs(), ["shard", "h1", "h2", "doc"], "left_anti")
        held = self.refs().select("shard", "h1", "h2").distinct()
        first = new.select("shard", "h1", "h2").distinct().join(held, ["shard", "h1", "h2"], "left_anti")
        refs = self.refs().unionByName(new.withColumn("since", F.lit(self.version + 1).cast("long")))
        self._store(refs, self._change(first, True))

    def delete(self, docs: DataFrame) -> None:
        """Take documents (by doc_id) out again."""
        gone = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc")).distinct()
        refs = self.refs().join(gone, "doc", "left_anti").select("shard", "h1", "h2", "doc", "since")
        keys = ["shard", "h1", "h2"]
        last = self.refs().select(keys).distinct().join(refs.select(keys).distinct(), keys, "left_anti")
        self._store(refs, self._change(last, False))

    def dedup(self, docs: DataFrame) -> DataFrame:
        """:func:`dedup_lines` of a batch that comes after the documents inserted so far.

        A line stays in the document that was inserted with it first (the smallest
        doc_id of that batch), and a line that no inserted document holds in the
        smallest doc_id of this batch. The index does not change: ``insert`` the
        same documents to keep them; the answer for them is then the same.
        """
        refs = line_refs(docs).distinct()
        known = self.maybe_known(docs).filter("known").select("h1", "h2")
        held = self.refs().join(known, ["h1", "h2"], "left_semi")
        keeper = held.groupBy("h1", "h2").agg(F.min(F.struct("since", "doc"))["doc"].alias("keeper"))
        first = repeated_keys(docs).select("h1", "h2", "first_doc")
        told = refs.join(keeper, ["h1", "h2"], "left").join(first, ["h1", "h2"], "left")
        return without_lines(docs, _lost(told.filter("doc != coalesce(keeper, first_doc, doc)")))

    def _store(self, refs: DataFrame, changed: DataFrame) -> None:
        def anew(key, rows: pd.DataFrame) -> pd.DataFrame:
            h = rows.h1.to_numpy().view(np.uint64)
            return pd.DataFrame({"shard": [key[0]], "filter": [filled(h, 2 * len(h)).to_bytes()]})

        full = changed.filter("filter is null").select("shard")
        grown = refs.join(full, "shard", "left_semi").select("shard", "h1", "h2").distinct()
        grown = grown.groupBy("shard").applyInPandas(anew, "shard long, filter binary")
        self._write(refs, changed.filter("filter is not null").unionByName(grown))


ship_by_value(__name__)

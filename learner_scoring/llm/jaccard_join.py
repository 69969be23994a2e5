"""N-gram Jaccard join over size-banded tiles with hashed bitmap signatures.

Shingles have one fixed order. Two sets that reach the threshold share one of
the first few shingles of each (how many depends on the size), so documents meet
in the tile of a shingle and a band of sizes. A bitmap signature, where every
shingle flips one bit, bounds the overlap from above by counting differing bits;
pairs that pass are settled by intersecting the sorted shingle arrays.

Components need no list of all pairs: first every document of a tile is tried
against the tile's pivot, then documents beside a large component against some
of its members; at last only documents of different components that still meet
in a tile are tried against each other.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learner_scoring.llm.common import arrow_map, bounded_batches, cut, raw_texts, ship_by_value, sliced, small
from learner_scoring.llm.components import connected
from learner_scoring.llm.substring_dedup import gram_hashes, word_hashes

WORDS = 4
PERCENT = 85
#: 64-bit words of a bitmap signature.
SIG = 8
#: Hash buckets (a fixed number) whose loads tell frequent shingles from rare ones.
BUCKET_BITS = 23
PART_BITS = 16
#: Buckets above so many times the mean load, plus a margin, come last in the order.
HEAVY, MARGIN = 2, 8
#: Documents that make a component large.
LARGE = 4
#: Bytes of text handled at a time.
SLICE = 1 << 20
#: Rows of one tile that are held at a time.
TILE_ROWS = 1 << 18

_SIG = [f"b{i}" for i in range(SIG)]


def shingle_set(raw: bytes, k: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the text's k-word shingles, A-Z lower-cased; a shorter text is one shingle."""
    words = raw.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(gram_hashes(word_hashes(words), min(k, len(words))))


def signature(h: np.ndarray) -> np.ndarray:
    """Parity bitmap: bit i is set if an odd number of shingles fall on it.

    It has ``64 * SIG`` bits, or for larger sets the power of two up to their size.
    """
    bits = max(64 * SIG, 1 << max(0, len(h).bit_length() - 1))
    odd = np.bincount((h & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def folded(sig: np.ndarray, words: int) -> np.ndarray:
    """The signature the same set has in fewer 64-bit words."""
    return np.bitwise_xor.reduce(sig.reshape(-1, words), axis=0)


def most_common(x: np.ndarray, y: np.ndarray, n1: int, n2: int) -> int:
    """Upper bound of the overlap: every differing bit costs one shingle of either set."""
    w = min(len(x), len(y))
    return (n1 + n2 - int(np.bitwise_count(folded(x, w) ^ folded(y, w)).sum())) // 2


def prefix_length(n: int, percent: int) -> int:
    """Shingles of which a set must share one with any set at the threshold."""
    return n - (percent * n + 99) // 100 + 1


def _summaries(k: int):
    """Per document (doc, n, signature); at a task's end its loads, as compressed parts."""
    size, part = 1 << BUCKET_BITS, 1 << PART_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loads = np.zeros(size, np.uint16)
        most = 0xFFFF  # a task that meets more has settled the bucket

        def out(docs, n, sigs, full, parts, blobs):
            cols = [pa.array(docs, pa.int64()), pa.array(n, pa.int64()), *(pa.array(c, pa.int64()) for c in sigs)]
            cols += [pa.array(full, pa.binary()), pa.array(parts, pa.int32()), pa.array(blobs, pa.binary())]
            return pa.RecordBatch.from_arrays(cols, names=["doc", "n", *_SIG, "full", "part", "loads"])

        for b in sliced(batches, SLICE):
            sets = [shingle_set(raw, k) for raw in raw_texts(b)]
            at, new = np.unique((np.concatenate(sets) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32), return_counts=True)
            loads[at] = np.minimum(loads[at] + new, most)
            sigs = [signature(x) for x in sets]
            short = np.stack([folded(x, SIG) for x in sigs])
            full = [x.tobytes() if len(x) > SIG else None for x in sigs]
            none = [None] * len(sets)
            yield out(b.column("doc_id").to_pylist(), [len(x) for x in sets], list(short.T), full, none, none)
        used = [i for i in range(size // part) if loads[i * part : (i + 1) * part].any()]
        blobs = [zlib.compress(loads[i * part : (i + 1) * part].tobytes(), 1) for i in used]
        none = [None] * len(used)
        yield out(none, none, [none] * SIG, none, used, blobs)

    return run


def frequent_buckets(parts: DataFrame, least: float) -> np.ndarray:
    """Bit map of the buckets with a load above ``least``; 2**BUCKET_BITS bits, whatever the data."""
    part = 1 << PART_BITS

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for p, raw in zip(b.column("part").to_pylist(), b.column("loads").to_pylist()):
                sums[p] = sums.get(p, 0) + np.frombuffer(zlib.decompress(raw), np.uint16).astype(np.int64)
        rows = [pa.array(list(sums), pa.int32()), pa.array([np.packbits(v > least).tobytes() for v in sums.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(rows, names=["part", "bits"])

    out = np.zeros((1 << (BUCKET_BITS - PART_BITS), part // 8), np.uint8)
    for r in parts.repartition("part").mapInArrow(add, "part int, bits binary").collect():
        out[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def _prefix_rows(hot, k: int, percent: int):
    """(token, doc, n, pos) of each document's first shingles; a text's second copy in a task is (first, doc, -1, 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(hot.value).view(bool)
        first: dict[bytes, int] = {}
        for b in sliced(batches, SLICE):
            tokens, docs, sizes, places = [], [], [], []
            for doc, raw in zip(b.column("doc_id").to_pylist(), raw_texts(b)):
                words = raw.lower().split()
                if not words:
                    continue
                text = xxhash.xxh3_128_digest(b" ".join(words))
                if (rep := first.setdefault(text, doc)) != doc:
                    tokens.append(np.array([rep]))
                    docs.append(np.array([doc]))
                    sizes.append(np.array([-1]))
                    places.append(np.array([0]))
                    continue
                h = shingle_set(raw, k)
                late = bits[(h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]
                n = len(h)
                p = prefix_length(n, percent)
                chosen = h[~late][:p]
                if len(chosen) < p:
                    chosen = np.concatenate([chosen, h[late][: p - len(chosen)]])
                tokens.append(chosen.view(np.int64))
                docs.append(np.full(p, doc, np.int64))
                sizes.append(np.full(p, n, np.int64))
                places.append(np.arange(p))
            if tokens:
                cols = [pa.array(np.concatenate(c), pa.int64()) for c in (tokens, docs, sizes, places)]
                yield pa.RecordBatch.from_arrays(cols, names=["token", "doc", "n", "pos"])

    return run


def _tile_rows(percent: int):
    """Rows sorted by (token, n): those of tiles with company, with the pivots of their own and the next lower band."""
    width = -math.log(percent / 100) if percent < 100 else 1e-9

    def settle(t: np.ndarray, n: np.ndarray, d: np.ndarray, p: np.ndarray):
        new = np.concatenate([[True], t[1:] != t[:-1]])
        tile = np.cumsum(new) - 1
        alone = np.bincount(tile)[tile] == 1
        t, n, d, p, tile = t[~alone], n[~alone], d[~alone], p[~alone], tile[~alone]
        if not len(t):
            return None
        band = np.floor(np.log(n) / width).astype(np.int64)
        start = np.concatenate([[True], (tile[1:] != tile[:-1]) | (band[1:] != band[:-1])])
        run = np.cumsum(start) - 1
        at = np.flatnonzero(start)
        lower = np.concatenate([[-1], np.arange(len(at) - 1)])  # the run before, if it is the next band of the same tile
        fits = np.concatenate([[False], (tile[at][1:] == tile[at][:-1]) & (band[at][1:] == band[at][:-1] + 1)])
        own = d[at][run]
        low = np.where(fits, d[at][lower], d[at])[run]
        return t, n, d, p, own, low, at

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 4

        def out(cols):
            return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["token", "n", "doc", "pos", "own", "low"])

        for b in batches:
            t, n, d, p = (b.column(c).to_numpy() for c in ("token", "n", "doc", "pos"))
            copy = n < 0
            if copy.any():
                yield out((t[copy], n[copy], d[copy], p[copy], t[copy], t[copy]))
            t, n, d, p = (np.concatenate([h, x[~copy]]) for h, x in zip(held, (t, n, d, p)))
            if not len(t):
                continue
            last = t == t[-1]
            whole = 0 if last.all() else len(t) - int(last[::-1].argmin())
            if len(t) - whole > TILE_ROWS:  # a long tile: settle what is there and go on with its last pivots
                done = settle(t, n, d, p)
                yield out(done[:6])
                held = [x[done[6][-2:]] for x in done[:4]]
                continue
            done = settle(t[:whole], n[:whole], d[:whole], p[:whole]) if whole else None
            if done:
                yield out(done[:6])
            held = [t[whole:], n[whole:], d[whole:], p[whole:]]
        done = settle(*held) if len(held[0]) else None
        if done:
            yield out(done[:6])

    return run


def _reaches(common, n1, n2, percent: int):
    return 100 * common >= percent * (n1 + n2 - common)


def _may_link(x: str, y: str, percent: int, words: int = SIG):
    """Sizes fit, and the differing signature bits leave room for the overlap."""
    n1, n2 = F.col(f"{x}.n"), F.col(f"{y}.n")
    apart = sum((F.bit_count(F.col(f"{x}.{b}").bitwiseXOR(F.col(f"{y}.{b}"))) for b in _SIG[1:words]), F.bit_count(F.col(f"{x}.b0").bitwiseXOR(F.col(f"{y}.b0"))))
    most = F.floor((n1 + n2 - apart) / 2)
    return (100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)) & _reaches(most, n1, n2, percent)


def _bounded(pairs: DataFrame, sig: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose signatures leave room for the threshold: short ones first, then those of larger sets."""
    short = sig.drop("full")
    near = pairs.join(short.alias("x"), F.col("a") == F.col("x.doc")).join(short.alias("y"), F.col("b") == F.col("y.doc"))
    near = near.filter(_may_link("x", "y", percent)).select("a", "b").distinct()
    long = sig.filter("full is not null").select("doc", "n", "full")
    met = near.join(long.toDF("a", "n1", "f1"), "a", "left").join(long.toDF("b", "n2", "f2"), "b", "left")

    def test(b: pa.RecordBatch) -> pa.RecordBatch:
        ok = []
        for n1, n2, x, y in zip(*(b.column(c).to_pylist() for c in ("n1", "n2", "f1", "f2"))):
            # a set without a longer signature has passed with its short one
            ok.append(not x or not y or _reaches(most_common(np.frombuffer(x, np.int64), np.frombuffer(y, np.int64), n1, n2), n1, n2, percent))
        return b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return arrow_map(met, test, "a long, b long").distinct()


def _rows_by_component(met: DataFrame, comps: DataFrame) -> DataFrame:
    """Tile rows with their document's component."""
    moved = small(comps.filter("id <> comp").select(F.col("id").alias("doc"), "comp"))
    return met.join(moved, "doc", "left").withColumn("comp", F.coalesce("comp", "doc"))


def _verified(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose shingle sets reach the threshold, by exact intersection."""
    asked = cut(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
    some = docs.join(small(asked), "doc_id", "left_semi").select("doc_id", "text")

    def sets(b: pa.RecordBatch) -> pa.RecordBatch:
        hs = [shingle_set(raw, k).tobytes() for raw in raw_texts(b)]
        return pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(hs, pa.binary())], names=["doc", "h"])

    # written: read by both sides, and a task of the joins then needs one Python worker, not two in a row
    arrays = cut(arrow_map(some, sets, "doc long, h binary"))
    one = arrays.select(F.col("doc").alias("a"), F.col("h").alias("ha"))
    two = arrays.select(F.col("doc").alias("b"), F.col("h").alias("hb"))

    def test(b: pa.RecordBatch) -> pa.RecordBatch:
        ok = []
        for x, y in zip(b.column("ha").to_pylist(), b.column("hb").to_pylist()):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            ok.append(both > 0 and _reaches(both, len(x), len(y), percent))
        return b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return arrow_map(pairs.join(one, "a").join(two, "b").select("a", "b", "ha", "hb"), test, "a long, b long").distinct()


def linked(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    Sets link at 100 * |intersection| >= percent * |union|; component_id is the
    smallest doc_id reachable over links, the document's own included. Null and
    empty texts and texts without words have no shingles and link with nothing.
    Rows without doc_id have no component (null). Rows with the same doc_id are
    one document, linked by whatever either text links. Other columns are not
    read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = narrow.filter("doc_id is not null")
    schema = f"doc long, n long, {', '.join(f'{c} long' for c in _SIG)}, full binary, part int, loads binary"
    told = cut(narrow.mapInArrow(_summaries(k), schema))
    sizes = told.filter("part is null").drop("part", "loads")
    sig = sizes.filter("doc is not null and n > 0").distinct()

    load = (sizes.agg(F.sum("n")).first()[0] or 0) / (1 << BUCKET_BITS)
    hot = spark.sparkContext.broadcast(frequent_buckets(told.filter("part is not null").select("part", "loads"), HEAVY * load + MARGIN))
    prefixes = known.mapInArrow(_prefix_rows(hot, k, percent), "token long, doc long, n long, pos long")
    sorted_rows = prefixes.repartition("token").sortWithinPartitions("token", "n", "doc")
    tiles = cut(sorted_rows.mapInArrow(_tile_rows(percent), "token long, n long, doc long, pos long, own long, low long"))

    copies = tiles.filter("n < 0").select(F.col("doc").alias("a"), F.col("token").alias("b"))
    met = tiles.filter("n > 0")
    star = met.select("doc", F.explode(F.array_distinct(F.array("own", "low"))).alias("other")).filter("doc <> other")
    star = cut(star.select(F.least("doc", "other").alias("a"), F.greatest("doc", "other").alias("b")).distinct())
    near = cut(_bounded(star, sig, percent))
    links = cut(copies.union(_verified(near, known, k, percent)))
    comps = connected(links)

    met = met.select("token", "doc", "n", "pos")
    tried = near

    def settle(pairs: DataFrame, comps: DataFrame, tried: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Components and pairs tried after the given pairs, each tried once."""
        rest = cut(_bounded(pairs.join(tried, ["a", "b"], "left_anti"), sig, percent))
        more = cut(_verified(rest, known, k, percent))
        if not more.isEmpty():
            comps = connected(comps.filter("id <> comp").select(F.col("id").alias("a"), F.col("comp").alias("b")).union(more))
        return comps, tried.union(rest)

    pair = F.least("x.doc", "y.doc").alias("a"), F.greatest("x.doc", "y.doc").alias("b")
    fits = 100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")

    # documents that met a large component are tried against one of its members in each tile, another in every tile
    rows = _rows_by_component(met, comps)
    large = small(cut(comps.groupBy("comp").agg(F.count("*").alias("c")).filter(F.col("c") >= LARGE).select("comp")))
    picks = rows.join(large, "comp", "left_semi").groupBy("token", "comp").agg(
        F.min_by(F.struct("doc", "n"), F.xxhash64("doc", "token")).alias("p")
    )
    picks = picks.select("token", "comp", "p.*")
    some = rows.alias("x").join(picks.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.comp") != F.col("y.comp")) & fits)
    comps, tried = settle(some.select(*pair).distinct(), comps, tried)

    # tiles that still hold several components: the rows outside the tile's largest one against all of other components
    rows = _rows_by_component(met, comps)
    tops = rows.groupBy("token").agg(F.mode("comp").alias("top"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    quick = sig.select("doc", *[F.col(_SIG[i]).bitwiseXOR(F.col(_SIG[i + SIG // 2])).alias(_SIG[i]) for i in range(SIG // 2)])
    mixed = rows.join(tops.filter("lo < hi").select("token", "top"), "token").join(quick, "doc")
    x, y = mixed.filter("comp <> top").alias("x"), mixed.alias("y")
    meet = (F.col("x.token") == F.col("y.token")) & (F.col("x.comp") != F.col("y.comp"))
    once = (F.col("y.comp") == F.col("y.top")) | (F.col("x.doc") < F.col("y.doc"))
    # at their first common shingle, no more than what is left of either set is common
    need = percent * (F.col("x.n") + F.col("y.n"))
    first = ((100 + percent) * (F.col("x.n") - F.col("x.pos")) >= need) & ((100 + percent) * (F.col("y.n") - F.col("y.pos")) >= need)
    rest = x.join(y, meet & once & first & _may_link("x", "y", percent, SIG // 2))
    comps, _ = settle(rest.select(*pair).distinct(), comps, tried)
    out = sizes.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"))
    out = out.join(comps.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("comp", "doc_id").alias("component_id"))


def keep_first(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The document with the smallest doc_id of every component, with all its columns; rows without doc_id stay."""
    names = docs.columns
    keyed = docs.toDF(*[f"c{i}" for i in range(len(names))])
    doc = f"c{names.index('doc_id')}"
    first = linked(docs, k, percent).filter("doc_id = component_id").select(F.col("doc_id").alias(doc)).distinct()
    kept = keyed.join(first, doc, "left_semi").dropDuplicates([doc])
    return kept.unionByName(keyed.filter(F.col(doc).isNull())).toDF(*names)


ship_by_value(__name__)

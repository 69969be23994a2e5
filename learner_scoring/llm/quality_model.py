"""Quality classifier: random-indexing word vectors, pooled, under a small network.

Every token bucket has a sparse random index vector. A bucket's word vector is
its own index vector plus the sum of its neighbours' over the whole corpus,
each at unit length. A text is the mean and the spread of its tokens' vectors,
with its length and the shares of tokens that repeat their neighbour.
A two-layer network scores it, and a temperature fitted on rows kept out of
the network's training calibrates the probability.
"""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learner_scoring.llm.common import arrow_map, bounded_batches, checkpoint_root, cut, raw_texts, ship_by_value, sliced

#: Runs of letters and digits (bytes beyond ASCII count as letters), and single other characters.
TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^\s0-9A-Za-z\x80-\xff]")
#: Token buckets, dimensions, neighbours on each side, non-zero entries of an index vector.
BUCKETS = 8192
DIM = 32
WINDOW = 2
NONZERO = 4
#: Labelled rows the network is fitted on, at most; one in five of them calibrates.
SAMPLE = 20_000
CALIBRATE_EVERY = 5
HIDDEN = 32
EPOCHS = 60
RATE = 0.01
DECAY = 1e-4
THRESHOLD = 0.7
HELD_OUT = 2
#: Token ids handled at once, and bytes of a text split at once.
SLICE = 1 << 15
PIECE = 1 << 20
#: Row blocks of the table of context sums.
PARTS = 16
#: Mean and spread per dimension, share of tokens equal to the one and two before, length.
FEATURES = 2 * DIM + 3


def index_vectors() -> np.ndarray:
    """Sparse random rows of +1 and -1, one per bucket, and a row of zeros for breaks."""
    r = np.random.default_rng(13)
    out = np.zeros((BUCKETS + 1, DIM), np.float32)
    place = r.random((BUCKETS, DIM)).argsort(1)[:, :NONZERO]
    out[np.arange(BUCKETS)[:, None], place] = r.choice([-1.0, 1.0], (BUCKETS, NONZERO))
    return out


def token_ids(raw: bytes):
    """Arrays of the bucket ids of a text, piece by piece; pieces end at white space."""
    start = 0
    while start < len(raw):
        end = min(start + PIECE, len(raw))
        if end < len(raw):
            space = max(raw.rfind(b" ", start, end), raw.rfind(b"\n", start, end))
            end = space if space > start else end
        yield np.array([crc32(t) for t in TOKEN.findall(raw, start, end)], np.int64) % BUCKETS
        start = end


def _context(ids: np.ndarray, index: np.ndarray, sums: np.ndarray) -> None:
    """Add to ``sums`` the index vectors around each id; id BUCKETS is a break."""
    for s in range(0, len(ids), SLICE):
        lo, hi = max(0, s - WINDOW), min(len(ids), s + SLICE + WINDOW)
        near = index[ids[lo:hi]]
        total = np.cumsum(np.vstack([np.zeros((1, DIM), np.float32), near]), axis=0)
        at = np.arange(s, min(s + SLICE, len(ids))) - lo
        own = ids[s : s + SLICE]
        around = total[np.minimum(at + WINDOW + 1, len(near))] - total[np.maximum(at - WINDOW, 0)] - near[at]
        order = np.argsort(own, kind="stable")
        keys, first = np.unique(own[order], return_index=True)
        sums[keys] += np.add.reduceat(around[order], first, axis=0).astype(np.int64)


def _sums(batches):
    """Context sums of a task's texts, as row blocks of the table; rows without a count are left out."""
    from pyspark import TaskContext

    index, sums = index_vectors(), np.zeros((BUCKETS + 1, DIM), np.int64)
    gap = np.full(WINDOW, BUCKETS)
    held, n = [], 0
    for b in sliced(batches):
        for raw in raw_texts(b):
            for ids in token_ids(raw):
                held.append(ids)
                n += len(ids)
                if n >= SLICE:  # the last ids stay as neighbours of the next piece
                    ids = np.concatenate(held)
                    _context(ids, index, sums)
                    ids = ids[-2 * WINDOW :]
                    _context(ids, index, extra := np.zeros_like(sums))
                    sums -= extra
                    held, n = [ids], len(ids)
            held.append(gap)
            n += WINDOW
    if held:
        _context(np.concatenate(held), index, sums)
    key = TaskContext.get().partitionId()
    step = BUCKETS // PARTS
    for p in range(PARTS):
        block = sums[p * step : (p + 1) * step]
        used = np.flatnonzero(block.any(1))
        if len(used):
            yield _block(p, key, used, block[used])


def _block(part: int, key: int, used: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    top = int(np.abs(values).max(initial=0))
    wide = 2 if top < 1 << 15 else 4 if top < 1 << 31 else 8
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([key], pa.int32()), pa.array([wide], pa.int32()), pa.array([used.astype(np.int16).tobytes()], pa.binary()), pa.array([values.astype(f"i{wide}").tobytes()], pa.binary())],
        names=["part", "key", "wide", "used", "sums"],
    )


_SUMS = "part int, key int, wide int, used binary, sums binary"


def _add(table: pa.Table) -> pa.Table:
    """One row block out of several."""
    total = np.zeros((BUCKETS // PARTS, DIM), np.int64)
    for b in table.to_batches():
        for r in b.to_pylist():
            total[np.frombuffer(r["used"], np.int16)] += np.frombuffer(r["sums"], f"i{r['wide']}").reshape(-1, DIM)
    first = table.slice(0, 1).to_pylist()[0]
    used = np.flatnonzero(total.any(1))
    return pa.Table.from_batches([_block(first["part"], first["key"], used, total[used])])


def word_vectors(texts: DataFrame) -> np.ndarray:
    """(BUCKETS, DIM) word vectors out of all of ``texts``; the table's size is fixed.

    Tasks add up their texts, sums are added in two rounds of about the square
    root of the tasks each, and the driver gets the PARTS added row blocks.
    """
    spark = texts.sparkSession
    bounded_batches(spark)
    parts = texts.rdd.getNumPartitions()
    few = min(max(parts, 1), 4 * spark.sparkContext.defaultParallelism)  # partial tables grow with the cores, not the data
    partial = texts.coalesce(few).mapInArrow(_sums, _SUMS)
    round1 = partial.withColumn("salt", F.pmod("key", F.lit(max(1, int(few**0.5))))).groupBy("part", "salt")
    added = round1.applyInArrow(lambda t: _add(t.drop_columns(["salt"])), _SUMS).groupBy("part").applyInArrow(_add, _SUMS)
    context = np.zeros((BUCKETS, DIM))
    step = BUCKETS // PARTS
    for r in added.collect():  # at most PARTS rows
        at = r["part"] * step + np.frombuffer(r["used"], np.int16)
        context[at] = np.frombuffer(r["sums"], f"i{r['wide']}").reshape(-1, DIM)

    def unit(m):
        return m / np.maximum(np.sqrt((m * m).sum(1, keepdims=True)), 1e-12)

    return unit(index_vectors()[:-1].astype(np.float64)) + unit(context)


def pooled(raw: bytes, vectors: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """Mean and spread of a text's word vectors, shares of repeated tokens, and the logarithm of its length."""
    counts, n, again = np.zeros(BUCKETS), 0, np.zeros(2)
    last = np.zeros(0, np.int64)
    for ids in token_ids(raw):
        counts += np.bincount(ids, minlength=BUCKETS)
        n += len(ids)
        run = np.concatenate([last, ids])
        for lag in (1, 2):
            new = run[max(len(last), lag) :]
            again[lag - 1] += (new == run[max(len(last), lag) - lag : len(run) - lag]).sum()
        last = run[-2:]
    out = np.zeros(FEATURES, np.float32)
    if n:
        used = np.flatnonzero(counts)
        share = counts[used] / n
        mean = share @ vectors[used]
        out[:DIM] = mean
        out[DIM : 2 * DIM] = np.sqrt(np.maximum(share @ squares[used] - mean * mean, 0))
        out[2 * DIM : -1] = again / n
        out[-1] = np.log1p(n) / 8
    return out


def fit(x: np.ndarray, y: np.ndarray, calibrate: np.ndarray) -> dict:
    """A two-layer network (Adam, cross entropy) and its temperature; a constant where labels are one-sided."""
    if len(set(y.tolist())) < 2:
        return {"constant": float((y.sum() + 1) / (len(y) + 2))}
    r = np.random.default_rng(13)
    mid, scale = x.mean(0), x.std(0) + 1e-3
    z = (x - mid) / scale
    train = ~calibrate if len(set(y[~calibrate].tolist())) == 2 else np.ones(len(y), bool)
    zt, yt = z[train], y[train].astype(np.float64)
    p = {"w1": r.normal(0, (2 / z.shape[1]) ** 0.5, (z.shape[1], HIDDEN)), "b1": np.zeros(HIDDEN), "w2": r.normal(0, HIDDEN**-0.5, HIDDEN), "b2": np.zeros(1)}
    m, v = {k: np.zeros_like(w) for k, w in p.items()}, {k: np.zeros_like(w) for k, w in p.items()}
    size, step = min(256, len(yt)), 0
    epochs = max(EPOCHS, 2000 * size // len(yt))
    for e in range(epochs):
        rate = RATE * (1 - e / epochs)
        deal = r.permutation(len(yt))
        for s in range(0, len(yt), size):
            xb, yb = zt[deal[s : s + size]], yt[deal[s : s + size]]
            h = np.maximum(xb @ p["w1"] + p["b1"], 0)
            d = (1 / (1 + np.exp(-np.clip(h @ p["w2"] + p["b2"], -60, 60))) - yb) / len(yb)
            dh = np.outer(d, p["w2"]) * (h > 0)
            step += 1
            for k, g in {"w1": xb.T @ dh, "b1": dh.sum(0), "w2": h.T @ d, "b2": d.sum(keepdims=True)}.items():
                g = g + DECAY * p[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    model = {**p, "mid": mid, "scale": scale, "t": 1.0}
    kept = calibrate if calibrate.any() and not calibrate.all() else np.ones(len(y), bool)
    raw, yc = logits(model, x[kept]), y[kept]
    grid = np.exp(np.linspace(np.log(0.2), np.log(8), 200))  # temperature with the least cross entropy
    ones = yc.sum()
    want = np.where(yc == 1, (ones + 1) / (ones + 2), 1 / (len(yc) - ones + 2))  # never sure, however few the rows
    loss = [(want * np.logaddexp(0, -raw / t) + (1 - want) * np.logaddexp(0, raw / t)).mean() for t in grid]
    model["t"] = float(grid[int(np.argmin(loss))])
    return model


def logits(model: dict, x: np.ndarray) -> np.ndarray:
    h = np.maximum((x - model["mid"]) / model["scale"] @ model["w1"] + model["b1"], 0)
    return h @ model["w2"] + model["b2"]


def probabilities(model: dict, x: np.ndarray) -> np.ndarray:
    if "constant" in model:
        return np.full(len(x), model["constant"])
    return 1 / (1 + np.exp(-np.clip(logits(model, x) / model["t"], -60, 60)))


def _features(vectors: np.ndarray):
    squares = vectors * vectors

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [pooled(x, vectors, squares).tobytes() for x in raw_texts(batch)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.binary())], names=["doc_id", "features"])

    return run


def _matrix(rows) -> np.ndarray:
    return np.frombuffer(b"".join(rows), np.float32).reshape(-1, FEATURES).astype(np.float64)


def held_out(doc_id="doc_id") -> F.Column:
    """Rows whose labels are never learned from; rows without doc_id have none to learn."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Word vectors cover all texts, held out or not; labels are learned only from
    rows that are not held out, from at most ``sample`` rows in hash order. Null
    texts count as empty and are scored like any text; repeated rows are scored
    each; of several labels of one doc_id the larger counts. Without labels the
    score is 0.5, with labels of one kind their share. An empty table gives no
    rows; only doc_id, text and quality are read.
    """
    spark = docs.sparkSession
    checkpoint_root(spark)
    vectors = word_vectors(docs.select("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    features = cut(arrow_map(docs.select("doc_id", "text"), _features(vectors), f"doc_id {kind}, features binary"))
    marks = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = features.join(F.broadcast(marks), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "features").limit(sample)
    rows = rows.select("features", "quality", (F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(CALIBRATE_EVERY)) == 0).alias("c")).collect()  # at most ``sample`` rows
    model = fit(_matrix([r["features"] for r in rows]), np.array([r["quality"] for r in rows]) == 1, np.array([r["c"] for r in rows], bool)) if rows else {"constant": 0.5}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        p = probabilities(model, _matrix(batch.column("features").to_pylist()))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p)], names=["doc_id", "score"])

    scored = arrow_map(features, run, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


ship_by_value(__name__)

"""Hard negatives by threshold joins over blocks, after the L2AP scheme.

Vectors are packed into blocks. A block's inverted index lists its rows per
group of dimensions; rows omit the tail whose suffix norm cannot reach the
threshold alone. Scores are accumulated index group by index group, rows are
pruned by what the remaining norms still allow, and survivors are completed
exactly. Anchors whose windows (the positives, then the negatives of each
positive) are not full come back with a lower threshold; the last threshold
leaves nothing out, so results are exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from learner_scoring.llm.common import bounded_batches, cut, ship_by_value, small

POSITIVES = 5
NEGATIVES = 3
#: Anchors are the rows whose vec_id this divides.
ANCHOR_EVERY = 50
#: Rows of a block, anchors of a group, dimensions of an index group.
BLOCK = 8192
GROUP = 512
DIMS = 8
#: Anchors are sent to all executors up to this many bytes, beyond that they are joined by shuffle.
BROADCAST_BYTES = 32 << 20
#: Falling thresholds of positives, as shares of anchor norm x largest norm; None takes every row.
POSITIVE_LEVELS = (0.6, 0.3, 0.15, 0.0, None)
#: Falling thresholds of negatives, as shares of the positive's score; the last is the window's lower end.
NEGATIVE_LEVELS = (0.85, 0.675, 0.5)
_LONG = (1 << 63) - 1

BLOCK_SCHEMA = "block long, n long, dims long, wide int, top double, ids binary, labels binary, vectors binary"


def prepared(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, q): rows that take part, with moved labels and whole-number components."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select("vec_id", "label", x).filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & finite)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    q = F.transform(x, lambda v: F.floor(256 * v.cast("double")).cast("long"))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), q.alias("q"))


def _wide(m: np.ndarray) -> int:
    top = int(np.abs(m).max(initial=0))
    return 2 if top < 1 << 15 else 4 if top < 1 << 31 else 8


def _matrix(lists: pa.ListArray) -> np.ndarray:
    """Rows of a list column as a matrix; shorter rows end in zeros."""
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), int(sizes.max(initial=0))), np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if len(flat):
        out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def _pack(batches):
    """The rows of a partition as blocks sorted by label."""

    def block(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        labels = rows["label"].to_numpy()
        order = np.argsort(labels, kind="stable")
        m = _matrix(rows["q"].chunk(0))[order]
        wide = _wide(m)
        top = float(np.sqrt((m.astype(np.float64) ** 2).sum(1)).max(initial=0))
        cols = [key, len(m), m.shape[1], wide, top, rows["vec_id"].to_numpy()[order].tobytes(), labels[order].tobytes(), m.astype(f"i{wide}").tobytes()]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.binary(), pa.binary(), pa.binary()]
        names = [f.split()[0] for f in BLOCK_SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cols, kinds)], names=names)

    from pyspark import TaskContext

    key = TaskContext.get().partitionId() << 20
    held, n = [], 0
    for b in batches:
        while b.num_rows:
            take = b.slice(0, BLOCK - n)
            held, n, b = held + [take], n + take.num_rows, b.slice(take.num_rows)
            if n == BLOCK:
                yield block(pa.Table.from_batches(held))
                held, n, key = [], 0, key + 1
    if n:
        yield block(pa.Table.from_batches(held))


def _unpack(row: dict, side: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels = (np.frombuffer(row[side + c], np.int64) for c in ("ids", "labels"))
    m = np.frombuffer(row[side + "vectors"], f"i{row[side + 'wide']}").reshape(row[side + "n"], row[side + "dims"])
    return ids, labels, m


def _anchor_rows(every: int):
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                ids, labels, m = _unpack(row)
                at = np.flatnonzero(ids % every == 0)
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((row["block"] << 20) + at), pa.array(ids[at]), pa.array(labels[at]), pa.array(list(m[at].astype(np.int64)), pa.list_(pa.int64()))],
                        names=["aid", "anchor_id", "label", "q"],
                    )

    return run


def _padded(m: np.ndarray, dims: int) -> np.ndarray:
    return m if m.shape[1] == dims else np.pad(m, ((0, 0), (0, dims - m.shape[1])))


def _tails(m: np.ndarray) -> np.ndarray:
    """Suffix norms at the start of each group of dimensions, and 0 at the end."""
    sq = np.add.reduceat(m * m, np.arange(0, m.shape[1], DIMS), axis=1) if m.shape[1] else np.zeros((len(m), 0))
    tail = np.cumsum(sq[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.hstack([tail, np.zeros((len(m), 1))]))


def threshold_scores(a: np.ndarray, x: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows of x, scores): exact scores of all rows that may reach ``low`` with some anchor.

    ``low`` is one threshold per anchor; -inf takes all rows. Dimensions go by
    falling weight in ``x``, so suffix norms fall fast.
    """
    if not x.shape[1]:
        return np.arange(len(x)), np.zeros((len(a), len(x)))
    xf, af = x.astype(np.float64), a.astype(np.float64)
    order = np.argsort(-(xf * xf).sum(0), kind="stable")
    xf, af = xf[:, order], af[:, order]
    nx, na = _tails(xf), _tails(af)
    # what a row's norm must reach: the least over the anchors, less a little for rounding
    with np.errstate(divide="ignore", invalid="ignore"):
        need = np.where(low > 0, low / np.where(na[:, 0] > 0, na[:, 0], 1e-300), 0.0).min(initial=np.inf) * (1 - 1e-9)
    slack = 1e-9 * na[:, 0].max(initial=0) * nx[:, 0].max(initial=0)
    rows = np.flatnonzero(nx[:, 0] >= need)  # a row shorter than that has no entry in the index
    listed = (nx[rows, :-1] >= need).sum(1)  # index groups of a row; its tail from there on is covered
    score = np.zeros((len(a), len(rows)))
    starts = range(0, xf.shape[1], DIMS)
    for g, s in enumerate(starts):
        here = listed > g
        score[:, here] += af[:, s : s + DIMS] @ xf[rows[here], s : s + DIMS].T
        if need > 0:
            rest = np.minimum(g + 1, listed)
            keep = (score + na[:, rest] * nx[rows, rest] >= low[:, None] - slack).any(0)
            rows, listed, score = rows[keep], listed[keep], score[:, keep]
    for g, s in enumerate(starts):  # complete survivors with what the index omitted
        omitted = listed <= g
        if omitted.any():
            score[:, omitted] += af[:, s : s + DIMS] @ xf[rows[omitted], s : s + DIMS].T
    biggest = float(np.abs(xf).max(initial=0)) * float(np.abs(af).max(initial=0)) * xf.shape[1]
    if biggest >= 1 << 53:  # beyond exact doubles: whole numbers of any size, held to the range of long
        exact = a.astype(object) @ x[rows].astype(object).T
        return rows, np.clip(exact, -_LONG - 1, _LONG)
    return rows, score


def _best(score: np.ndarray, ok: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, row) of the k best allowed rows of each anchor: by score, then smaller id."""
    if score.dtype != object and score.shape[1] > k:
        masked = np.where(ok, score, -np.inf)
        kth = np.partition(masked, score.shape[1] - k, axis=1)[:, score.shape[1] - k]
        ok = ok & (masked >= kth[:, None])
    i, j = np.nonzero(ok)
    if not len(i):
        return i, j
    order = np.lexsort((ids[j], i)) if score.dtype == object else np.lexsort((ids[j], -score[i, j], i))
    i, j = i[order], j[order]
    if score.dtype == object:
        order = sorted(range(len(i)), key=lambda p: (i[p], -score[i[p], j[p]]))
        i, j = i[order], j[order]
    rank = np.arange(len(i)) - np.searchsorted(i, i)
    return i[rank < k], j[rank < k]


def _found(row: dict, ids, i, j, rows, score, extra) -> pa.RecordBatch:
    aid = np.frombuffer(row["a_aids"], np.int64)
    values = score[i, j]
    values = pa.array([int(v) for v in values], pa.int64()) if score.dtype == object else pa.array(values.astype(np.int64))
    return pa.RecordBatch.from_arrays([pa.array(aid[i]), extra, pa.array(ids[rows[j]]), values], names=["aid", "slot", "vec_id", "score"])


def _positives(row: dict):
    """Best rows of the anchors' own labels in one block, above the anchors' thresholds."""
    ids, labels, x = _unpack(row)
    _, wanted, a = _unpack(row, "a_")
    low = np.frombuffer(row["a_low"], np.float64)
    aid = np.frombuffer(row["a_aids"], np.int64)
    dims = max(x.shape[1], a.shape[1])
    x, a = _padded(x, dims), _padded(a, dims)
    for label in np.unique(wanted):
        mine = np.flatnonzero(wanted == label)
        lo, hi = np.searchsorted(labels, [label, label + 1])
        if lo == hi:
            continue
        rows, score = threshold_scores(a[mine], x[lo:hi], low[mine])
        rows = rows + lo
        itself = (aid[mine] >> 20 == row["block"])[:, None] & ((aid[mine] & 0xFFFFF)[:, None] == rows)
        i, j = _best(score, (score >= low[mine, None]) & ~itself, ids[rows], POSITIVES)
        if len(i):
            yield _found(row, ids, mine[i], j, rows, _spread(score, mine, len(a)), pa.nulls(len(i), pa.int32()))


def _spread(score: np.ndarray, mine: np.ndarray, n: int) -> np.ndarray:
    """Scores of some anchors as rows of all anchors."""
    if len(mine) == n:
        return score
    out = np.zeros((n, score.shape[1]), score.dtype)
    out[mine] = score
    return out


def _negatives(row: dict):
    """Best rows of other labels in one block for every open window of the anchors."""
    ids, labels, x = _unpack(row)
    _, own, a = _unpack(row, "a_")
    low = np.frombuffer(row["a_lows"], np.int64).reshape(len(own), POSITIVES)
    high = np.frombuffer(row["a_highs"], np.int64).reshape(len(own), POSITIVES)
    dims = max(x.shape[1], a.shape[1])
    x, a = _padded(x, dims), _padded(a, dims)
    open_ = low <= high
    least = np.where(open_, low, _LONG).min(1).astype(np.float64)
    rows, score = threshold_scores(a, x, least)
    other = own[:, None] != labels[rows]
    for w in range(POSITIVES):
        ok = other & open_[:, w, None] & (score >= low[:, w, None]) & (score <= high[:, w, None])
        i, j = _best(score, ok, ids[rows], NEGATIVES)
        if len(i):
            yield _found(row, ids, i, j, rows, score, pa.array(np.full(len(i), w + 1, np.int32)))


def _joined(blocks: DataFrame, anchors: DataFrame, n: int, dims: int, lists: list[str], kernel) -> DataFrame:
    """All blocks with all groups of anchors, through ``kernel``.

    ``anchors`` has aid, anchor_id, label, q and the named list or number columns.
    Groups are sent to every executor while their bytes are few; beyond that
    blocks and groups meet by shuffle on (group, part of the blocks).
    """
    spark = blocks.sparkSession
    groups = -(-n // GROUP)

    def pack(batches):
        from pyspark import TaskContext

        key = TaskContext.get().partitionId()
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held).combine_chunks()
        m = _matrix(t["q"].chunk(0))
        wide = _wide(m)
        cols = [key, len(m), m.shape[1], wide, t["aid"].to_numpy().tobytes(), t["anchor_id"].to_numpy().tobytes(), t["label"].to_numpy().tobytes(), m.astype(f"i{wide}").tobytes()]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32()] + [pa.binary()] * 4
        for c in lists:
            values = t[c].chunk(0)
            flat = values.flatten() if pa.types.is_list(values.type) else values
            cols.append(flat.to_numpy(zero_copy_only=False).tobytes())
            kinds.append(pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cols, kinds)], names=names)

    names = ["a_group", "a_n", "a_dims", "a_wide", "a_aids", "a_ids", "a_labels", "a_vectors"] + [f"a_{c}" for c in lists]
    schema = "a_group int, a_n long, a_dims long, a_wide int, " + ", ".join(f"{c} binary" for c in names[4:])
    packed = anchors.repartition(groups).mapInArrow(pack, schema)
    dealt = blocks.withColumn("a_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    if n * dims * 8 <= BROADCAST_BYTES:
        met = dealt.join(F.broadcast(packed), "a_group")
    else:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = dealt.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(parts)))
        packed = packed.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
        met = dealt.join(packed, ["a_group", "part"])

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                (row,) = b.slice(i, 1).to_pylist()
                yield from kernel(row)

    return met.mapInArrow(run, "aid long, slot int, vec_id long, score long")


def _top(found: DataFrame, k: int, *keys: str) -> DataFrame:
    """The k best rows of each key; Spark cuts groups to k before the shuffle as well."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def mine(vectors: DataFrame, anchor_every: int = ANCHOR_EVERY) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Rows without vec_id, label or vector, and rows with a null or non-finite
    component, take no part. Shorter vectors end in zeros; an empty vector scores
    0. Repeated rows are rows of their own, as anchors, positives and negatives;
    an anchor is never its own positive. Components and scores beyond the range of
    long are held to it. An empty table gives no rows; other columns are not read.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = cut(prepared(vectors))
    blocks = cut(rows.repartition(max(1, -(-rows.count() // BLOCK))).mapInArrow(_pack, BLOCK_SCHEMA))
    size = blocks.agg(F.max("top").alias("top"), F.max("dims").alias("dims")).first()  # two numbers
    if size["dims"] is None:
        return spark.createDataFrame([], schema)
    top, dims = size["top"], max(1, size["dims"])
    anchors = blocks.mapInArrow(_anchor_rows(anchor_every), "aid long, anchor_id long, label long, q array<long>")
    norm = F.sqrt(F.aggregate("q", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))
    shared = rows.groupBy("label").agg((F.count("*") - 1).alias("others"))
    anchors = anchors.withColumn("norm", norm).join(small(cut(shared)), "label").withColumn("need", F.least("others", F.lit(POSITIVES)))
    anchors = cut(anchors.drop("others"))

    positives, waiting = None, anchors
    for level in POSITIVE_LEVELS:
        n = waiting.count()
        if not n:
            break
        low = F.lit(float("-inf")) if level is None else F.col("norm") * (level * top)
        found = _joined(blocks, waiting.select("aid", "anchor_id", "label", "q", low.alias("low")), n, dims, ["low"], _positives)
        found = cut(_top(found, POSITIVES, "aid").select("aid", "vec_id", "score", "place"))
        have = found.groupBy("aid").agg(F.count("*").alias("have"))
        marked = cut(waiting.join(have, "aid", "left").withColumn("full", F.coalesce("have", F.lit(0)) >= F.col("need")))
        full = found.join(marked.filter("full").select("aid"), "aid")
        positives = full if positives is None else positives.unionByName(full)
        waiting = marked.filter("not full").drop("have", "full")
    if positives is None:
        return spark.createDataFrame([], schema)
    positives = cut(positives)

    # a window per positive: from half of its score to 95 % of it
    p = F.col("score")
    windows = positives.filter("score >= 0").select(
        "aid", F.col("place").alias("slot"), p.alias("ps"), F.expr("score - score div 2").alias("floor"),
        F.expr("score - score div 20 - if(score % 20 > 0, 1, 0)").alias("high"),
    )
    waiting, kept = cut(windows), None
    for level in NEGATIVE_LEVELS:
        last = level == NEGATIVE_LEVELS[-1]
        low = F.col("floor") if last else F.greatest(F.col("floor"), F.floor(F.col("ps") * level).cast("long"))
        asked = waiting.withColumn("low", low).groupBy("aid").agg(
            *[F.coalesce(F.max(F.when(F.col("slot") == s, F.col(c))), F.lit(closed)).alias(f"{c}{s}")
              for c, closed in (("low", _LONG), ("high", -_LONG)) for s in range(1, POSITIVES + 1)]
        )
        asked = asked.select("aid", *[F.array(*[f"{c}{s}" for s in range(1, POSITIVES + 1)]).alias(f"{c}s") for c in ("low", "high")])
        asked = cut(anchors.select("aid", "anchor_id", "label", "q").join(asked, "aid"))
        n = asked.count()
        if not n:
            break
        found = _joined(blocks, asked, n, dims, ["lows", "highs"], _negatives)
        found = cut(_top(found, NEGATIVES, "aid", "slot"))
        have = found.groupBy("aid", "slot").agg(F.count("*").alias("have"))
        marked = cut(waiting.join(have, ["aid", "slot"], "left").withColumn("full", F.lit(last) | (F.coalesce("have", F.lit(0)) >= NEGATIVES)))
        full = found.join(marked.filter("full").select("aid", "slot"), ["aid", "slot"])
        kept = full if kept is None else kept.unionByName(full)
        waiting = marked.filter("not full").drop("have", "full")
    if kept is None:
        return spark.createDataFrame([], schema)
    negatives = kept.select("aid", "slot", F.col("place").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    known = positives.select("aid", F.col("place").alias("slot"), F.col("vec_id").alias("positive_id"), p.alias("positive_score"))
    out = negatives.join(known, ["aid", "slot"]).join(anchors.select("aid", "anchor_id"), "aid")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ship_by_value(__name__)

"""Embedding near-dedup by dual traversal of cover trees.

Vectors of one label are dealt to cells by their nearest center, cells to
blocks of bounded size, and every block becomes a cover tree. Pairs of blocks
whose covering radii rule out a link are dropped; the others are traversed
against each other, which finds exactly the pairs at the threshold. A task hands
on link counts and a spanning set of links, never the list of all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learner_scoring.llm.common import cut, ship_by_value
from learner_scoring.llm.components import connected
from learner_scoring.llm.cover_tree import CoverTree, distance, dual

COSINE = 0.98
#: Vectors of a block, and the most centers of a label.
BLOCK = 2048
CENTERS = 256


def _unit(rows) -> np.ndarray:
    x = np.stack([np.asarray(r, np.float64) for r in rows])
    # scaled first, so that tiny and huge components neither vanish nor overflow
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(embedding: str = "embedding"):
    """True where every component is a finite number and one is not zero."""
    e = F.col(embedding)
    finite = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(finite & F.exists(e, lambda v: v != 0), F.lit(False))


def _assign(key, rows: pd.DataFrame, centers: pd.DataFrame) -> pd.DataFrame:
    out = rows[["grp", "id", "twin", "copies", "embedding"]].copy()
    if not len(rows):
        return out.assign(cell=pd.Series(dtype=np.int64))
    centers = centers.sort_values("salt")
    near = (_unit(rows.embedding) @ _unit(centers.center).T).argmax(axis=1)
    return out.assign(cell=centers.salt.to_numpy(np.int64)[near])


def _block(rows: pd.DataFrame) -> pd.DataFrame:
    """One row per block: its vectors, ids and copies as bytes, and a ball around them."""
    rows = rows.sort_values(["id", "twin"])
    x = _unit(rows.embedding)
    center = x.mean(axis=0)
    length = np.linalg.norm(center)
    center = center / length if length > 0 else x[0]
    blob = [x.tobytes()], [rows.id.to_numpy(np.int64).tobytes()], [rows.copies.to_numpy(np.int64).tobytes()], [rows.twin.to_numpy(np.int64).tobytes()]
    radius = float(distance(x @ center).max())
    return pd.DataFrame(
        {"grp": [rows.grp.iat[0]], "block": [int(rows.cell.iat[0]) * (1 << 32) + int(rows["sub"].iat[0])], "center": [center], "radius": [radius], "n": [len(x)],
         "vectors": blob[0], "ids": blob[1], "copies": blob[2], "twins": blob[3]}
    )


def _roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest place reachable over the links u-v, for n places."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        np.minimum.at(new, root[u], low)
        np.minimum.at(new, root[v], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _traverse(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                out = pair_links(row, cosine)
                if len(out[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=["id", "twin", "links", "root"])

    return run


def pair_links(row: dict, cosine: float):
    """(id, twin, links, root) of the linked vectors of two blocks; links count copies of the other side.

    ``twin`` tells vectors with one id apart.
    """

    def side(s: str):
        ids = np.frombuffer(row[f"ids_{s}"], np.int64)
        x = np.frombuffer(row[f"vectors_{s}"], np.float64).reshape(len(ids), -1).copy()
        return CoverTree(x), ids, np.frombuffer(row[f"copies_{s}"], np.int64), np.frombuffer(row[f"twins_{s}"], np.int64)

    one = row["block_x"] == row["block_y"]
    a, ids_a, n_a, twin_a = side("x")
    b, ids_b, n_b, twin_b = (a, ids_a, n_a, twin_a) if one else side("y")
    found = dual(a, b, cosine)
    ids_a, n_a, twins = ids_a[a.order], n_a[a.order], twin_a[a.order]
    if one:
        ids, n, shift = ids_a, n_a, 0
    else:
        ids, n, shift = np.concatenate([ids_a, ids_b[b.order]]), np.concatenate([n_a, n_b[b.order]]), len(ids_a)
        twins = np.concatenate([twins, twin_b[b.order]])
    links = np.zeros(len(ids), np.int64)
    us, vs = [], []
    for lo, hi, lo2, hi2, mask in found:
        left, right = np.arange(lo, hi), np.arange(lo2, hi2) + shift
        if mask is None:
            mask = np.ones((hi - lo, hi2 - lo2), bool)
        if one and lo2 <= lo < hi2:  # rows of a node against the node itself: all of its pairs, each from both ends
            links[left] += mask @ n[right] - n[left] * mask[np.arange(hi - lo), left - lo2]
        else:
            links[left] += mask @ n[right]
            links[right] += mask.T @ n[left]
        i, j = np.nonzero(mask)
        us.append(left[i])
        vs.append(right[j])
    if not us:
        return ids[:0], twins[:0], links[:0], ids[:0]
    root = _roots(len(ids), np.concatenate(us), np.concatenate(vs))
    hit = links > 0
    return ids[hit], twins[hit], links[hit], ids[root[hit]]


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``.

    Rows link where labels are equal and not null, lengths are equal and the
    cosine, in double precision, is at least ``cosine``; n_links counts the other
    rows linked, equal ones included. Vectors that are null, empty, zero or hold
    null or non-finite components, and rows without label, link with nothing.
    Rows without vec_id link with nothing, have no component and are kept. Rows
    with one vec_id are one vector in the components. An empty table gives no
    rows; other columns are not read.
    """
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", "embedding", F.concat_ws(":", "label", F.size("embedding")).alias("grp"), "label")
    rows = rows.withColumn("ok", usable() & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    classes = cut(rows.filter("ok").groupBy("grp", "embedding").agg(F.min("vec_id").cast("long").alias("id"), F.count("*").alias("copies")).withColumn("twin", F.xxhash64("grp", "embedding")))

    # cells: a center for about every ``block`` vectors of a label
    sizes = classes.groupBy("grp").agg(F.ceil(F.count("*") / block).alias("blocks"))
    sized = classes.join(sizes, "grp")
    centers = sized.withColumn("salt", F.pmod(F.xxhash64("id"), F.least("blocks", F.lit(CENTERS)))).groupBy("grp", "salt", "blocks")
    centers = centers.agg(F.min_by("embedding", F.xxhash64("embedding")).alias("center"))
    centers = centers.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    centers = centers.select("grp", "chunk", "salt", "center").toDF("g", "part", "salt", "center")
    dealt = sized.withColumn("chunk", F.pmod(F.xxhash64("embedding"), F.col("blocks")))
    kind = classes.schema["embedding"].dataType.simpleString()
    cells = dealt.groupBy("grp", "chunk").cogroup(centers.groupBy("g", "part")).applyInPandas(
        _assign, f"grp string, id long, twin long, copies long, embedding {kind}, cell long"
    )
    cells = cut(cells)
    counts = cells.groupBy("grp", "cell").agg(F.ceil(F.count("*") / block).alias("subs"))
    parted = cells.join(counts, ["grp", "cell"]).withColumn("sub", F.pmod(F.xxhash64("embedding", "id"), F.col("subs")))
    blocks = cut(parted.groupBy("grp", "cell", "sub").applyInPandas(
        _block, "grp string, block long, center array<double>, radius double, n long, vectors binary, ids binary, copies binary, twins binary"
    ))

    # block pairs that the covering radii leave
    reach = float(distance(np.array(cosine))) + 1e-9
    light = blocks.select("grp", "block", "center", "radius")
    x = light.toDF("grp", "block_x", "cx", "rx")
    y = light.toDF("grp", "block_y", "cy", "ry")
    dot = F.aggregate(F.zip_with("cx", "cy", lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    apart = F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * dot))
    pairs = x.join(y, "grp").filter("block_x <= block_y").filter((F.col("block_x") == F.col("block_y")) | (apart <= F.col("rx") + F.col("ry") + reach))
    full = blocks.select("grp", "block", "vectors", "ids", "copies", "twins")
    tasks = pairs.select("grp", "block_x", "block_y")
    tasks = tasks.join(full.toDF("grp", "block_x", "vectors_x", "ids_x", "copies_x", "twins_x"), ["grp", "block_x"])
    tasks = tasks.join(full.toDF("grp", "block_y", "vectors_y", "ids_y", "copies_y", "twins_y"), ["grp", "block_y"])
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = cut(tasks.repartition(width, "grp", "block_x", "block_y").mapInArrow(_traverse(cosine), "id long, twin long, links long, root long"))

    comps = connected(found, "id", "root")
    links = found.groupBy("id", "twin").agg(F.sum("links").alias("links"))
    known = classes.join(links, ["id", "twin"], "left").join(comps, "id", "left")
    known = known.select("grp", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("comp", "id").alias("comp"))
    good = rows.filter("ok").join(known, ["grp", "embedding"]).select("vec_id", "n_links", F.col("comp").alias("component_id"))
    bad = rows.filter("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"))
    return good.union(bad).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


ship_by_value(__name__)

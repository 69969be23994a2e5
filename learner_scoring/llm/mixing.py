"""Mixing sources to target weights by hash thresholds; DataFrame functions only.

Every document has a fixed hash. Words are summed by source and hash bucket; the
bucket where a source's budget runs out is cut into finer buckets, and only that
one, until it holds next to nothing. What lies below the threshold is taken:
no sort, and the same documents on every run. A budget above the source's size
takes every document once and those below the threshold once more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from learner_scoring.llm.common import WORD, cut, small

#: Weights of the sources in order of their names (code points, null last), repeating.
WEIGHTS = (3, 1, 2)
#: Words of the mix in percent of all words, and a source's most words over its own.
BUDGET_PERCENT = 150
MAX_REPEATS = 2
#: Hex digits of the hash per level, and levels: 16**9 buckets a source in the end.
DIGITS = 3
LEVELS = 3
SEED = "mix-1"


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def doc_hash(doc_id: Column, text: Column) -> Column:
    """The document's place, as ``DIGITS * LEVELS`` hex digits; equal rows share it."""
    key = F.concat(F.lit(SEED + ":"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.substring(F.md5(key), 1, DIGITS * LEVELS)


def targets(sized: DataFrame) -> DataFrame:
    """(source, source_size, target): the sources' shares of the budget.

    The excess of sources at their limit goes to the others by weight: all end at
    ``min(limit, level * weight)`` for one level. With sources in order of
    limit / weight, those before the level's place stand at their limits.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    place = (F.row_number().over(by_name) - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in WEIGHTS]), place + 1)
    t = sources.withColumn("weight", weight).withColumn("limit", F.col("source_size") * MAX_REPEATS)
    ratio = F.col("limit") / F.col("weight")
    order = Window.orderBy(ratio, F.col("source").isNull(), F.col("source"))
    everyone = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    budget = F.sum("source_size").over(everyone) * F.lit(BUDGET_PERCENT / 100)
    left = budget - F.coalesce(F.sum("limit").over(before), F.lit(0))
    rest = F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    t = t.withColumn("level", left / rest).withColumn("open", F.col("level") <= ratio)
    level = F.min(F.when(F.col("open"), F.struct(ratio.alias("r"), "level"))).over(everyone)["level"]
    target = F.least(F.col("limit").cast("double"), F.col("weight") * F.coalesce(level, F.lit(0.0)))
    return t.select("source", "source_size", target.alias("target"))


def thresholds(sized: DataFrame, shares: DataFrame) -> DataFrame:
    """(source, source_size, target, full, bar): copies that everyone gets, and the
    hash prefix below which documents get one more.

    Each level sums words by bucket inside the last level's boundary bucket; the
    boundary is the bucket where the running sum first goes past what is left of
    the budget. The last boundary bucket is taken whole if that lands nearer.
    """
    size, want = F.col("source_size"), F.col("target")
    full = F.when(size > 0, F.floor(want / size)).otherwise(0).cast("long")
    edge = shares.withColumn("full", full).withColumn("left", want - full * size).withColumn("bar", F.lit(""))
    for level in range(1, LEVELS + 1):
        edge = cut(edge)
        keys = small(edge.select(F.col("source").alias("s"), "bar"))
        inside = sized.join(keys, F.col("source").eqNullSafe(F.col("s")) & (F.substring("hash", 1, (level - 1) * DIGITS) == F.col("bar")))
        sums = inside.groupBy("s", F.substring("hash", 1, level * DIGITS).alias("bucket")).agg(F.sum("size").alias("words"))
        run = Window.partitionBy("s").orderBy("bucket")
        sums = sums.withColumn("upto", F.sum("words").over(run))
        joined = edge.drop("words").join(sums, F.col("source").eqNullSafe(F.col("s")), "left")
        past = F.col("upto") > F.col("left")
        first = F.min(F.when(past, F.struct("bucket", "words", "upto")))
        edge = joined.groupBy("source", "source_size", "target", "full", "left").agg(first.alias("b"), F.max("upto").alias("whole"))
        below = F.coalesce(F.col("b.upto") - F.col("b.words"), F.col("whole"), F.lit(0))
        # without a boundary the bucket holds no more than what is left: a bar above all hashes takes it whole
        edge = edge.withColumn("words", F.coalesce("b.words", F.lit(0))).withColumn("bar", F.coalesce("b.bucket", F.lit("g"))).withColumn("left", F.col("left") - below)
        edge = edge.select("source", "source_size", "target", "full", "left", "bar", "words")
    nearer = (F.col("words") > 0) & (F.col("words") - F.col("left") < F.col("left"))
    return edge.withColumn("bar", F.when(nearer, F.concat("bar", F.lit("g"))).otherwise(F.col("bar"))).drop("left", "words")


def mixed(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies) for every row of ``docs``.

    ``copies`` is 0, 1 or 2 and ``taken`` = copies * size, so no document goes
    past twice its size. Null texts and texts without words have size 0; rows
    with null source are one source, named last; rows equal in doc_id and text
    are taken alike; an empty table gives no rows. Other columns are not read.
    """
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"), doc_hash(F.col("doc_id"), F.col("text")).alias("hash"))
    sized = cut(rows)
    bars = small(cut(thresholds(sized, targets(sized)).withColumnRenamed("source", "s")))
    both = sized.join(bars, F.col("source").eqNullSafe(F.col("s")))
    # a bar is shorter than the hash or ends in "g", above all hex digits
    copies = F.col("full") + (F.col("hash") < F.col("bar")).cast("long")
    copies = F.least(copies, F.lit(MAX_REPEATS).cast("long"))
    return both.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies.alias("copies"), "source", "hash")


def mix(docs: DataFrame) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken.

    Documents without words carry no weight and come once if their hash is below
    their source's threshold or their source is taken whole.
    """
    names = docs.columns
    keyed = docs.toDF(*[f"c{i}" for i in range(len(names))])
    c = {n: F.col(f"c{i}") for i, n in enumerate(names)}
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"), doc_hash(F.col("doc_id"), F.col("text")).alias("hash"))
    sized = cut(rows)
    bars = small(cut(thresholds(sized, targets(sized)).select(F.col("source").alias("s"), "full", "bar")))
    both = keyed.join(bars, c["source"].cast("string").eqNullSafe(F.col("s")))
    copies = F.least(F.col("full") + (doc_hash(c["doc_id"], c["text"]) < F.col("bar")).cast("long"), F.lit(MAX_REPEATS).cast("long"))
    each = both.withColumn("copy", F.explode(F.when(copies > 0, F.sequence(F.lit(1).cast("long"), copies))))
    return each.drop("s", "full", "bar", "copy").toDF(*names)

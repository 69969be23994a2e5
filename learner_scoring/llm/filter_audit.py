"""Filter interaction audit: what each filter removes in every order of the filters.

Four filters look at one text. The fifth, duplicates, is an existential
self-join: a left-semi join on hash, exact text and a smaller doc_id. Its ids
are united with the other failures, the bits of each document are combined,
and documents are counted per part and bit combination. All orders are then
read off those counts, without going back to the documents.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learner_scoring.llm.common import cut, small

#: The filters; letter i fails with bit 2**i.
FILTERS = "ABCDE"
MIN_WORDS = 100
MIN_DISTINCT_PERCENT = 80
MAX_CAPITALS_PERCENT = 10
#: Characters that filter D looks for (fixed by the contract).
SYMBOLS = "[#$%&*|]"
DUPLICATE = 1 << FILTERS.index("E")
#: Rows of one hash that one task of the self-join takes; larger groups are dealt over several.
GROUP_ROWS = 10_000
#: Salted groups are at most this many, so their table is small enough to send to every executor.
MAX_SALTED = 10_000


def text_flags(text) -> F.Column:
    """Bits of filters A to D for a text column without nulls."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n = F.size(words)
    failed = [
        n < MIN_WORDS,
        100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * n,
        100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > MAX_CAPITALS_PERCENT * F.length(text),
        text.rlike(SYMBOLS),
    ]
    bits = F.lit(0)
    for i, c in enumerate(failed):
        bits = bits + F.when(c, 1 << i).otherwise(0)
    return bits


def duplicates(docs: DataFrame, narrow: DataFrame) -> DataFrame:
    """(doc_id, part, h) of every row whose text a smaller doc_id has too.

    ``narrow`` (doc_id, part, h, ...) has the hashes of ``docs`` (doc_id, part,
    h, text). Texts are compared for hashes with several doc_ids only. The right
    side of the semi join has one row per distinct text with its smallest
    doc_id, combined before the shuffle; left rows of a very common text are
    dealt over salts, for which the right row is repeated.
    """
    held = narrow.groupBy("h").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("n"))
    several = cut(held.filter("lo < hi").select("h", "n"))
    per_task = max(GROUP_ROWS, narrow.count() // MAX_SALTED)  # so no more than MAX_SALTED hashes have salts
    salts = several.filter(F.col("n") > per_task).select("h", F.ceil(F.col("n") / per_task).alias("salts"))
    salts = F.broadcast(cut(salts))

    def salted(df):
        return df.join(salts, "h", "left").withColumn("salts", F.coalesce("salts", F.lit(1).cast("long")))

    def dealt(df):
        return df.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("salts"))).drop("salts")

    def repeated(df):
        return df.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).drop("salts")

    wanted = small(cut(repeated(salted(several.select("h")))))
    left = dealt(salted(docs)).join(wanted, ["h", "salt"], "left_semi")
    firsts = repeated(salted(left.groupBy("h", "text").agg(F.min("doc_id").alias("first"))))
    right = firsts.toDF("rh", "rtext", "first", "rsalt")
    same = (F.col("h") == F.col("rh")) & (F.col("salt") == F.col("rsalt")) & (F.col("text") == F.col("rtext"))
    return left.join(right, same & (F.col("first") < F.col("doc_id")), "left_semi").select("doc_id", "part", "h")


def combinations(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """(part, bits, n, good, toxic): documents per part and combination of failed filters.

    Null texts count as empty, null parts as the empty string. Every row is
    counted, repeated ones too; a row is a duplicate only of a smaller doc_id, so
    rows with one doc_id, and rows without doc_id, are none of each other. A
    document is good (toxic) where any label row of its doc_id says 1; label rows
    without doc_id count for nothing. Only the named columns are read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    docs = docs.withColumn("h", F.xxhash64("text"))
    narrow = cut(docs.select("doc_id", "part", "h", text_flags(F.col("text")).alias("bits")))
    failed = narrow.withColumn("n", F.lit(1)).unionByName(
        duplicates(docs, narrow).withColumns({"bits": F.lit(DUPLICATE), "n": F.lit(0)})
    )
    combined = failed.groupBy("doc_id", "part", "h").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    marks = labels.groupBy(F.col("doc_id").alias("label_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    rows = combined.join(marks, F.col("doc_id") == F.col("label_id"), "left")
    return rows.groupBy("part", "bits").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )


def steps(filters: str = FILTERS) -> list[tuple[str, int, int, int]]:
    """(order, step, bit of the step's filter, bits of the filters before it) for every order."""
    bit = {c: 1 << i for i, c in enumerate(filters)}
    return [
        ("".join(p), i + 1, bit[c], sum(bit[x] for x in p[:i])) for p in permutations(filters) for i, c in enumerate(p)
    ]


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step, zeros included.

    kept, removed, redundant, unique_fails, good_lost and toxic_lost as counts of
    documents; shapley is the filter's removals summed over all orders: a document
    that fails k filters is removed by each of them in 1/k of the orders. A table
    without rows has no parts and gives no rows.
    """
    counts = cut(combinations(docs, labels, part))
    listed = ", ".join(f"struct('{o}', {s}, {b}, {before})" for o, s, b, before in steps())
    rows = counts.withColumn("s", F.explode(F.expr(f"array({listed})")))
    rows = rows.select("part", "bits", "n", "good", "toxic", F.col("s.col1").alias("filter_order"), F.col("s.col2").alias("step"), F.col("s.col3").alias("bit"), F.col("s.col4").alias("before"))
    bits, bit, before = F.col("bits"), F.col("bit"), F.col("before")
    fails = bits.bitwiseAND(bit) != 0
    here = fails & (bits.bitwiseAND(before) == 0)

    def total(cond, value):
        return F.sum(F.when(cond, value).otherwise(F.lit(0).cast("long")))

    out = rows.groupBy("part", "filter_order", "step").agg(
        total(bits.bitwiseAND(bit.bitwiseOR(before)) == 0, F.col("n")).alias("kept"),
        total(here, F.col("n")).alias("removed"),
        total(fails & ~here, F.col("n")).alias("redundant"),
        total(bits == bit, F.col("n")).alias("unique_fails"),
        total(here, F.col("good")).alias("good_lost"),
        total(here, F.col("toxic")).alias("toxic_lost"),
        total(fails, F.expr(f"n * ({factorial(len(FILTERS))} div bit_count(bits))")).alias("shapley"),
    )
    return out

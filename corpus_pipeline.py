"""Corpus pipeline: quality rules, line dedup, near duplicates, mixing, tokens.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from learner_scoring.llm import bpe, jaccard_join, line_dedup, mixing, quality_rules
from learner_scoring.llm.common import checkpoint_root, read
from learner_scoring.llm.queries import VOCABULARY

#: Near duplicates of the pipeline: shingles of five words, similarity of 0.8 or more.
SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a hard rule, or any rule on a rejected host, go."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines stay in the smallest document alone; n_chars follows the text."""
    from pyspark.sql import functions as F

    out = line_dedup.dedup_lines(docs).drop("n_lines", "n_dropped")
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return jaccard_join.keep_first(docs, SHINGLE_WORDS, SIMILARITY_PERCENT)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, with their digests."""
    import public_tokenizers

    return bpe.encoded(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, keep_ids=True)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("ngram_jaccard", near_duplicates),
    ("mixing", mixture),
    ("bpe", tokens),
]

#: Token ids are beyond SQL; the tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    root = f"{checkpoint_root(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        out = f"{root}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs

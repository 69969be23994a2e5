"""Registered queries of the corpus operators: one ``opN_<name>`` each, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from learner_scoring.llm import (
    bpe, embed_dedup, filter_audit, hard_negatives, html_extract, jaccard_join, line_dedup, mixing, quality_model, quality_rules, secret_scan, sharding, substring_dedup,
)
from learner_scoring.llm.common import read

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def _docs(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", "text", *columns)


def op1_substring_dedup(spark, sf_dir):
    out = substring_dedup.dedup_substrings(_docs(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op2_sharding(spark, sf_dir):
    return sharding.place(read(spark, sf_dir, "documents").select("doc_id")).select("doc_id", "slot", "shard")


def op3_mixing(spark, sf_dir):
    return mixing.mixed(_docs(spark, sf_dir, "source")).select("doc_id", "size", "source_size", "target", "taken")


def op4_line_dedup(spark, sf_dir):
    out = line_dedup.dedup_lines(_docs(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op5_bpe(spark, sf_dir):
    import public_tokenizers as tok

    return bpe.encoded(_docs(spark, sf_dir), tok.path(VOCABULARY), tok.PATTERN)


def op6_ngram_jaccard(spark, sf_dir):
    return jaccard_join.linked(_docs(spark, sf_dir))


def op7_secret_scan(spark, sf_dir):
    return secret_scan.scan(_docs(spark, sf_dir))


def op8_embed_dedup(spark, sf_dir):
    return embed_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


def op9_quality_rules(spark, sf_dir):
    out = quality_rules.judge(_docs(spark, sf_dir, "source"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_html_extract(spark, sf_dir):
    return html_extract.extract(read(spark, sf_dir, "pages"))


def op11_hard_negatives(spark, sf_dir):
    return hard_negatives.mine(read(spark, sf_dir, "embeddings"))


def op12_filter_audit(spark, sf_dir):
    return filter_audit.audit(_docs(spark, sf_dir, "lang"), read(spark, sf_dir, "labels"))


def op13_quality_classifier(spark, sf_dir):
    return quality_model.score(_docs(spark, sf_dir), read(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [f for name, f in globals().items() if name.startswith("op") and callable(f)]
    return {f.__name__: f for f in found}

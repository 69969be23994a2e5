"""Alert frame and monitoring summary (B11, H7) over scored windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def alerts(scored: DataFrame) -> DataFrame:
    """Windows whose score crossed the alert threshold."""
    return scored.filter(F.col("alert_threshold_crossed"))


def score_summary(scored: DataFrame, by: str = "window_start_ms") -> DataFrame:
    """H7: scores produced, alerts triggered and the score distribution per window.

    A plain aggregate (partial + final), so it scales with the number of
    windows, not with the number of students per window.
    """
    return scored.groupBy(by).agg(
        F.count(F.lit(1)).alias("scores_produced"),
        F.count_if(F.col("alert_threshold_crossed")).alias("alerts_triggered"),
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
        F.round(F.avg("score"), 9).alias("avg_score"),
        F.count_if(F.col("trend") == "CRITICAL").alias("critical"),
        F.count_if(F.col("trend") == "DECLINING").alias("declining"),
        F.count_if(F.col("trend") == "STABLE").alias("stable"),
        F.count_if(F.col("trend") == "RISING").alias("rising"),
    )


def score_histogram(scored: DataFrame, buckets: int = 10) -> DataFrame:
    """H7 distribution: count of scores per equal-width bucket of [0, 1]."""
    b = F.least(F.floor(F.col("score") * buckets), F.lit(buckets - 1)).cast("bigint")
    return scored.groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("scores"))


#: Entries of a score sketch: exact up to about so many scores, ranks within 0.1 % beyond.
SKETCH_SIZE = 4096
QUANTILES = {"p10": 0.1, "p50": 0.5, "p90": 0.9}


def score_sketches(scored: DataFrame, by: str = "window_start_ms", size: int = SKETCH_SIZE) -> DataFrame:
    """H7: one quantile sketch of the scores per window; kept as a table, spans need no score again.

    Works on a stream as well (one sketch in the state per window).
    """
    return scored.groupBy(by).agg(F.count("score").alias("scores"), F.kll_sketch_agg_double("score", F.lit(size)).alias("sketch"))


def merge_sketches(sketches: DataFrame, span_ms: int, by: str = "window_start_ms", size: int = SKETCH_SIZE) -> DataFrame:
    """Sketches of longer spans out of those of windows, or of shorter spans."""
    span = F.floor(F.col(by) / span_ms).cast("bigint") * span_ms
    return sketches.groupBy(span.alias("span_start_ms")).agg(
        F.sum("scores").alias("scores"), F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch")
    )


def sketch_quantiles(sketches: DataFrame, quantiles: dict[str, float] = QUANTILES) -> DataFrame:
    """The named quantiles of every sketch."""
    rest = [c for c in sketches.columns if c != "sketch"]
    return sketches.select(*rest, *[F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(n) for n, q in quantiles.items()])

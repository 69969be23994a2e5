"""Observation taps (B10, H7 on a stream): named metrics per micro-batch.

``observe`` computes its aggregates inside the query's own tasks, so there is
no per-record logging and no extra job. A ``StreamingQueryListener`` receives
them with each progress event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def observe_scores(scored: DataFrame, name: str = "scores") -> DataFrame:
    """Per micro-batch: scores emitted, alerts, score distribution bounds."""
    return scored.observe(
        name,
        F.count(F.lit(1)).alias("scores_produced"),
        F.count_if(F.col("alert_threshold_crossed")).alias("alerts_triggered"),
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
        F.avg("score").alias("avg_score"),
    )


def observe_events(events: DataFrame, name: str = "events") -> DataFrame:
    """Per micro-batch: records consumed by route."""
    return events.observe(
        name,
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("is_quiz")).alias("quiz"),
        F.count_if(F.col("is_session")).alias("session"),
    )


class MetricsCollector(StreamingQueryListener):
    """Keeps the observed metrics of every progress event (for tests/monitoring)."""

    def __init__(self):
        self.progress: list[dict] = []

    def onQueryStarted(self, event):  # noqa: N802 - Spark's API names
        pass

    def onQueryProgress(self, event):  # noqa: N802
        p = event.progress
        self.progress.append(
            {
                "batch_id": p.batchId,
                "rows": p.numInputRows,
                "observed": {k: v.asDict() for k, v in (p.observedMetrics or {}).items()},
                "state_rows": sum(s.numRowsTotal for s in p.stateOperators),
            }
        )

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass

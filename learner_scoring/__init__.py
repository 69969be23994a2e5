"""Learner-activity scoring on Spark: quiz answers and session events in,
one-minute engagement scores (components, trend, alert) out.

Batch and streaming share the same column expressions; see ``plans`` for the
batch topology and ``streaming`` for the Structured Streaming query.
"""

from learner_scoring.config import DEFAULT_CONFIG, TUNED_CONFIG, ScoringConfig
from learner_scoring.plans.pipeline import build_scores, build_state, windowed_events

__all__ = ["DEFAULT_CONFIG", "TUNED_CONFIG", "ScoringConfig", "build_scores", "build_state", "windowed_events"]

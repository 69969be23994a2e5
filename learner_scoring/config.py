"""Scoring settings (weights, thresholds, window) and literal helpers.

The settings mirror the reference's configuration surface. Weights and
score thresholds are single-precision there while all arithmetic is double,
so every such value is rounded to float32 and widened back to double before
it enters an expression (``f32``). Plain decimal literals would differ from
the reference's scores at about 1e-8.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def f32(x: float) -> float:
    """Round to float32 and widen to double, like a Java float read as double."""
    return float(np.float32(x))


def dlit(x: float) -> Column:
    """A double literal column holding exactly ``x``."""
    return F.lit(float(x))


# Fixed values that must equal the reference's defaults.
# Weights: dwell 0.3, accuracy 0.4, pacing 0.3, attention 0.0 (unused).
# Thresholds: alert 0.4, green 0.7, yellow 0.4.
# Time thresholds: struggling above 15000 ms, rushing below 5000 ms.
# Pacing: 0.5 expected questions per minute, tolerance 0.2.
# Window: 60 s tumbling, 5 s grace.
# Hard-coded in the metric and trend code (not configurable there):
#   rapid submission gap < 5000 ms, rapid-incorrect pattern needs
#   consecutive incorrect >= 3 and rapid submissions >= 2, struggling
#   pattern needs average time > 20000 ms and correctness < 0.5,
#   RISING needs correctness > 0.7 and score >= 0.8.
RAPID_SUBMISSION_MS = 5000
RAPID_PATTERN_MIN_CONSECUTIVE = 3
RAPID_PATTERN_MIN_RAPID = 2
STRUGGLING_PATTERN_AVG_MS = 20000
STRUGGLING_PATTERN_MAX_RATE = 0.5
RISING_MIN_RATE = 0.7
RISING_MIN_SCORE = 0.8

QUIZ_EVENT_TYPE = "quiz.answered"
SESSION_EVENT_PREFIX = "session."
SCORE_EVENT_TYPE = "engagement.scored"
SPEC_VERSION = "1.0"
APPLICATION_NAME = "learner-scoring"


@dataclass(frozen=True)
class Weights:
    dwell: float = 0.3
    accuracy: float = 0.4
    pacing: float = 0.3
    attention: float = 0.0  # declared by the reference, not used in the score


@dataclass(frozen=True)
class Thresholds:
    alert: float = 0.4
    green: float = 0.7
    yellow: float = 0.4
    struggling_ms: int = 15000
    rushing_ms: int = 5000
    expected_questions_per_minute: float = 0.5
    tolerance_percent: float = 0.2
    # Declared but never read by the reference's metric code (kept for parity).
    pattern_rapid_submission_ms: int = 5000
    pattern_consecutive_incorrect: int = 3


@dataclass(frozen=True)
class WindowSpec:
    duration_seconds: int = 60
    grace_period_seconds: int = 5

    @property
    def duration_ms(self) -> int:
        return self.duration_seconds * 1000

    @property
    def grace_ms(self) -> int:
        return self.grace_period_seconds * 1000


@dataclass(frozen=True)
class ScoringConfig:
    weights: Weights = field(default_factory=Weights)
    thresholds: Thresholds = field(default_factory=Thresholds)
    window: WindowSpec = field(default_factory=WindowSpec)
    application_name: str = APPLICATION_NAME

    # float-widened values used in expressions
    @property
    def w_accuracy(self) -> float:
        return f32(self.weights.accuracy)

    @property
    def w_dwell(self) -> float:
        return f32(self.weights.dwell)

    @property
    def w_pacing(self) -> float:
        return f32(self.weights.pacing)

    @property
    def alert(self) -> float:
        return f32(self.thresholds.alert)

    @property
    def yellow(self) -> float:
        return f32(self.thresholds.yellow)

    @property
    def green(self) -> float:
        return f32(self.thresholds.green)

    @property
    def pacing_bounds(self) -> tuple[float, float]:
        ideal = f32(self.thresholds.expected_questions_per_minute)
        tol = f32(self.thresholds.tolerance_percent)
        return ideal * (1 - tol), ideal * (1 + tol)

    def with_settings(self, settings: Mapping[str, Mapping[str, object]]) -> "ScoringConfig":
        """H1-H6: settings by section (weights, thresholds, window) and name; unknown names are errors."""
        out = self
        for section, values in settings.items():
            if section not in ("weights", "thresholds", "window"):
                raise ValueError(f"no settings section {section!r}")
            old = getattr(out, section)
            for name, value in values.items():
                if name not in old.__dataclass_fields__:
                    raise ValueError(f"no setting {section}.{name}")
                old = replace(old, **{name: type(getattr(old, name))(value)})
            out = replace(out, **{section: old})
        if out.window.duration_seconds <= 0 or out.window.grace_period_seconds < 0:
            raise ValueError("a window needs a positive duration and no negative grace period")
        return out

    def with_thresholds(self, **kw) -> "ScoringConfig":
        return replace(self, thresholds=replace(self.thresholds, **kw))

    def with_weights(self, **kw) -> "ScoringConfig":
        return replace(self, weights=replace(self.weights, **kw))

    def with_window(self, **kw) -> "ScoringConfig":
        return replace(self, window=replace(self.window, **kw))


DEFAULT_CONFIG = ScoringConfig()

# Settings used to reach branches the defaults cannot reach: DECLINING needs
# yellow above alert, pacing 1.0 with answers needs a faster expected pace.
TUNED_CONFIG = DEFAULT_CONFIG.with_thresholds(
    yellow=0.7, expected_questions_per_minute=4.0, tolerance_percent=0.5
)

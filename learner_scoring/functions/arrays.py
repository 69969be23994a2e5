"""Higher-order array expressions for the list form of the fold.

They run inside one projection after a (streaming) aggregate that collected
``answers = array_sort(collect_list(struct(arrival_seq, event_ms, ok)))``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from learner_scoring import config as C


def trailing_incorrect(answers: Column) -> Column:
    """E5: length of the run of wrong answers at the end (reset by a correct one)."""
    return F.aggregate(
        answers,
        F.lit(0).cast("bigint"),
        lambda acc, x: F.when(x["ok"], F.lit(0).cast("bigint")).otherwise(acc + 1),
    )


def answer_gaps(answers: Column) -> Column:
    """Event-time gap to the previous answer in arrival order; null for the first."""
    return F.transform(
        answers,
        lambda x, i: F.when(i == 0, F.lit(None).cast("bigint")).otherwise(
            x["event_ms"] - F.get(answers, i - 1)["event_ms"]
        ),
    )


def rapid_count(answers: Column, rapid_ms: int = C.RAPID_SUBMISSION_MS) -> Column:
    """Adjacent answers closer than ``rapid_ms`` (negative gaps count)."""
    return F.size(F.filter(answer_gaps(answers), lambda d: d < rapid_ms)).cast("bigint")


def event_times(answers: Column) -> Column:
    """Answer event times in arrival order."""
    return F.transform(answers, lambda x: x["event_ms"])


def tag_counts(tags: Column) -> Column:
    """Map tag -> occurrences, from a list of non-null tags."""
    return F.map_from_entries(
        F.transform(
            F.array_distinct(tags),
            lambda t: F.struct(t.alias("key"), F.size(F.filter(tags, lambda y: y == t)).cast("bigint").alias("value")),
        )
    )


def map_to_text(m: Column) -> Column:
    """Canonical text of a map: ``k1:v1,k2:v2`` sorted by key ('' when empty)."""
    return F.array_join(
        F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))),
        ",",
    )


def list_to_text(a: Column) -> Column:
    """Canonical text of a list, in its own order ('' when empty)."""
    return F.array_join(F.transform(a, lambda x: x.cast("string")), ",")

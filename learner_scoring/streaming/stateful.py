"""Keyed state with timers: late rows, window folds and changelogs out of compact state.

``stamp_stream_time`` keeps one clock per (topic, partition) and says of every
record which time had been reached when it came, so late records leave the
stream as a side output and all others go on. ``fold_windows`` keeps one
value of fixed size per (student, window): counts, sums, bounds, the first
session, the last answer's time and the trailing run of wrong answers, with
skill tags and pages as map state if asked for. The students of a window are
dealt into shards, and a shard's values are read and written together: calls
to the state store, Arrow batches and timers count per shard, not per student.
A timer per shard of a window evicts it. State can be handed over from a batch
fold, and read back from a checkpoint.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from learner_scoring import config as C
from learner_scoring.config import DEFAULT_CONFIG, ScoringConfig
from learner_scoring.operators.partials import GROUP
from learner_scoring.operators.windows import assign_window, with_stream_time
from learner_scoring.streaming.table import _children

#: Partitions may lie this far behind the furthest one before windows are evicted under them.
PARTITION_LAG_SECONDS = 60
#: Shards of a window's students. A task holds one shard's records of a micro-batch; a checkpoint keeps the number it began with.
SHARDS = 512

#: Value state of a window, in this order. Numbers and one session id: its size does not grow with the records.
STATE_DDL = (
    "total_answers bigint, correct_answers bigint, incorrect_answers bigint, n_time_values bigint, total_time_spent bigint, "
    "navigation_events bigint, pause_events bigint, resume_events bigint, total_dwell_time bigint, total_hints_used bigint, "
    "rapid_submissions bigint, consecutive_incorrect bigint, first_event_ms bigint, last_event_ms bigint, last_answer_ms bigint, "
    "first_record_ms bigint, first_topic string, first_partition int, first_offset bigint, session_id string"
)
_FIELDS = [f.strip().split()[0] for f in STATE_DDL.split(",")]
_EMPTY = [0] * 12 + [None] * 8
#: One student's value among those of a shard.
HELD_DDL = f"student_id string, {STATE_DDL}"
#: Columns a fold emits: the state without its private fields.
_SHOWN = [f for f in _FIELDS if not (f.startswith("first_") and f != "first_event_ms") and f != "last_answer_ms"]
OUT_DDL = "student_id string, window_start_ms bigint, window_end_ms bigint, " + ", ".join(
    f.strip() for f in STATE_DDL.split(",") if f.strip().split()[0] in _SHOWN
)
#: What a record brings to the fold.
EVENT_COLUMNS = [
    "event_id", "student_id", "session_id", "event_ms", "record_ms", "topic", "kafka_partition", "kafka_offset", "is_quiz", "is_session",
    "is_correct", "time_spent_ms", "hints_used", "skill_tag", "session_event_type", "page_id", "dwell_time_ms",
]
_EVENT, _STUDENT, _OFFSET, _QUIZ, _SKILL, _KIND, _PAGE = (
    EVENT_COLUMNS.index(c) for c in ("event_id", "student_id", "kafka_offset", "is_quiz", "skill_tag", "session_event_type", "page_id")
)
_ARRIVAL = itemgetter(*(EVENT_COLUMNS.index(c) for c in ("record_ms", "topic", "kafka_partition", "kafka_offset")))


# ------------------------------------------------------------ clocks


#: The time each partition has reached.
CLOCK_DDL = "topic string, kafka_partition int, clock_ms bigint"


class StreamClock(StatefulProcessor):
    """The time reached per (topic, partition), record by record in offset order."""

    def init(self, handle) -> None:
        self.clock = handle.getValueState("clock", "stream_time_ms bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = self.clock.get()[0] if self.clock.exists() else None
        for r in sorted(rows, key=lambda r: r["kafka_offset"]):
            now = r["record_ms"] if now is None else max(now, r["record_ms"])
            yield Row(**r.asDict(), stream_time_ms=now)
        if now is not None:
            self.clock.update((now,))

    def close(self) -> None:
        pass


def stamp_stream_time(events: DataFrame, cfg: ScoringConfig = DEFAULT_CONFIG, clocks: DataFrame | None = None) -> DataFrame:
    """Events with ``stream_time_ms`` and ``late``, as the batch rule has them.

    Streaming events are clocked in offset order within a micro-batch, and a
    partition's records come in offset order from batch to batch. One task takes
    a partition's share of a micro-batch, like the partition's reader.

    The rows of one micro-batch (``ClockedBatches``) are clocked by a distributed
    running maximum, so no partition has to fit a task. ``clocks`` has what the
    batches before have reached: ``topic``, ``kafka_partition``, ``clock_ms``.
    """
    rows = assign_window(events, cfg).select(*EVENT_COLUMNS, "event_type", "window_start_ms", "window_end_ms")
    if events.isStreaming:
        schema = T.StructType([*rows.schema.fields, T.StructField("stream_time_ms", T.LongType())])
        timed = rows.groupBy("topic", "kafka_partition").transformWithState(StreamClock(), schema, "Append", "None")
    else:
        timed = with_stream_time(rows).select(*rows.columns, "stream_time_ms")
        if clocks is not None:
            reached = F.greatest("stream_time_ms", "clock_ms").alias("stream_time_ms")
            timed = timed.join(F.broadcast(clocks), ["topic", "kafka_partition"], "left").select(*rows.columns, reached)
    return timed.withColumn("late", F.col("window_end_ms") <= F.col("stream_time_ms") - F.lit(cfg.window.grace_ms))


class ClockedBatches:
    """``foreachBatch`` target: clocked records under ``<path>/rows``, late ones apart, and the clocks after each batch.

    A replayed batch starts from the clocks of the batch before it and overwrites
    its own folders.
    """

    def __init__(self, path: str, cfg: ScoringConfig = DEFAULT_CONFIG):
        self.path, self.cfg = path.rstrip("/"), cfg

    def _before(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        done = [int(n.partition("=")[2]) for n in _children(spark, f"{self.path}/clocks")]
        last = max((n for n in done if n < batch_id), default=None)
        return None if last is None else spark.read.schema(CLOCK_DDL).parquet(f"{self.path}/clocks/batch={last}")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        before = self._before(batch.sparkSession, batch_id)
        timed = stamp_stream_time(batch, self.cfg, before).withColumn("late", F.col("late").cast("int"))
        timed.write.mode("overwrite").partitionBy("late").parquet(f"{self.path}/rows/batch_id={batch_id}")
        now = batch.select("topic", "kafka_partition", F.col("record_ms").alias("clock_ms"))
        now = now if before is None else now.unionByName(before)
        now = now.groupBy("topic", "kafka_partition").agg(F.max("clock_ms").alias("clock_ms"))
        now.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/clocks/batch={batch_id}")

    def schema(self, events: DataFrame) -> T.StructType:
        """What ``<path>/rows`` has of such events."""
        fields = [f for f in stamp_stream_time(events, self.cfg).schema.fields if f.name != "late"]
        return T.StructType([*fields, T.StructField("batch_id", T.IntegerType()), T.StructField("late", T.IntegerType())])


# ------------------------------------------------------------ window fold


def apply(s: list, r: tuple) -> None:
    """Add one record (its EVENT_COLUMNS), the latest to arrive, to a window's state."""
    (total, correct, wrong, n_time, time, nav, pause, resume, dwell, hints, rapid, run, first, last, answered, *lead) = s
    (_, _, session, at, record_ms, topic, partition, offset, is_quiz, is_session, is_correct, spent, used, _, kind, _, stayed, *_) = r
    if is_quiz:
        total += 1
        ok = bool(is_correct)
        correct += ok
        wrong += not ok
        run = 0 if ok else run + 1
        if spent is not None:
            n_time += 1
            time += spent
        hints += used or 0
        if answered is not None and at - answered < C.RAPID_SUBMISSION_MS:
            rapid += 1
        answered = at
    elif is_session:
        nav += kind == "NAVIGATION"
        pause += kind == "PAUSED"
        resume += kind == "RESUMED"
        if kind == "DWELL":
            dwell += stayed or 0
    if is_quiz or is_session:
        first = at if first is None else min(first, at)
        last = at if last is None else max(last, at)
    place = [record_ms, topic, partition, offset]
    if lead[0] is None or place < lead[:4]:
        lead = [*place, session]
    s[:] = [total, correct, wrong, n_time, time, nav, pause, resume, dwell, hints, rapid, run, first, last, answered, *lead]


class WindowFold(StatefulProcessor):
    """States of the students in one (window, shard): a value each, read and written together.

    ``emit``: "update" puts out a changed window once per micro-batch, "every"
    its state after each record, "final" a window once, when its timer ends it.
    """

    def __init__(self, emit: str, duration_ms: int, words: bool):
        self.emit, self.duration_ms, self.words = emit, duration_ms, words

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getListState("window", HELD_DDL)
        self.shown = itemgetter(*(_FIELDS.index(f) for f in _SHOWN))
        names = ["student_id", "window_start_ms", "window_end_ms", *_SHOWN]
        if self.emit == "every":
            names += ["event_id", "kafka_offset"]
        if self.words:
            self.tags = handle.getMapState("tags", "student_id string, word string", "n bigint")
            self.pages = handle.getMapState("pages", "student_id string, word string", "n bigint")
            names += ["pages_visited", "skill_tag_attempts"]
        self.out = Row(*names)

    def _held(self) -> dict[str | None, list]:
        return {x[0]: list(x[1:]) for x in self.state.get()} if self.state.exists() else {}

    def _row(self, key, student: str | None, s: list, words: tuple[dict, dict] | None, *extra) -> Row:
        if words:
            tags, pages = (of.get(student, {}) for of in words)
            extra = (*extra, sorted(pages), dict(tags))
        return self.out(student, key[0], key[0] + self.duration_ms, *self.shown(s), *extra)

    def _set_timer(self, key) -> None:
        """At the window's start, see the watermark in ``fold_windows``; 0 is where a watermark begins."""
        self.handle.registerTimer(max(key[0], 1))

    def _all_words(self) -> tuple[dict, dict] | None:
        """The tags and the pages held, with their counts, by student."""
        if not self.words:
            return None
        out = ({}, {})
        for of, held in zip(out, (self.tags, self.pages)):
            for (student, word), (n,) in held.iterator():
                of.setdefault(student, Counter())[word] = n
        return out

    def _count(self, batch: list[tuple]) -> tuple[dict, dict] | None:
        words = self._all_words()
        if words:
            tags = Counter((r[_STUDENT], r[_SKILL]) for r in batch if r[_QUIZ] and r[_SKILL] is not None)
            pages = Counter((r[_STUDENT], r[_PAGE]) for r in batch if r[_KIND] == "NAVIGATION" and r[_PAGE] is not None)
            for held, of, new in zip((self.tags, self.pages), words, (tags, pages)):
                for (student, word), n in new.items():
                    seen = of.setdefault(student, Counter())
                    seen[word] += n
                    held.updateValue((student, word), (seen[word],))
        return words

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        states = self._held()
        batch = sorted(map(tuple, rows), key=_ARRIVAL)
        words = self._count(batch)
        changed = {}
        for r in batch:
            student = r[_STUDENT]
            s = changed.get(student)
            if s is None:
                s = changed[student] = states.setdefault(student, list(_EMPTY))
            apply(s, r)
            if self.emit == "every":
                yield self._row(key, student, s, words, r[_EVENT], r[_OFFSET])
        self.state.put([(student, *s) for student, s in states.items()])
        self._set_timer(key)
        if self.emit == "update":
            for student, s in changed.items():
                yield self._row(key, student, s, words)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.emit == "final":
            words = self._all_words()
            for student, s in self._held().items():
                yield self._row(key, student, s, words)
        self.state.clear()
        if self.words:
            self.tags.clear()
            self.pages.clear()

    def handleInitialState(self, key, initialState, timerValues) -> None:
        """A shard of a window handed over from a batch fold."""
        self.state.put([(h["student_id"], *(h[f] for f in _FIELDS)) for h in initialState["held"]])
        self._set_timer(key)

    def close(self) -> None:
        pass


def _by_shard(rows: DataFrame, shards: int) -> DataFrame:
    return rows.withColumn("shard", F.pmod(F.xxhash64("student_id"), F.lit(shards)).cast("int"))


def fold_windows(
    events: DataFrame,
    cfg: ScoringConfig = DEFAULT_CONFIG,
    emit: str = "update",
    words: bool = False,
    initial: DataFrame | None = None,
    lag_seconds: int = PARTITION_LAG_SECONDS,
    shards: int = SHARDS,
) -> DataFrame:
    """Streaming events (without late ones, see ``stamp_stream_time``) -> window states.

    Order fields follow the order in which records come: micro-batch, then arrival
    order within it. Whatever comes once a partition's clock has closed a window
    is the caller's to leave out; Spark's own watermark lies a window, the grace
    period and ``lag_seconds`` back, so it drops nothing that the rule keeps
    unless partitions drift further apart than that. A window's timer stands at its
    start: the watermark gets there when all clocks have passed its end and grace.
    ``initial`` is a table from ``handover_state``. Work is dealt by (window, shard
    of students), and a shard's share of a micro-batch is held at once.
    """
    w = cfg.window
    delay = w.duration_seconds + w.grace_period_seconds + lag_seconds
    rows = assign_window(events, cfg).select(*EVENT_COLUMNS, "window_start_ms", F.timestamp_millis("record_ms").alias("record_ts"))
    keyed = _by_shard(rows.withWatermark("record_ts", f"{delay} seconds"), shards).groupBy("window_start_ms", "shard")
    schema = OUT_DDL
    if emit == "every":
        schema += ", event_id string, kafka_offset bigint"
    if words:
        schema += ", pages_visited array<string>, skill_tag_attempts map<string,bigint>"
    fold = WindowFold(emit, w.duration_ms, words)
    start = None
    if initial is not None:
        held = F.collect_list(F.struct("student_id", *_FIELDS)).alias("held")
        start = _by_shard(initial, shards).groupBy("window_start_ms", "shard").agg(held).groupBy("window_start_ms", "shard")
    return keyed.transformWithState(fold, schema, "Append" if emit == "final" else "Update", "EventTime", start)


def handover_state(partials: DataFrame) -> DataFrame:
    """Partials of a batch fold (``operators.partials``) as the first state of ``fold_windows``."""
    lo = F.col("lo")
    shown = {
        "first_record_ms": lo["record_ms"], "first_topic": lo["topic"], "first_partition": lo["kafka_partition"], "first_offset": lo["kafka_offset"],
    }
    return partials.select(*GROUP, *[shown.get(f, F.col(f)).alias(f) for f in _FIELDS])


def read_windows(spark: SparkSession, checkpoint: str, cfg: ScoringConfig = DEFAULT_CONFIG) -> DataFrame:
    """The open windows of a stopped or running ``fold_windows`` query, out of its checkpoint."""
    held = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "window").load()
    one = F.col("list_element")
    start = F.col("key").getField("window_start_ms").alias("window_start_ms")
    rows = held.select(one.getField("student_id").alias("student_id"), start, *[one.getField(f).alias(f) for f in _SHOWN])
    return rows.withColumn("window_end_ms", F.col("window_start_ms") + F.lit(cfg.window.duration_ms))


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of this module

"""Order-dependent operators that stay distributed.

A window function partitioned only by a coarse key (a Kafka partition, a
student-window) sends every row of that key to one task. Usual windows are
small, and their rows go through one shuffle on the window. Windows too long
for a task are found in a sample of the records and cut into buckets, a
non-decreasing function of the arrival order: rows are shuffled by (window,
bucket), and the buckets' summaries are put together in order. Either way a
row is shuffled once. Which windows are cut decides how work is dealt, never
what comes out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "_bkt"
SEQ = "arrival_seq"
#: A window with more records than this is cut into buckets.
HOT_ROWS = 1 << 20
#: One in this many records (by hash of the arrival) is counted to find such windows.
SAMPLE_EVERY = 64
#: The longest windows, at most this many, are cut; any further one holds less than 1/MAX_HOT of the records.
MAX_HOT = 4096
#: Cells of time of a cut window.
CELLS = 256
#: Offsets of a bucket inside a cell that is itself too long.
OFFSETS = 1 << 16


def arrival_order(record_ms: Column, topic: Column, partition: Column, offset: Column) -> Column:
    """The arrival order over both topics: record time, then topic, partition, offset.

    Offsets count per (topic, partition), so alone they order nothing across
    partitions; the record clock does, and the rest breaks its ties.
    """
    return F.struct(
        record_ms.cast("bigint").alias("record_ms"),
        topic.cast("string").alias("topic"),
        partition.cast("int").alias("kafka_partition"),
        offset.cast("bigint").alias("kafka_offset"),
    )


def arrival_bucket(df: DataFrame, width: int) -> Column:
    """A non-decreasing bucket of ``arrival_seq``, of at most ``width`` records.

    ``arrival_seq`` is either ``arrival_order`` (a bucket is ``width`` offsets of
    one partition in one millisecond) or a bigint the source numbers itself. A
    window of W ms has at most W x partitions buckets, plus one per ``width``
    records: the summaries stay bounded however hot the window is.
    """
    seq = F.col(SEQ)
    if not isinstance(df.schema[SEQ].dataType, T.StructType):
        return F.floor(seq / F.lit(width))
    return F.struct(
        seq["record_ms"].alias("record_ms"),
        seq["topic"].alias("topic"),
        seq["kafka_partition"].alias("kafka_partition"),
        F.floor(seq["kafka_offset"] / F.lit(width)).alias("offsets"),
    )


def _cell(df: DataFrame, duration_ms: int) -> Column:
    """The cell of a window's time a record falls in (records that only have a number: one cell)."""
    if not isinstance(df.schema[SEQ].dataType, T.StructType):
        return F.lit(0)
    width = max(1, -(-duration_ms // CELLS))
    return F.floor((F.col(SEQ)["record_ms"] - F.col("window_start_ms")) / F.lit(width)).cast("int")


def hot_windows(
    events: DataFrame,
    group_cols: Sequence[str],
    duration_ms: int,
    hot_rows: int = HOT_ROWS,
    every: int = SAMPLE_EVERY,
    lazy: bool = False,
) -> DataFrame | None:
    """(group, hot_cells) of the windows to cut, or None where there is none.

    ``lazy`` leaves the count to the plan, which then allows for cut windows
    whether there are any or not, but runs nothing before its output is asked for.

    Counts a sample per (window, cell), combined before a shuffle of the counts
    only. The table has at most MAX_HOT rows of at most CELLS numbers, so it may
    go to the driver and to every executor.
    """
    g = list(group_cols)
    sampled = events.filter(F.pmod(F.xxhash64(SEQ), F.lit(every)) == 0)
    cells = sampled.groupBy(*g, _cell(events, duration_ms).alias("_cell")).agg((F.count(F.lit(1)) * every).alias("_n"))
    windows = cells.groupBy(*g).agg(
        F.sum("_n").alias("_n"), F.collect_list(F.when(F.col("_n") > hot_rows, F.col("_cell"))).alias("hot_cells")
    )
    longest = windows.filter(F.col("_n") > hot_rows).orderBy(F.col("_n").desc(), *g).limit(MAX_HOT).select(*g, "hot_cells")
    if lazy:
        return F.broadcast(longest)
    rows = longest.collect()  # at most MAX_HOT
    return F.broadcast(events.sparkSession.createDataFrame(rows, longest.schema)) if rows else None


def split_hot(
    events: DataFrame,
    group_cols: Sequence[str],
    duration_ms: int,
    seq_bucket: int | None = None,
    hot_rows: int = HOT_ROWS,
    every: int = SAMPLE_EVERY,
    lazy: bool = False,
) -> tuple[DataFrame | None, DataFrame | None]:
    """(records of usual windows, records of cut windows with their bucket); None stands for no rows.

    A bucket is a cell of the window's time, and within a cell that is too long
    itself OFFSETS offsets of one partition in one millisecond. With
    ``seq_bucket`` every window is cut, into buckets of that many offsets.
    """
    if seq_bucket is not None:
        return None, events.withColumn(BUCKET, arrival_bucket(events, seq_bucket))
    hot = hot_windows(events, group_cols, duration_ms, hot_rows, every, lazy)
    if hot is None:
        return events, None
    g = list(group_cols)
    cell = _cell(events, duration_ms)
    fine = F.when(F.array_contains("hot_cells", cell), arrival_bucket(events, OFFSETS))
    bucket = F.struct(cell.alias("cell"), fine.alias("fine"))
    cut = events.join(hot, g).withColumn(BUCKET, bucket).drop("hot_cells")
    return events.join(hot, g, "left_anti"), cut


def both(usual: DataFrame | None, cut: DataFrame | None) -> DataFrame:
    """Union of the two parts, of which one may be missing."""
    if usual is None or cut is None:
        return cut if usual is None else usual
    return usual.unionByName(cut)


def dense_sequence(
    df: DataFrame,
    partition_cols: Sequence[str],
    order_cols: Sequence[str],
    bucket: Column,
    out_col: str,
) -> DataFrame:
    """``row_number() over (partition by P order by O)`` without one task per P.

    ``bucket`` must be non-decreasing in ``order_cols`` within a partition.
    1) count rows per (P, bucket) — partial aggregation, tiny output;
    2) exclusive prefix sum of the counts per P over the bucket order (a window
       over the small count table);
    3) join the bucket start back (AQE turns it into a broadcast when the
       measured size is below its threshold) and add the row number inside the
       bucket, a window partitioned by (P, bucket).
    """
    p = list(partition_cols)
    b = df.withColumn(BUCKET, bucket)
    counts = b.groupBy(*p, BUCKET).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*p).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*p, BUCKET, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*p, BUCKET).orderBy(*order_cols)
    return (
        b.join(starts, [*p, BUCKET])
        .withColumn(out_col, (F.col("_start") + F.row_number().over(within)).cast("bigint"))
        .drop(BUCKET, "_start")
    )


def running_max(
    df: DataFrame,
    partition_cols: Sequence[str],
    order_col: str,
    value_col: str,
    bucket: Column,
    out_col: str,
) -> DataFrame:
    """Inclusive running max of ``value_col`` per partition in ``order_col`` order.

    Two steps like ``dense_sequence``: max per (P, bucket), exclusive prefix max
    over buckets, then the running max inside the bucket.
    """
    p = list(partition_cols)
    b = df.withColumn(BUCKET, bucket)
    maxes = b.groupBy(*p, BUCKET).agg(F.max(value_col).alias("_bmax"))
    before = Window.partitionBy(*p).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    prefix = maxes.select(*p, BUCKET, F.max("_bmax").over(before).alias("_pmax"))
    within = Window.partitionBy(*p, BUCKET).orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    return (
        b.join(prefix, [*p, BUCKET])
        .withColumn(out_col, F.greatest(F.col("_pmax"), F.max(value_col).over(within)))
        .drop(BUCKET, "_pmax")
    )


def answer_positions(
    answers: DataFrame,
    group_cols: Sequence[str],
    duration_ms: int,
    seq_bucket: int | None = None,
    hot_rows: int = HOT_ROWS,
    every: int = SAMPLE_EVERY,
) -> DataFrame:
    """E6/E7 as a table: 1-based arrival position of each answer in its group."""
    usual, cut = split_hot(answers, group_cols, duration_ms, seq_bucket, hot_rows, every)
    if usual is not None:
        place = F.row_number().over(Window.partitionBy(*group_cols).orderBy(SEQ))
        usual = usual.withColumn("position", place.cast("bigint"))
    if cut is not None:
        bucket = F.col(BUCKET)
        cut = dense_sequence(cut, group_cols, [SEQ], bucket, "position")
    return both(usual, cut)

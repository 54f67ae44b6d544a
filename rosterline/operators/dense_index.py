"""Distributed dense numbering in a given order (the ``zipWithIndex`` idea on DataFrames).

``row_number() OVER (ORDER BY k)`` without a partition clause moves every row into one task.  Instead:

1. range-partition on the order key and sort inside each partition, so partition ``p`` holds a contiguous run;
2. ``monotonically_increasing_id`` then encodes (partition, position in partition);
3. count rows per partition (an aggregate whose result has at most one row per partition), turn the counts into
   running offsets, and join them back as a broadcast — its size is bounded by the partition count, not the data.

The range-partitioned, numbered rows are written to the shared folder before the counts are taken: range bounds come
from sampling, and a recomputation with other bounds would disagree with offsets taken earlier.  Adaptive execution joins
small neighbouring ranges, which stay in order, so that few rows don't become as many files as there are partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterline.session import cut

_PID_SHIFT = 33  # monotonically_increasing_id puts the partition id in the upper 31 bits


def dense_index(df: DataFrame, order: list[str | Column], name: str = "idx", start: int | Column = 0,
                partitions: int | None = None) -> DataFrame:
    """Add ``name`` = start + 0-based position of the row in ``order`` (order columns must make rows unique)."""
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    dealt = df.repartitionByRange(partitions, *order_cols) if partitions else df.repartitionByRange(*order_cols)
    numbered = cut(dealt.sortWithinPartitions(*order_cols).withColumn("_mid", F.monotonically_increasing_id()))
    pid = F.shiftright(F.col("_mid"), _PID_SHIFT)
    counts = numbered.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    # At most one row per partition: a single-task window over it is bounded by the partition count.
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
    )
    start_col = start if isinstance(start, Column) else F.lit(start)
    local = F.col("_mid") - F.shiftleft(pid, _PID_SHIFT)
    out = numbered.join(F.broadcast(offsets), pid == F.col("_pid"), "inner")
    return out.withColumn(name, (start_col + F.col("_off") + local).cast("bigint")).drop("_mid", "_pid", "_off")

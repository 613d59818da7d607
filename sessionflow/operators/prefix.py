"""Running totals and dense row numbers over a whole table without sorting it in one task.

The rows are written once, cut into ranges of the order by samples of their values, and handed off with the number of their
range. The number of ranges follows the number of rows, and uneven values get even ranges. Totals per range are tiny, their prefix
sums give each range its offset, and the rest is a window inside the range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionflow.storage import hand_off, hand_off_counted

#: Rows of a range, about; one task sorts them.
RANGE_ROWS = 1_000_000


def running_sum(df: DataFrame, value: Column, order: Sequence[str], out: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Add the sum of ``value`` over all rows before this one in ``order`` (exclusive), a total order.

    The rows are computed once, written to the shared folder and counted on the way. What fits one range is one; otherwise
    the ranges are written as well, so that all later steps and repeated tasks see the same cuts.
    """
    rows, n = hand_off_counted(df.withColumn("_value", value.cast("long")), "rows-to-number")
    n_ranges = -(-n // range_rows)
    if n_ranges <= 1:
        whole = Window.partitionBy(F.lit(0)).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumn(out, F.coalesce(F.sum("_value").over(whole), F.lit(0))).drop("_value")
    rows = hand_off(rows.repartitionByRange(n_ranges, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # one row per range, so the window without partition keys stays small
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_range")
        .agg(F.sum("_value").alias("_total"))
        .select("_range", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))
    )
    return (
        rows.withColumn(out, F.coalesce(F.sum("_value").over(before), F.lit(0)))
        .join(offsets, "_range")
        .withColumn(out, F.col(out) + F.col("_offset"))
        .drop("_offset", "_range", "_value")
    )


def number_rows(df: DataFrame, order: Sequence[str], out: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Add a dense 0-based row number along ``order``."""
    return running_sum(df, F.lit(1), order, out, range_rows)

"""Exact count, mean and median of durations per group, from a histogram.

Durations are hours with two places, so the distinct values of a group are limited
by its longest duration and not by its rows. Rows are counted per value first; mean
and median come from those counts in whole numbers. No task ever holds the values of
a group: the median is looked up in the one or two value blocks that contain it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TICKS_PER_HOUR = 100
# Values per block: 100 hours.
BLOCK = 10_000


def tick(hours: str) -> Column:
    """A duration with two places as a whole number of hundredths."""
    return F.round(F.col(hours) * F.lit(TICKS_PER_HOUR)).cast("bigint")


def duration_stats(histogram: DataFrame, keys: list[str]) -> DataFrame:
    """Per ``keys``: ``request_count``, ``tick_sum`` and ``median_twice``.

    ``histogram`` has the keys, ``tick`` and its number of rows ``n``. An unknown tick
    counts as a request only. ``median_twice`` is the sum of the two middle ticks.
    """
    blocked = histogram.withColumn("block", F.floor(F.col("tick") / F.lit(BLOCK)))
    exact = F.col("n").cast("decimal(20,0)") * F.col("tick").cast("decimal(18,0)")
    blocks = blocked.groupBy(*keys, "block").agg(
        F.sum("n").alias("block_n"), F.sum(exact).alias("block_ticks")
    )
    whole = Window.partitionBy(*keys)
    known = F.when(F.col("block").isNotNull(), F.col("block_n"))
    so_far = whole.orderBy(F.col("block").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    blocks = blocks.select(
        *keys,
        "block",
        (F.sum(known).over(so_far) - known).alias("before"),
        F.sum(known).over(so_far).alias("upto"),
        F.sum("block_n").over(whole).alias("request_count"),
        F.sum(known).over(whole).alias("known_count"),
        F.sum("block_ticks").over(whole).alias("tick_sum"),
    )
    # Ranks of the two middle values, counted from 1; equal for an odd number.
    low = F.call_function("div", F.col("known_count") + F.lit(1), F.lit(2))
    high = F.call_function("div", F.col("known_count") + F.lit(2), F.lit(2))
    holds_median = (F.col("upto") >= low) & (F.col("before") < high)
    # A group without any known duration keeps its only block, for the count.
    wanted = blocks.where(holds_median | F.col("known_count").isNull())

    same = reduce(
        lambda a, b: a & b, [F.col(f"v.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*keys, "block")]
    )
    rows = blocked.alias("v").join(wanted.alias("b"), same)
    totals = ("before", "request_count", "known_count", "tick_sum")
    rows = rows.select(*[F.col(f"b.{c}") for c in (*keys, "block", *totals)], "tick", "n")
    within = Window.partitionBy(*keys, "block").orderBy("tick").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    rows = rows.withColumn("rank", F.col("before") + F.sum("n").over(within))
    return rows.groupBy(*keys).agg(
        F.max("request_count").alias("request_count"),
        F.max("tick_sum").alias("tick_sum"),
        F.max("known_count").alias("known_count"),
        (
            F.min(F.when(F.col("rank") >= low, F.col("tick")))
            + F.min(F.when(F.col("rank") >= high, F.col("tick")))
        ).alias("median_twice"),
    )


def mean_hours() -> Column:
    """Mean of ``duration_stats`` in hours to one place, half up."""
    parts = F.lit(2) * F.col("tick_sum") + F.lit(10) * F.col("known_count")
    return F.call_function("div", parts, F.lit(20) * F.col("known_count")) / F.lit(10.0)


def median_hours() -> Column:
    """Median of ``duration_stats`` in hours to one place, half up."""
    return F.call_function("div", F.col("median_twice") + F.lit(10), F.lit(20)) / F.lit(10.0)

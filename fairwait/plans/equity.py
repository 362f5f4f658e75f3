"""How long areas of different income wait: counts, means and exact medians.

All comparisons look at real requests with a valid resolution in a known area.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairwait.operators.durations import duration_stats, mean_hours, median_hours, tick
from fairwait.operators.joins import count_by_dimension
from fairwait.schemas import HIGH_VOLUME, QUARTILES

QUARTILE = "income_quartile"


def _comparable(facts: DataFrame) -> DataFrame:
    usable = F.col("is_real_service_request") & F.col("has_valid_resolution")
    return facts.where(usable).select("community_area", "sr_type", tick("resolution_hours").alias("tick"))


def _stats(facts: DataFrame, areas: DataFrame, keys: list[str]) -> DataFrame:
    histogram = count_by_dimension(
        _comparable(facts), areas, on="community_area", by=[*keys, "tick"]
    )
    return duration_stats(histogram, keys)


def comparable_counts(facts: DataFrame) -> DataFrame:
    """Comparable requests per area, type and duration: all that the comparisons need of the facts."""
    return _comparable(facts).groupBy("community_area", "sr_type", "tick").agg(F.count(F.lit(1)).alias("n"))


def _stats_of(counts: DataFrame, areas: DataFrame, keys: list[str]) -> DataFrame:
    histogram = count_by_dimension(counts, areas, on="community_area", by=[*keys, "tick"], weight="n")
    return duration_stats(histogram, keys)


def _summary(stats: DataFrame, keys: list[str]) -> DataFrame:
    return stats.select(
        *keys,
        "request_count",
        mean_hours().alias("avg_resolution_hours"),
        median_hours().alias("median_resolution_hours"),
    ).orderBy(*[F.col(k).asc_nulls_last() for k in keys])


def equity_by_quartile(facts: DataFrame, areas: DataFrame) -> DataFrame:
    """Requests, mean and median hours per income quartile."""
    return _summary(_stats(facts, areas, [QUARTILE]), [QUARTILE])


def equity_by_quartile_of(counts: DataFrame, areas: DataFrame) -> DataFrame:
    """``equity_by_quartile`` from ``comparable_counts``."""
    return _summary(_stats_of(counts, areas, [QUARTILE]), [QUARTILE])


def high_volume_types(facts: DataFrame, areas: DataFrame, at_least: int = HIGH_VOLUME) -> DataFrame:
    """Types with at least ``at_least`` comparable requests over all quartiles."""
    per_type = count_by_dimension(_comparable(facts), areas, on="community_area", by=["sr_type"])
    return per_type.where(F.col("n") >= at_least).select(
        "sr_type", F.col("n").alias("request_count")
    )


def _high_volume_stats(facts: DataFrame, areas: DataFrame, at_least: int) -> DataFrame:
    """Statistics per type and quartile for types of enough volume.

    A type's volume is the sum of its four counts, so the facts are read once.
    """
    known = facts.where(F.col("sr_type").isNotNull())
    return _of_volume(_stats(known, areas, ["sr_type", QUARTILE]), at_least)


def _of_volume(stats: DataFrame, at_least: int) -> DataFrame:
    volume = F.sum("request_count").over(Window.partitionBy("sr_type"))
    return stats.withColumn("volume", volume).where(F.col("volume") >= at_least)


def equity_by_type(facts: DataFrame, areas: DataFrame, at_least: int = HIGH_VOLUME) -> DataFrame:
    """The same per service type and quartile, for types of enough volume."""
    keys = ["sr_type", QUARTILE]
    return _summary(_high_volume_stats(facts, areas, at_least), keys)


def equity_by_type_of(counts: DataFrame, areas: DataFrame, at_least: int = HIGH_VOLUME) -> DataFrame:
    """``equity_by_type`` from ``comparable_counts``."""
    keys = ["sr_type", QUARTILE]
    known = counts.where(F.col("sr_type").isNotNull())
    return _summary(_of_volume(_stats_of(known, areas, keys), at_least), keys)


def equity_gap(facts: DataFrame, areas: DataFrame, at_least: int = HIGH_VOLUME) -> DataFrame:
    """Per type: median of the lowest and the highest quartile and the gap in percent.

    The gap is taken before the medians are rounded, and is itself rounded half away
    from zero. It is NULL when a quartile is missing or its median is zero.
    """

    def of_quartile(number: int, column: Column) -> Column:
        return F.max(F.when(F.col(QUARTILE) == number, column))

    low, high = F.col("low"), F.col("high")
    hundredfold = (low - high) * F.lit(100)
    size = F.call_function(
        "div", F.lit(2) * F.abs(hundredfold) + high, F.lit(2) * F.nullif(high, F.lit(0))
    )
    per_type = _high_volume_stats(facts, areas, at_least).groupBy("sr_type").agg(
        of_quartile(1, median_hours()).alias("low_income_median"),
        of_quartile(QUARTILES, median_hours()).alias("high_income_median"),
        of_quartile(1, F.col("median_twice")).alias("low"),
        of_quartile(QUARTILES, F.col("median_twice")).alias("high"),
    )
    return per_type.select(
        "sr_type",
        "low_income_median",
        "high_income_median",
        (F.signum(hundredfold).cast("bigint") * size).alias("gap_pct"),
    )

"""Staging, fact and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairwait.functions.flags import is_real_request
from fairwait.functions.text import to_int_rounded
from fairwait.functions.time import weekday
from fairwait.operators.ranks import with_tile
from fairwait.schemas import QUARTILES

# The columns of each model.
STAGED = (
    "sr_number",
    "sr_type",
    "sr_short_code",
    "owner_department",
    "status",
    "origin",
    "created_ts",
    "closed_ts",
    "resolution_hours",
    "is_closed",
    "has_valid_resolution",
    "community_area",
    "ward",
    "zip_code",
    "latitude",
    "longitude",
    "has_valid_geo",
    "created_date_only",
)
CENSUS_RATES = (
    "pct_housing_crowded",
    "pct_below_poverty",
    "pct_unemployed",
    "pct_no_hs_diploma",
    "pct_under18_over64",
)
AREA_COLUMNS = (
    "community_area",
    "community_area_name",
    "per_capita_income",
    "hardship_index",
    "pct_below_poverty",
    "pct_unemployed",
)


def stg_requests(raw: DataFrame) -> DataFrame:
    """Loaded requests with the flag that tells real requests from calls for information."""
    real = is_real_request(F.col("sr_type")).alias("is_real_service_request")
    return raw.select(*[F.col(c).alias(c) for c in STAGED], real)


def stg_census(seed: DataFrame) -> DataFrame:
    """Typed census rows; the citywide total has no area number and drops out."""
    return seed.where(F.col("community_area_number").isNotNull()).select(
        to_int_rounded(F.col("community_area_number")).alias("community_area"),
        "community_area_name",
        *[F.col(c).try_cast("double").alias(c) for c in CENSUS_RATES],
        *[to_int_rounded(F.col(c)).alias(c) for c in ("per_capita_income", "hardship_index")],
    )


def fct_requests(staged: DataFrame) -> DataFrame:
    """One row per request, unknown areas included."""
    return staged.select(
        "sr_number",
        F.col("created_date_only").alias("date_day"),
        "community_area",
        "sr_type",
        "status",
        "origin",
        "resolution_hours",
        "is_closed",
        "has_valid_resolution",
        "is_real_service_request",
        "has_valid_geo",
    )


def dim_date(staged: DataFrame) -> DataFrame:
    """The dates on which requests were made, and only those."""
    day = F.col("date_day")
    days = staged.select(F.col("created_date_only").alias("date_day")).distinct()
    return days.where(day.isNotNull()).select(
        "date_day",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day_of_month"),
        weekday(day).alias("day_of_week"),
        F.date_format(day, "MMM").alias("month_name"),
        weekday(day).isin(0, 6).alias("is_weekend"),
    )


def dim_service_type(staged: DataFrame) -> DataFrame:
    """One row per type; an unknown type is a row of its own.

    A maximum of text makes Spark sort its input, so it is taken over the few distinct
    combinations, which a hash aggregation finds. The test on the count, always true,
    keeps the optimizer from merging the two aggregations back into one.
    """
    combinations = (
        staged.groupBy("sr_type", "sr_short_code", "owner_department", "is_real_service_request")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 0)
    )
    return combinations.groupBy("sr_type").agg(
        F.max("sr_short_code").alias("sr_short_code"),
        F.max("owner_department").alias("owner_department"),
        F.bool_or("is_real_service_request").alias("is_real_service_request"),
    )


def dim_area(census: DataFrame) -> DataFrame:
    """Areas with their income quartile: 1 is the lowest, an unknown income ranks last."""
    areas = census.select(*AREA_COLUMNS)
    return with_tile(areas, QUARTILES, ["per_capita_income", "community_area"], "income_quartile")

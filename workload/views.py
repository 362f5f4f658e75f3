"""Requests, census and tables, derived from the driver tables.

A request is a line item: its key is order and line number (which repeat, as versions do),
it is opened when the order was placed and closed when the line shipped. Areas are the
customers' nations. Times of day come from amounts, so durations have every length.
Blanks, unknown values and malformed texts appear where a column has a certain value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fairwait.plans import star
from fairwait.plans.clean import clean, latest_typed, with_months, with_outcome
from fairwait.session import shared_path
from fairwait.sources.scans import scan_silver
from fairwait.sources.sinks import write_partitioned

# Settles line items of the same key and ship date.
LINE_TIES = ("l_extendedprice", "l_partkey", "l_suppkey")
LINE_KEY = ["l_orderkey", "l_linenumber"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_time_of_day(day: Column, amount: Column) -> Column:
    """``day`` at a second of the day given by the whole part of ``amount``."""
    return F.timestamp_add("SECOND", F.floor(amount) % F.lit(86_400), day)


def iso_text(ts: Column) -> Column:
    """Whole seconds in the raw text form, independent of the session time zone."""
    return F.concat(F.translate(ts.cast("string"), " ", "T"), F.lit(".000"))


def latitude_text() -> Column:
    """From 41.55 to 42.15 in steps of 0.06: the outer two lie outside the box."""
    return (F.col("l_discount").cast("decimal(4,2)") * F.lit(6) + F.expr("41.55")).cast("string")


def longitude_text() -> Column:
    """From -88 to -87.5 in steps of 0.0625: the last one lies on the bound."""
    return (F.col("l_tax").cast("decimal(4,2)") * F.expr("6.25") - F.lit(88)).cast("string")


def bronze_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text records, with the ``LINE_TIES`` columns besides."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    orders = table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    lines = table(spark, sf_dir, "lineitem")

    priority = F.col("o_orderpriority")
    kind = (
        F.when(priority == "4-NOT SPECIFIED", "INFORMATION ONLY CALL")
        .when(priority == "5-LOW", "Aircraft Noise Complaint")
        .otherwise(priority)
    )
    created = iso_text(with_time_of_day(F.col("o_orderdate"), F.col("o_totalprice")))
    undated = (F.col("o_orderstatus") == "P") & (F.col("c_mktsegment") == "MACHINERY")
    closed = iso_text(with_time_of_day(F.col("l_shipdate"), F.col("l_extendedprice")))
    without_millis = (F.col("l_returnflag") == "R") & (F.col("l_discount") == 0.05)
    completed = F.col("l_linestatus") == "F"
    located = F.col("l_tax") > 0
    area = (F.col("c_nationkey") + F.lit(1)).cast("string")

    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("sr_number"),
        kind.alias("sr_type"),
        F.substring(priority, 1, 1).alias("sr_short_code"),
        F.col("c_mktsegment").alias("owner_department"),
        F.when(completed, "Completed").otherwise("Open").alias("status"),
        F.col("l_returnflag").alias("origin"),
        F.when(~undated, created).alias("created_date"),
        iso_text(F.col("l_shipdate")).alias("last_modified_date"),
        F.when(completed & without_millis, F.substring(closed, 1, 19))
        .when(completed, closed)
        .alias("closed_date"),
        F.when(located, F.concat(F.lit(" "), area, F.lit(" "))).otherwise("").alias("community_area"),
        F.when(located, F.concat(F.col("l_linenumber").cast("string"), F.lit(".0")))
        .otherwise("")
        .alias("ward"),
        F.when(located, F.col("l_suppkey").cast("string")).otherwise("  ").alias("zip_code"),
        (F.col("l_returnflag") == "R").alias("duplicate"),
        (F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")).alias("legacy_record"),
        F.when(located, latitude_text()).alias("latitude"),
        F.when(located, longitude_text()).alias("longitude"),
        *LINE_TIES,
    )


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(bronze_requests(spark, sf_dir), LINE_TIES)


def written_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as gate, load and models find it: written once, then scanned by each rule."""
    path = shared_path(spark, "silver")
    latest = with_months(latest_typed(bronze_requests(spark, sf_dir), LINE_TIES))
    write_partitioned(latest, path, derive=with_outcome)
    return scan_silver(spark, path)


def census_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Census text per nation and for all: whole mean balance as income, share in debt as poverty."""
    customer = table(spark, sf_dir, "customer")
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint")
    per_nation = customer.rollup("c_nationkey").agg(
        F.sum(cents).alias("cents"),
        F.count_if(F.col("c_acctbal") < 0).alias("in_debt"),
        F.count(F.lit(1)).alias("people"),
    )
    nation = table(spark, sf_dir, "nation")
    named = per_nation.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    tenths = F.call_function(
        "div", F.col("in_debt") * 2000 + F.col("people"), F.col("people") * 2
    )
    income = F.call_function("div", F.col("cents") * 2 + F.col("people") * 100, F.col("people") * 200)
    return named.select(
        (F.col("c_nationkey") + 1).cast("string").alias("community_area_number"),
        F.coalesce("n_name", F.lit("ALL")).alias("community_area_name"),
        F.lit("n/a").alias("pct_housing_crowded"),
        (tenths.cast("decimal(10,0)") / F.lit(10)).cast("decimal(10,1)").cast("string").alias("pct_below_poverty"),
        F.concat(F.col("n_regionkey").cast("string"), F.lit(".5")).alias("pct_unemployed"),
        F.lit("").alias("pct_no_hs_diploma"),
        F.col("people").cast("string").alias("pct_under18_over64"),
        income.cast("string").alias("per_capita_income"),
        F.col("n_regionkey").cast("string").alias("hardship_index"),
    )


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_area(star.stg_census(census_seed(spark, sf_dir)))


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fct_requests(star.stg_requests(silver(spark, sf_dir)))

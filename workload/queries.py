"""One query per operator, each over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

import pyarrow as pa
from pyarrow import dataset
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from fairwait.functions.flags import is_inside, is_real_request, is_valid_duration
from fairwait.functions import text
from fairwait.functions.text import to_double, to_int
from fairwait.functions.time import elapsed_seconds, seconds_to_hours, wall_clock
from fairwait.operators import fingerprints, rules, versions
from fairwait.plans import equity, jobs, maintained, star
from fairwait.plans.clean import KEY, LATEST, typed_versions, with_months, with_outcome
from fairwait.schemas import LATITUDE_BOUNDS
from fairwait.session import shared_path
from fairwait.sources import census, landing, scans, sinks, windows
from fairwait.streaming import upsert
from workload.views import (
    LINE_KEY,
    LINE_TIES,
    areas,
    bronze_requests,
    census_seed,
    facts,
    latitude_text,
    longitude_text,
    silver,
    table,
    with_time_of_day,
    written_silver,
)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(run: Query) -> Query:
    REGISTRY[run.__name__] = run
    return run


def dates_as_text(df: DataFrame) -> DataFrame:
    """ISO text for dates, which the two engines hand over as different objects."""
    dates = [f.name for f in df.schema if isinstance(f.dataType, DateType)]
    return df.withColumns({c: F.col(c).cast("string") for c in dates})


# --- clean -------------------------------------------------------------------------


@query
def clean_requests(spark, sf_dir):
    return dates_as_text(silver(spark, sf_dir))


@query
def build_silver(spark, sf_dir):
    """Land the raw records, run the job, read its output."""
    landed, out = shared_path(spark, "bronze"), shared_path(spark, "silver")
    sinks.land_json(bronze_requests(spark, sf_dir).drop(*LINE_TIES), landed)
    jobs.build_silver(spark, landed, out)
    return dates_as_text(scans.scan_silver(spark, out))


LINE_COLUMNS = (*LINE_KEY, "l_shipdate", *LINE_TIES, "l_quantity", "l_tax")


@query
def latest_version(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    return versions.latest_version(lines, LINE_KEY, "l_shipdate", LINE_TIES)


@query
def merge_pulls(spark, sf_dir):
    """Two pulls that overlap by a year; the older one lacks a column."""
    lines = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    shipped = F.col("l_shipdate")
    old = shipped.isNull() | (shipped < F.lit("1999-01-01").cast("timestamp_ntz"))
    older = lines.where(old).drop("l_tax")
    newer = lines.where(shipped >= F.lit("1998-01-01").cast("timestamp_ntz"))
    return versions.merge_pulls([older, newer], LINE_KEY, "l_shipdate", (*LINE_TIES, "l_tax"))


@query
def parse_timestamps(spark, sf_dir):
    """Milliseconds for most events, none for clicks, no time at all for errors."""
    iso = F.translate(F.col("ts").cast("string"), " ", "T")
    whole = F.when(F.length(iso) == 19, F.concat(iso, F.lit("."))).otherwise(iso)
    kind = F.col("event_type")
    raw = (
        F.when(kind == "click", F.substring(iso, 1, 19))
        .when(kind == "error", F.concat(F.lit("at "), iso))
        .otherwise(F.substring(F.rpad(whole, 26, "0"), 1, 23))
    )
    return table(spark, sf_dir, "events").select("event_id", wall_clock(raw).alias("parsed_ts"))


@query
def blank_to_null(spark, sf_dir):
    """Padded, blank, fractional and non-numeric text, by part type."""
    kind = F.col("p_type")

    def dirty(value: Column) -> Column:
        return (
            F.when(kind == "PROMO", F.lit("   "))
            .when(kind == "SMALL", F.lit("n/a"))
            .otherwise(F.concat(F.lit("  "), value, F.lit(" ")))
        )

    size = F.col("p_size").cast("string")
    sized = F.when(kind == "LARGE", F.concat(size, F.lit(".7"))).otherwise(size)
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        text.blank_to_null(dirty(F.col("p_name"))).alias("name"),
        to_int(dirty(sized)).alias("size"),
        to_double(dirty(F.col("p_retailprice").cast("string"))).alias("price"),
    )


def _event_seconds() -> Column:
    """From an event to noon of its day; negative after noon, unknown for sign-ups."""
    noon = F.timestamp_add("HOUR", F.lit(12), F.date_trunc("DAY", F.col("ts")).cast("timestamp_ntz"))
    return elapsed_seconds(F.col("ts"), F.when(F.col("event_type") != "signup", noon))


@query
def resolution_hours(spark, sf_dir):
    seconds = _event_seconds()
    hours = F.when(seconds >= 0, seconds_to_hours(seconds))
    return table(spark, sf_dir, "events").select("event_id", hours.alias("resolution_hours"))


@query
def resolution_flags(spark, sf_dir):
    """Every version of a line, not only the latest."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    lines = table(spark, sf_dir, "lineitem")
    created = with_time_of_day(F.col("o_orderdate"), F.col("o_totalprice"))
    shipped = with_time_of_day(F.col("l_shipdate"), F.col("l_extendedprice"))
    closed = F.when(F.col("l_linestatus") == "F", shipped)
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        *LINE_KEY,
        "l_extendedprice",
        closed.isNotNull().alias("is_closed"),
        is_valid_duration(elapsed_seconds(created, closed)).alias("has_valid_resolution"),
    )


@query
def geo_flag(spark, sf_dir):
    latitude = to_double(F.when(F.col("l_tax") > 0, latitude_text()))
    longitude = to_double(F.when(F.col("l_tax") < 0.08, longitude_text()))
    return table(spark, sf_dir, "lineitem").select(
        *LINE_KEY,
        "l_extendedprice",
        latitude.alias("latitude"),
        longitude.alias("longitude"),
        is_inside(latitude, longitude).alias("has_valid_geo"),
    )


@query
def calendar_columns(spark, sf_dir):
    created = with_time_of_day(F.col("o_orderdate"), F.col("o_totalprice"))
    placed = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        created.alias("created_ts"),
        created.cast("date").alias("created_date_only"),
        F.year(created).alias("created_year"),
        F.month(created).alias("created_month"),
    )
    return dates_as_text(placed)


@query
def real_request_flag(spark, sf_dir):
    """Urgent orders have no type here, and so count as real."""
    kind = F.nullif(F.lower("o_orderpriority"), F.lit("1-urgent"))
    flag = is_real_request(kind, ("%NOT specified%", "%low%"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", kind.alias("sr_type"), flag.alias("is_real_service_request")
    )


# --- star schema and comparison ----------------------------------------------------


@query
def stg_requests(spark, sf_dir):
    return dates_as_text(star.stg_requests(silver(spark, sf_dir)))


@query
def stg_dimension(spark, sf_dir):
    return star.stg_census(census_seed(spark, sf_dir))


@query
def fct_requests(spark, sf_dir):
    return dates_as_text(facts(spark, sf_dir))


@query
def dim_area(spark, sf_dir):
    return areas(spark, sf_dir)


@query
def dim_date(spark, sf_dir):
    """Dates of orders; those of status P count as undated."""
    created = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date"))
    placed = table(spark, sf_dir, "orders").select(created.alias("created_date_only"))
    return dates_as_text(star.dim_date(placed))


@query
def dim_service_type(spark, sf_dir):
    """Part types as request types; promotions have no type and form a row of their own."""
    kind = F.nullif("p_type", F.lit("PROMO"))
    staged = table(spark, sf_dir, "part").select(
        kind.alias("sr_type"),
        F.col("p_brand").alias("sr_short_code"),
        F.col("p_name").alias("owner_department"),
        is_real_request(kind, ("%small%",)).alias("is_real_service_request"),
    )
    return star.dim_service_type(staged)


@query
def equity_by_quartile(spark, sf_dir):
    return equity.equity_by_quartile(facts(spark, sf_dir), areas(spark, sf_dir))


@query
def equity_by_type(spark, sf_dir):
    return equity.equity_by_type(facts(spark, sf_dir), areas(spark, sf_dir))


@query
def high_volume_types(spark, sf_dir):
    return equity.high_volume_types(facts(spark, sf_dir), areas(spark, sf_dir))


def _middle_volume(spark: SparkSession, sf_dir: str) -> int:
    """Requests of the middle type by volume: as a threshold it keeps that type, on the edge."""
    volumes = equity.high_volume_types(facts(spark, sf_dir), areas(spark, sf_dir), 1)
    return int(volumes.agg(F.expr("percentile_disc(0.5) within group (order by request_count)")).first()[0] or 1)


@query
def high_volume_types_on_edge(spark, sf_dir):
    at_least = _middle_volume(spark, sf_dir)
    return equity.high_volume_types(facts(spark, sf_dir), areas(spark, sf_dir), at_least)


@query
def equity_by_type_on_edge(spark, sf_dir):
    at_least = _middle_volume(spark, sf_dir)
    return equity.equity_by_type(facts(spark, sf_dir), areas(spark, sf_dir), at_least)


@query
def equity_gap(spark, sf_dir):
    return equity.equity_gap(facts(spark, sf_dir), areas(spark, sf_dir))


# --- sources and sinks -------------------------------------------------------------

EVENT_TEXT = StructType(
    [StructField(c, StringType()) for c in ("event_id", "ts", "user_id", "event_type", "value", "props")]
)


# Events carry microseconds.
EVENT_TIME = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _typed_events(records: DataFrame) -> DataFrame:
    types = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "value": "double"}
    return records.select(
        *[F.col(c).try_cast(types[c]).alias(c) if c in types else c for c in EVENT_TEXT.names]
    )


@query
def bronze_json_scan(spark, sf_dir):
    path = shared_path(spark, "events")
    sinks.land_json(table(spark, sf_dir, "events"), path, **EVENT_TIME)
    return _typed_events(scans.scan_json(spark, path, EVENT_TEXT))


@query
def bronze_landing_roundtrip(spark, sf_dir):
    """Windows of ten days, undated events in one of their own; all are landed twice and replaced."""
    path, events = shared_path(spark, "windows"), table(spark, sf_dir, "events")
    for _ in range(2):
        jobs.land_windows(events, path, 10, on="ts", **EVENT_TIME)
    return _typed_events(scans.scan_json(spark, path, EVENT_TEXT))


@query
def landing_survives_a_failure(spark, sf_dir):
    """Events landed; then the same window is landed again and fails half way; what is read is the first landing."""
    path, events = shared_path(spark, "windows"), table(spark, sf_dir, "events")
    sinks.land_json(events, path, **EVENT_TIME)
    broken = events.withColumn("value", F.when(F.col("event_id") % 7 == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("value")))
    try:
        sinks.land_json(broken, path, **EVENT_TIME)
    except PySparkException:
        pass
    return _typed_events(scans.scan_json(spark, path, EVENT_TEXT))


def _event_service(spark: SparkSession, sf_dir: str) -> tuple[Callable, Callable]:
    """A stand-in for a paged service over the events, written by hour and read page by page where it is asked."""
    path = shared_path(spark, "service")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    records = table(spark, sf_dir, "events").where("ts is not null").withColumn("ts", stamp)
    hours = records.withColumn("hour", F.translate(F.substring("ts", 1, 13), ":", "-"))
    hours.hint("rebalance", "hour").sortWithinPartitions("hour", "ts", "event_id").write.partitionBy("hour").parquet(path)
    local = path.removeprefix("file:")

    def asked(condition: str) -> dataset.Scanner:
        low, high = condition.split("'")[1::2]
        within = (dataset.field("ts") >= low) & (dataset.field("ts") < high)
        hours = (dataset.field("hour") >= low[:13]) & (dataset.field("hour") <= high[:13])
        kind = dataset.partitioning(pa.schema([("hour", pa.string())]), flavor="hive")
        return dataset.dataset(local, partitioning=kind).scanner(filter=within & hours)

    def fetch(condition: str, offset: int, size: int) -> list[dict]:
        found = asked(condition).to_table().sort_by([("ts", "ascending"), ("event_id", "ascending")]).drop(["hour"])
        return [{k: None if v is None else str(v) for k, v in row.items()} for row in found.slice(offset, size).to_pylist()]

    return fetch, lambda condition: asked(condition).count_rows()


@query
def landing_resumed(spark, sf_dir):
    """January's events from a paged service that fails for one hour, then from one that does not: the second job
    fetches what the first one did not."""
    fetch, count = _event_service(spark, sf_dir)
    out, days = shared_path(spark, "bronze"), ("2024-01-01", "2024-02-01")
    options = {"on": "ts", "size": 1000, "at_once": 8, "count": count}

    def failing(condition: str, offset: int, size: int) -> list[dict]:
        page = fetch(condition, offset, size)
        if any(record["ts"].startswith("2024-01-20T1") for record in page):
            raise RuntimeError("gone")
        return page

    try:
        jobs.land_pages(spark, failing, *days, out, **options)
    except landing.LandingIncomplete:
        pass
    jobs.land_pages(spark, fetch, *days, out, **options)
    return _typed_events(scans.scan_json(spark, out, EVENT_TEXT))


@query
def field_census(spark, sf_dir):
    """Orders as four pulls by priority: as declared, one field left out, one renamed, one retyped beside a new one."""
    path, orders = shared_path(spark, "pulls"), table(spark, sf_dir, "orders")
    text = orders.select(*[F.col(c).cast("string").alias(c) for c in ORDER_TEXT.names], "o_custkey")
    pulls = {
        "1-URGENT": lambda df: df.drop("o_custkey"),
        "2-HIGH": lambda df: df.drop("o_custkey", "o_orderstatus"),
        "3-MEDIUM": lambda df: df.drop("o_custkey").withColumnRenamed("o_totalprice", "total"),
        "5-LOW": lambda df: df.withColumn("o_orderkey", F.col("o_orderkey").cast("bigint")),
    }
    for priority, change in pulls.items():
        sinks.land_json(change(text.where(F.col("o_orderpriority") == priority)), f"{path}/{priority}")
    return census.field_census(spark, path, ORDER_TEXT)


def _dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with year and month; those of status P have neither."""
    placed = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_totalprice",
        F.year(placed).alias("created_year"),
        F.month(placed).alias("created_month"),
    )


@query
def silver_partition_roundtrip(spark, sf_dir):
    path = shared_path(spark, "orders")
    sinks.write_partitioned(_dated_orders(spark, sf_dir), path)
    return scans.scan_silver(spark, path, schema=None)


@query
def silver_partition_scan(spark, sf_dir):
    """Rows per partition: the scan reads partition values and row counts only."""
    path = shared_path(spark, "orders")
    sinks.write_partitioned(_dated_orders(spark, sf_dir), path)
    return (
        scans.scan_silver(spark, path, schema=None)
        .groupBy("created_year", "created_month")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


ORDER_TEXT = StructType(
    [StructField(c, StringType()) for c in ("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")]
)
CUSTOMER_TEXT = StructType(
    [StructField(c, StringType()) for c in ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")]
)


@query
def seed_csv_scan(spark, sf_dir):
    """Customers as quoted CSV with an empty segment for builders."""
    path = shared_path(spark, "seed")
    segment = F.nullif("c_mktsegment", F.lit("BUILDING"))
    people = table(spark, sf_dir, "customer").withColumn("c_mktsegment", segment)
    people.select(*CUSTOMER_TEXT.names).write.option("quoteAll", True).csv(path, header=True)
    return scans.scan_seed(spark, path, CUSTOMER_TEXT)


@query
def window_extract(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return windows.window_extract(events, "ts", "2024-01-10", "2024-01-13")


@query
def incremental_extract(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return windows.incremental_extract(events, "ts", date(2024, 1, 20), 3)


@query
def ordered_page(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return windows.ordered_page(events, ["ts", "event_id"], offset=200, size=100)


@query
def page_after(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return windows.page_after(events, ["ts", "event_id"], (datetime(2024, 1, 15), 0), size=100)


@query
def silver_conform(spark, sf_dir):
    """Written silver has its partition columns last; the declared target has its own order."""
    return dates_as_text(sinks.conform(written_silver(spark, sf_dir)))


@query
def load_dry_run(spark, sf_dir):
    return jobs.load_plan(silver(spark, sf_dir))


@query
def warehouse_reload(spark, sf_dir):
    """Loaded twice: the second load replaces the first."""
    path, cleaned = shared_path(spark, "raw"), written_silver(spark, sf_dir)
    jobs.load(cleaned, path=path)
    jobs.load(cleaned, path=path)
    return star.stg_requests(scans.scan_raw(spark, path=path)).select(
        "sr_number", "status", "community_area", "resolution_hours"
    )


@query
def load_reconcile(spark, sf_dir):
    path, cleaned = shared_path(spark, "raw"), written_silver(spark, sf_dir)
    sinks.replace_table(sinks.conform(cleaned), path=path)
    return sinks.reconcile(cleaned, scans.scan_raw(spark, path=path))


@query
def reconcile_difference(spark, sf_dir):
    """All versions were to be loaded, and the target holds the latest ones."""
    path = shared_path(spark, "raw")
    sinks.replace_table(sinks.conform(written_silver(spark, sf_dir)), path=path)
    return sinks.reconcile(table(spark, sf_dir, "lineitem"), scans.scan_raw(spark, path=path))


@query
def reconcile_rows(spark, sf_dir):
    """The rows by which a loaded table of equal size differs from silver, by key.

    Sixth lines got another number, seventh lines of closed requests another status, and one type of request lost a column.
    """
    path, cleaned = shared_path(spark, "raw"), sinks.conform(written_silver(spark, sf_dir))
    number, closed = F.col("sr_number"), F.col("is_closed")
    altered = cleaned.withColumns(
        {
            "status": F.when(number.endswith("-7") & closed, F.lower("status")).otherwise(F.col("status")),
            "origin": F.when(F.col("sr_type") != "2-HIGH", F.col("origin")).when(number.endswith("-5"), None).otherwise(F.col("origin")),
        }
    ).withColumn("sr_number", F.when(number.endswith("-6"), F.concat(number, F.lit("b"))).otherwise(number))
    sinks.replace_table(altered, path=path)
    loaded = scans.scan_raw(spark, path=path)
    return fingerprints.differing_rows(cleaned, loaded, ["sr_number"], by=["created_year", "created_month"])


@query
def reconcile_partitions(spark, sf_dir):
    """Months in which versions and latest versions are not the same rows. Versions are typed once and read twice."""
    path = shared_path(spark, "versions")
    typed_versions(bronze_requests(spark, sf_dir), LINE_TIES).write.parquet(path)
    everything = spark.read.parquet(path)
    latest = versions.latest_version(everything, KEY, LATEST, LINE_TIES)
    return fingerprints.differing_partitions(with_outcome(everything), with_outcome(latest), ["created_year", "created_month"])


@query
def row_counts(spark, sf_dir):
    """Rows of every stage."""
    stages = {
        "bronze": table(spark, sf_dir, "lineitem"),
        "silver": table(spark, sf_dir, "lineitem").select(*LINE_KEY).distinct(),
        "orders": table(spark, sf_dir, "orders"),
    }
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("stage"), "row_count")
        for name, df in stages.items()
    ]
    return reduce(DataFrame.unionByName, counts)


# --- data quality ------------------------------------------------------------------

LINE_RULES = (
    rules.not_null("l_orderkey"),
    rules.unique(*LINE_KEY),
    rules.between("l_discount", low=0.0, high=0.1),
    rules.in_set("l_linestatus", ("F", "O")),
)


def _latest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return versions.latest_version(lines, LINE_KEY, "l_shipdate", LINE_TIES)


@query
def gate_report(spark, sf_dir):
    return jobs.gate(written_silver(spark, sf_dir))


@query
def gate_verdict(spark, sf_dir):
    """All versions fail for repeated keys, the latest versions pass."""
    lines = table(spark, sf_dir, "lineitem")
    everything = rules.verdict(rules.report(lines, LINE_RULES))
    latest = rules.verdict(rules.report(_latest_lines(spark, sf_dir), LINE_RULES))
    return everything.withColumn("dataset", F.lit("versions")).unionByName(
        latest.withColumn("dataset", F.lit("latest"))
    )


@query
def expect_unique(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    suite = (rules.unique(*LINE_KEY), rules.unique("l_orderkey"))
    people = rules.report(table(spark, sf_dir, "customer"), [rules.unique("c_custkey")])
    return rules.report(lines, suite).unionByName(people)


@query
def expect_mostly(spark, sf_dir):
    suite = (
        rules.between("l_discount", low=0.02, mostly=0.75),
        rules.between("l_discount", high=0.08, mostly=0.95),
        rules.between("l_tax", low=0.01, high=0.06, mostly=0.5),
        rules.between("l_quantity", low=1),
    )
    return rules.report(table(spark, sf_dir, "lineitem"), suite)


@query
def expect_in_set(spark, sf_dir):
    suite = (
        rules.in_set("l_returnflag", ("A", "N", "R")),
        rules.in_set("l_linestatus", ("F",), severity="warn"),
    )
    return rules.report(table(spark, sf_dir, "lineitem"), suite)


@query
def unexpected_values(spark, sf_dir):
    """What breaks the rules most often; parts of several orders repeat, as do order numbers."""
    suite = (
        rules.between("l_discount", low=0.02, high=0.08),
        rules.in_set("l_returnflag", ("N",)),
        rules.not_null("l_orderkey"),
        rules.unique("l_orderkey"),
    )
    return rules.unexpected_values(table(spark, sf_dir, "lineitem"), suite, 4)


@query
def model_tests(spark, sf_dir):
    """Staging, dimensions and the fact, written from silver, and the tests over them."""
    return jobs.model_tests(_models(spark, written_silver(spark, sf_dir), sf_dir, marts=False))


def _models(spark: SparkSession, raw: DataFrame, sf_dir: str, marts: bool = True) -> dict[str, DataFrame]:
    """Models written to the shared folder and read back."""
    out, seed = shared_path(spark, "models"), census_seed(spark, sf_dir)
    return jobs.build_marts(raw, seed, out=out, at_least=1, check=lambda models: marts)


@query
def model_tests_failing(spark, sf_dir):
    """The same over all versions: numbers repeat, those of the seventh lines are missing, and
    urgent requests have no type."""
    versions_ = with_months(typed_versions(bronze_requests(spark, sf_dir)))
    raw, path = shared_path(spark, "raw"), shared_path(spark, "versions")
    sinks.write_partitioned(versions_, path, derive=with_outcome)
    cleaned = scans.scan_silver(spark, path).withColumns(
        {
            "sr_number": F.when(~F.col("sr_number").endswith("-7"), F.col("sr_number")),
            "sr_type": F.nullif("sr_type", F.lit("1-URGENT")),
        }
    )
    sinks.replace_table(sinks.upper_names(sinks.conform(cleaned)), path=raw)
    return jobs.model_tests(_models(spark, scans.scan_raw(spark, path=raw), sf_dir, marts=False))


def _both_marts(models: dict[str, DataFrame]) -> DataFrame:
    """Rows of the mart by type, and those of the mart by quartile without a type."""
    by_type, whole = models["mart_equity_by_type"], models["mart_service_equity"]
    return by_type.unionByName(whole.withColumn("sr_type", F.lit(None).cast("string")))


@query
def build_marts(spark, sf_dir):
    """Silver loaded, all models written, the marts read back."""
    raw = shared_path(spark, "raw")
    jobs.load(written_silver(spark, sf_dir), path=raw)
    return _both_marts(_models(spark, scans.scan_raw(spark, path=raw), sf_dir))


@query
def failed_build_keeps_models(spark, sf_dir):
    """All models built; then a build over half of the requests whose tests fail: the marts read back are the first ones."""
    raw, out, seed = written_silver(spark, sf_dir), shared_path(spark, "models"), census_seed(spark, sf_dir)
    jobs.build_marts(raw, seed, out=out, at_least=1)
    half = raw.where(F.pmod(F.xxhash64("sr_number"), F.lit(2)) == 0)
    jobs.build_marts(half, seed, out=out, at_least=1, check=lambda models: False)
    return _both_marts(jobs.read_models(spark, out))


@query
def mart_views(spark, sf_dir):
    """SQL over the views of all models: types against all requests, with the areas of a quartile."""
    jobs.create_views(_models(spark, written_silver(spark, sf_dir), sf_dir))
    return spark.sql("""
        select t.sr_type, t.income_quartile, t.request_count, s.request_count as of_quartile,
            a.areas, t.median_resolution_hours > s.median_resolution_hours as is_slower
        from mart_equity_by_type t
        join mart_service_equity s on t.income_quartile = s.income_quartile
        join (select income_quartile, count(*) as areas from dim_community_area group by income_quartile) a
            on t.income_quartile = a.income_quartile""")


@query
def run_all(spark, sf_dir):
    """Land in monthly windows, clean, gate, load, model and test; then the marts as written.

    Coordinates outside the box are left out of the raw records, which would stop the gate.
    """
    places = {name: shared_path(spark, name) for name in ("bronze", "silver", "raw", "marts", "seed")}
    inside = F.col("latitude").cast("double").between(*LATITUDE_BOUNDS)
    records = bronze_requests(spark, sf_dir).drop(*LINE_TIES)
    jobs.land_windows(records.withColumn("latitude", F.when(inside, F.col("latitude"))), places["bronze"], 31)
    census_seed(spark, sf_dir).write.option("quoteAll", True).csv(places["seed"], header=True)
    return _both_marts(jobs.run_all(spark, jobs.Settings(**places, at_least=1)))


@query
def test_relationships(spark, sf_dir):
    """Orders all have a customer; a part of the documents has no label, which only warns."""
    models = {name: table(spark, sf_dir, name) for name in ("orders", "customer", "documents", "labels")}
    tests = (
        rules.RelationTest("orders", "o_custkey", "customer", "c_custkey"),
        rules.RelationTest("documents", "doc_id", "labels", "doc_id", "warn"),
        rules.RelationTest("labels", "doc_id", "documents", "doc_id"),
    )
    return rules.run_model_tests(models, tests)


# --- streaming ---------------------------------------------------------------------


@query
def incremental_upsert(spark, sf_dir):
    """Lines arrive as JSON in three drops, by a hash of the row; the log gives the latest."""
    landed, log, progress = (shared_path(spark, p) for p in ("drops", "log", "progress"))
    lines = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS, "l_returnflag")
    text = StructType([StructField(c, StringType()) for c in lines.columns])
    kinds = {f.name: f.dataType for f in lines.schema}

    def typed(batch: DataFrame) -> DataFrame:
        return batch.select(*[F.col(c).try_cast(kinds[c]).alias(c) for c in kinds])

    identity = {"key": LINE_KEY, "latest": "l_shipdate", "ties": (*LINE_TIES, "l_returnflag")}
    for third in range(3):
        drop = lines.where(F.pmod(F.xxhash64(*lines.columns), F.lit(3)) == third)
        sinks.land_json(drop.select(*[F.col(c).cast("string").alias(c) for c in kinds]), f"{landed}/{third}")
        upsert.append_versions(spark, landed, log, progress, schema=text, prepare=typed, **identity)
    return upsert.current_versions(spark, log, **identity)


def _request_drops(spark: SparkSession, sf_dir: str, landed: str, log: str, progress: str):
    """Versions of requests arrive in three drops, by a hash of the row; yields after each is in the log."""
    records = bronze_requests(spark, sf_dir).drop(*LINE_TIES)
    for third in range(3):
        drop = records.where(F.pmod(F.xxhash64("sr_number", "last_modified_date", "closed_date"), F.lit(3)) == third)
        sinks.land_json(drop, f"{landed}/{third}")
        upsert.append_versions(spark, landed, log, progress)
        yield third


@query
def upsert_publish_delta(spark, sf_dir):
    """Silver published after each of three drops: the second and third time only months that changed are written."""
    landed, log, progress, out = (shared_path(spark, p) for p in ("drops", "log", "progress", "silver"))
    for _ in _request_drops(spark, sf_dir, landed, log, progress):
        upsert.publish_silver(spark, log, out)
    return dates_as_text(scans.scan_silver(spark, out))


@query
def marts_by_difference(spark, sf_dir):
    """Counts of durations brought up to date after each of three drops, and the marts from them."""
    landed, log, progress, counts = (shared_path(spark, p) for p in ("drops", "log", "progress", "counts"))
    for _ in _request_drops(spark, sf_dir, landed, log, progress):
        maintained.advance_counts(spark, log, counts, ratio=2)
    return _both_marts(maintained.marts(spark, counts, areas(spark, sf_dir), at_least=1))

"""The jobs, in order: land, build silver, gate, load, build marts; and all of them at once."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fairwait.operators.fingerprints import differing_rows
from fairwait.operators.rules import (
    KeyTest,
    RelationTest,
    between,
    enforce,
    enforce_tests,
    in_set,
    not_null,
    report,
    run_model_tests,
    unique,
)
from fairwait.operators.versions import latest_version
from fairwait.plans import equity, star
from fairwait.plans.clean import KEY, LATEST, SEEN, TIES, typed_versions, with_outcome
from fairwait.schemas import (
    AREA_BOUNDS,
    HIGH_VOLUME,
    LATITUDE_BOUNDS,
    LONGITUDE_BOUNDS,
    SILVER_PARTITIONS,
    TIME_ZONE,
)
from fairwait.sources import sinks
from fairwait.sources.landing import land_slices
from fairwait.sources.pages import Fetch
from fairwait.sources.scans import absent_fields, scan_json, scan_raw, scan_seed, scan_silver
from fairwait.sources.snapshots import Folder, begin, commit, expire, replaced, state
from fairwait.sources.windows import incremental_window, window_extract

# The rules cleaned data must pass before it is loaded.
SILVER_RULES = (
    not_null("sr_number"),
    unique("sr_number"),
    not_null("status"),
    between("resolution_hours", low=0, mostly=1.0),
    between("community_area", *AREA_BOUNDS),
    between("latitude", *LATITUDE_BOUNDS),
    between("longitude", *LONGITUDE_BOUNDS),
    in_set("has_valid_resolution", (True, False)),
    in_set("has_valid_geo", (True, False)),
    in_set("is_closed", (True, False)),
)

# The tests the models must pass.
MODEL_TESTS = (
    KeyTest("stg_requests", "sr_number"),
    KeyTest("stg_census", "community_area"),
    KeyTest("dim_date", "date_day"),
    KeyTest("dim_community_area", "community_area"),
    KeyTest("dim_service_type", "sr_type"),
    KeyTest("fct_service_requests", "sr_number"),
    RelationTest(
        "fct_service_requests", "community_area", "dim_community_area", "community_area", "warn"
    ),
    RelationTest("fct_service_requests", "sr_type", "dim_service_type", "sr_type"),
)

# Tables written at the same time.
BUILD_THREADS = 4


class AbsentField(RuntimeError):
    """A declared field occurs in no landed record."""


class LoadMismatch(RuntimeError):
    """The loaded table and its source differ in their number of rows."""


def land_windows(
    source: DataFrame, out: str, days: int, on: str = "created_date", **options: str
) -> None:
    """Land all records in windows of ``days`` days at once, a folder per window.

    One scan and one write, however many windows there are. Windows are counted from 1970-01-01;
    records without a date have a folder of their own. Landing again replaces the windows that
    have records and leaves the others: all are written before the first one changes, and each changes at once.
    ``options`` go to ``to_json``.
    """
    spark, folder = source.sparkSession, Folder(source.sparkSession, out)
    first = F.floor(F.datediff(F.col(on).cast("date"), F.lit("1970-01-01").cast("date")) / days) * days
    record = F.to_json(F.struct("*"), {"ignoreNullFields": "false", **options})
    windows = source.select(
        record.alias("value"), F.date_add(F.lit("1970-01-01").cast("date"), first.cast("int")).alias("window")
    )
    batch = f"_batch-{uuid.uuid4().hex}"
    windows.hint("rebalance", "window").write.partitionBy("window").options(**sinks.PACKED).text(folder.at(batch))
    for name in sorted(n for n, is_folder in folder.names(batch).items() if is_folder):
        target = folder.at(name)
        number, _ = begin(spark, target)
        commit(spark, target, number, [f"../{batch}/{name}"])
        expire(spark, target)


def land_window(
    source: DataFrame, start: str, end: str, out: str, on: str = "created_date", **options: str
) -> int:
    """Land the records with ``start <= on < end`` in a folder of their own; returns their number.

    Landing the same window again replaces it. ``options`` go to ``land_json``.
    """
    records = window_extract(source, on, start, end)
    return sinks.land_json(records, f"{out}/{start}_to_{end}", **options)


def land_pages(
    spark: SparkSession, fetch: Fetch, start: str, end: str, out: str, **options
) -> int:
    """Land a window straight from a paged service, untouched; returns the number of records.

    ``options`` are those of ``land_slices``. A repeated job fetches only what the one before did not.
    """
    return land_slices(spark, fetch, start, end, f"{out}/{start}_to_{end}", **options)


def land_recent(
    source: DataFrame, as_of: date, days: int, out: str, on: str = "created_date"
) -> int:
    """Land the last ``days`` days before ``as_of`` and that day itself."""
    return land_window(source, *incremental_window(as_of, days), out, on)


def build_silver(
    spark: SparkSession, bronze: str | list[str], out: str, zone: str = TIME_ZONE
) -> dict[str, int]:
    """Clean all landed pulls into the partitioned dataset; returns row and reject counts.

    One pass over the raw text. ``silver_rows`` is taken in the writing tasks and exact. Where a
    column held no value at all, the text is searched for its name: a field that occurs in no
    record was renamed or left out by the source. ``AbsentField`` names it, and ``out`` stays as it was.
    """
    raw_counts, clean_counts = Observation(), Observation()
    versions = typed_versions(scan_json(spark, bronze), rejects=raw_counts)
    # The layout comes last: Spark leaves out a shuffle of no rows that is not, and both counts with it.
    silver = with_outcome(latest_version(versions, KEY, LATEST, TIES), zone)
    counted = silver.observe(clean_counts, F.count(F.lit(1)).alias("silver_rows"))

    def no_absent_field() -> None:
        seen = {name.removeprefix(SEEN): yes for name, yes in raw_counts.get.items() if name.startswith(SEEN)}
        unseen = [name for name, yes in seen.items() if yes is False]
        absent = absent_fields(spark, bronze, unseen) if unseen else []
        if absent:
            raise AbsentField(f"in no record below {bronze}: {', '.join(absent)}")

    sinks.write_partitioned(counted, out, check=no_absent_field)
    counts = {**raw_counts.get, **clean_counts.get}
    return {name: n for name, n in counts.items() if not name.startswith(SEEN)}


def gate(silver: DataFrame) -> DataFrame:
    """Report of ``SILVER_RULES``, one row per rule."""
    return report(silver, SILVER_RULES)


def load(
    silver: DataFrame, table: str | None = None, path: str | None = None
) -> dict[str, int | bool]:
    """Write silver in its declared shape, compare row counts, and only then make it the raw table.

    Other than as many rows as were to be loaded raise ``LoadMismatch``; the raw table then stays as it was.
    """
    spark, target = silver.sparkSession, sinks.upper_names(sinks.conform(silver))

    def compared(found: DataFrame) -> dict[str, int | bool]:
        counts = sinks.reconcile(silver, found).first().asDict()
        if not counts["matches"]:
            raise LoadMismatch(f"loaded {counts['target_rows']} of {counts['source_rows']} rows")
        return counts

    if table is not None:
        written = sinks.written_table(target, table)
        counts = compared(written.read())
        written.switch()
        return counts
    with replaced(spark, path) as folder:
        target.write.parquet(folder)
        return compared(spark.read.parquet(folder))


def load_differences(silver: DataFrame, table: str | None = None, path: str | None = None) -> DataFrame:
    """The keys by which the raw table differs from what ``load`` would make it; none after a load.

    Compared by month first, so months that agree are read once.
    """
    spark, wanted = silver.sparkSession, sinks.upper_names(sinks.conform(silver))
    months = [c.upper() for c in SILVER_PARTITIONS]
    return differing_rows(wanted, scan_raw(spark, table, path).select(*wanted.columns), [c.upper() for c in KEY], by=months)


def load_plan(silver: DataFrame) -> DataFrame:
    """The dry run of ``load``: columns, types and number of rows, nothing written."""
    return sinks.dry_run(sinks.upper_names(sinks.conform(silver)))


def build_marts(
    raw: DataFrame,
    seed: DataFrame,
    out: str | None = None,
    database: str | None = None,
    at_least: int = HIGH_VOLUME,
    check: Callable[[dict[str, DataFrame]], bool] | None = None,
) -> dict[str, DataFrame]:
    """All models by name. Tables are written as one state of ``out``, or into ``database``, and read back.

    ``check`` sees staging, the written dimensions and the written fact before any of them is published. When it raises
    or returns false, every model stays as it was; what was written is returned without marts, is nobody's state, and goes with
    the next build. Below ``out`` all models change with one commit. In a database each changes at once, one
    after the other, when all are written.

    Written dimensions have a known size, and each mart then reads the narrow fact. Tables
    that do not need each other are written at the same time. Without a target everything
    stays lazy.
    """
    spark = raw.sparkSession
    staged, census = star.stg_requests(raw), star.stg_census(seed)
    number, folder = begin(spark, out) if out is not None else (0, "")
    beside: list[sinks.WrittenTable] = []

    def table(name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if database is not None:
            beside.append(sinks.written_table(build(), f"{database}.{name}"))
            return beside[-1].read()
        if out is not None:
            build().write.parquet(f"{out}/{folder}/{name}")
            return spark.read.parquet(f"{out}/{folder}/{name}")
        return build()

    def tables(builds: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
        with ThreadPoolExecutor(BUILD_THREADS) as pool:
            built = pool.map(inheritable_thread_target(spark)(table), builds.keys(), builds.values())
            return dict(zip(builds, built))

    models = {"stg_requests": staged, "stg_census": census}
    models |= tables(
        {
            "fct_service_requests": lambda: star.fct_requests(staged),
            "dim_date": lambda: star.dim_date(staged),
            "dim_community_area": lambda: star.dim_area(census),
            "dim_service_type": lambda: star.dim_service_type(staged),
        }
    )
    if check is not None and not check(models):
        return models
    facts, areas = models["fct_service_requests"], models["dim_community_area"]
    models |= tables(
        {
            "mart_service_equity": lambda: equity.equity_by_quartile(facts, areas),
            "mart_equity_by_type": lambda: equity.equity_by_type(facts, areas, at_least),
        }
    )
    if out is not None:
        commit(spark, out, number, [folder])
        expire(spark, out)
    for written in sorted(beside, key=lambda w: w.table):
        written.switch()
        models[written.table.rpartition(".")[2]] = spark.table(written.table)
    return models


def publish_models(spark: SparkSession, models: dict[str, DataFrame], out: str) -> None:
    """Write ``models`` as one state of ``out``."""
    with replaced(spark, out) as folder:
        for name, model in models.items():
            model.write.parquet(f"{folder}/{name}")


def read_models(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The models of the current state of ``out``, all from the same build."""
    places = state(spark, out)
    found = Folder(spark, places[0])
    return {name: spark.read.parquet(found.at(name)) for name in sorted(found.names())}


def create_views(models: dict[str, DataFrame]) -> None:
    """Make every model a temporary view of its name, for SQL."""
    for name, model in models.items():
        model.createOrReplaceTempView(name)


def model_tests(models: dict[str, DataFrame]) -> DataFrame:
    return run_model_tests(models, MODEL_TESTS)


@dataclass(frozen=True)
class Settings:
    """Where one full run reads and writes. ``start`` and ``end`` bound the landed window."""

    bronze: str
    silver: str
    raw: str
    marts: str
    seed: str
    start: str | None = None
    end: str | None = None
    at_least: int = HIGH_VOLUME
    zone: str = TIME_ZONE


def run_all(
    spark: SparkSession, settings: Settings, source: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Land (if a source is given), clean, gate, load, model and test.

    A failing rule stops the run before the load, and a column that silver lacks ahead of it. The raw table then keeps its last
    state. A load that does not match, and a failing test, stop it before any model is published.
    """
    if source is not None:
        land_window(source, settings.start, settings.end, settings.bronze)
    build_silver(spark, settings.bronze, settings.silver, settings.zone)
    silver = scan_silver(spark, settings.silver)
    enforce(gate(silver))
    load(silver, path=settings.raw)
    raw = scan_raw(spark, path=settings.raw)
    seed = scan_seed(spark, settings.seed)

    def check(models: dict[str, DataFrame]) -> bool:
        enforce_tests(model_tests(models))
        return True

    return build_marts(raw, seed, out=settings.marts, at_least=settings.at_least, check=check)

"""Raw records to one typed row per request."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fairwait.functions.flags import is_inside, is_valid_duration
from fairwait.functions.text import blank_to_null, to_double, to_int
from fairwait.functions.time import elapsed_seconds, seconds_to_hours, wall_clock
from fairwait.operators.versions import latest_version
from fairwait.schemas import SILVER, TIME_ZONE

KEY = ["sr_number"]
LATEST = "last_modified_ts"

# Raw text column, typed column, conversion.
CONVERSIONS = (
    ("created_date", "created_ts", wall_clock),
    ("closed_date", "closed_ts", wall_clock),
    ("last_modified_date", "last_modified_ts", wall_clock),
    ("community_area", "community_area", to_int),
    ("ward", "ward", to_int),
    ("zip_code", "zip_code", blank_to_null),
    ("latitude", "latitude", to_double),
    ("longitude", "longitude", to_double),
)
UNCHANGED = (
    "sr_number",
    "sr_type",
    "sr_short_code",
    "owner_department",
    "status",
    "origin",
    "duplicate",
    "legacy_record",
)
RAW = (*[raw for raw, _, _ in CONVERSIONS], *UNCHANGED)
SEEN = "seen_"  # heads the name of an observed flag per raw column
# Settles versions with the same modification time; all columns, so nothing is left open.
TIES = (
    *[typed for _, typed, _ in CONVERSIONS if typed != LATEST],
    *[name for name in UNCHANGED if name not in KEY],
)


def typed_versions(
    bronze: DataFrame, keep: Sequence[str] = (), rejects: Observation | None = None
) -> DataFrame:
    """Typed columns of every raw version that has a key; ``keep`` passes further columns on.

    ``rejects`` receives the number of raw rows, of rows without a key (broken lines among
    them), per column of the texts that did not convert, and whether a column has any value.
    Counts are taken ahead of the shuffle, so a repeated task may count twice: good for a log
    line, not for a check. Whether there is a value stays true however often it is asked.
    """
    typed = {name: f"_{name}" for _, name, _ in CONVERSIONS}
    parsed = bronze.select(
        "*", *[convert(F.col(raw)).alias(typed[name]) for raw, name, convert in CONVERSIONS]
    )
    if rejects is not None:
        lost = {
            raw: blank_to_null(F.col(raw)).isNotNull() & F.col(typed[name]).isNull()
            for raw, name, convert in CONVERSIONS
            if convert is not blank_to_null
        }
        parsed = parsed.observe(
            rejects,
            F.count(F.lit(1)).alias("bronze_rows"),
            F.count_if(F.col("sr_number").isNull()).alias("rows_without_number"),
            *[F.count_if(condition).alias(f"rejected_{raw}") for raw, condition in lost.items()],
            *[F.bool_or(F.col(raw).isNotNull()).alias(f"{SEEN}{raw}") for raw in RAW],
        )
    return parsed.where(F.col("sr_number").isNotNull()).select(
        *UNCHANGED, *keep, *[F.col(typed[name]).alias(name) for _, name, _ in CONVERSIONS]
    )


def with_outcome(versions: DataFrame, zone: str = TIME_ZONE) -> DataFrame:
    """Durations, flags and calendar columns, in the declared order."""
    seconds = F.col("_seconds")
    created = F.col("created_ts")
    timed = versions.withColumn("_seconds", elapsed_seconds(created, F.col("closed_ts"), zone))
    outcome = {
        "has_valid_resolution": is_valid_duration(seconds),
        "resolution_hours": F.when(seconds >= F.lit(0), seconds_to_hours(seconds)),
        "is_closed": F.col("closed_ts").isNotNull(),
        "has_valid_geo": is_inside(F.col("latitude"), F.col("longitude")),
        "city_flagged_duplicate": F.col("duplicate"),
        "created_date_only": created.cast("date"),
        "created_year": F.year(created),
        "created_month": F.month(created),
    }
    return timed.select(*[outcome.get(c, F.col(c)).alias(c) for c in SILVER.names])


def with_months(versions: DataFrame) -> DataFrame:
    """The partition columns of silver alone, ahead of the shuffle that lays out the files."""
    created = F.col("created_ts")
    return versions.withColumns({"created_year": F.year(created), "created_month": F.month(created)})


def clean(bronze: DataFrame, ties: Sequence[str] = TIES, zone: str = TIME_ZONE) -> DataFrame:
    """One typed row per request number: its latest version, with outcome.

    Text is typed before the shuffle, where it is smaller; what can be derived is
    derived after it.
    """
    return with_outcome(latest_typed(bronze, ties), zone)


def latest_typed(bronze: DataFrame, ties: Sequence[str] = TIES) -> DataFrame:
    """The latest version per request number, typed and without outcome."""
    extra = [c for c in ties if c not in TIES]
    return latest_version(typed_versions(bronze, extra), KEY, LATEST, ties)

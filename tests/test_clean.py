import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from fairwait.functions import text
from fairwait.functions.flags import is_inside, is_real_request
from fairwait.functions.time import STAMP, seconds_to_hours, wall_clock
from fairwait.operators.versions import latest_version, merge_pulls
from fairwait.plans.clean import KEY, LATEST, TIES, clean, typed_versions
from fairwait.schemas import SILVER
from fixtures import SIX, bronze, request


def cleaned(spark, records):
    return {r["sr_number"]: r for r in clean(bronze(spark, records)).collect()}


@pytest.fixture(scope="module")
def six(spark):
    return cleaned(spark, SIX)


def test_columns_and_types(spark):
    df = clean(bronze(spark, SIX))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in SILVER]


def test_golden_rows(six):
    assert len(six) == 5
    expected = {
        "SR24-0001": (72.0, True, True, True, 8, 42, "60601", date(2024, 1, 2)),
        "SR24-0002": (0.0, True, True, True, 76, 41, "60666", date(2024, 1, 1)),
        "SR24-0003": (188.5, True, True, True, 22, 1, "60647", date(2024, 1, 10)),
        "SR24-0004": (None, True, False, True, 5, 47, "60613", date(2024, 1, 15)),
        "SR24-0005": (0.08, True, True, False, None, None, None, date(2024, 1, 20)),
    }
    columns = (
        "resolution_hours", "is_closed", "has_valid_resolution", "has_valid_geo",
        "community_area", "ward", "zip_code", "created_date_only",
    )
    assert {k: tuple(r[c] for c in columns) for k, r in six.items()} == expected


def test_latest_version_wins(six):
    assert six["SR24-0003"]["status"] == "Completed"


@pytest.mark.parametrize("name", ["UTC", "America/Chicago", "Asia/Tokyo"])
def test_result_does_not_depend_on_session_zone(spark, zone, six, name):
    zone(name)
    records = [*SIX, request("late", created_date="2024-01-31T23:30:00.000", closed_date=None)]
    rows = cleaned(spark, records)
    assert {k: rows[k] for k in six} == six
    late = rows["late"]
    assert (late["created_date_only"], late["created_year"], late["created_month"]) == (date(2024, 1, 31), 2024, 1)
    assert late["created_ts"] == datetime(2024, 1, 31, 23, 30)


def test_clock_changes_count_as_elapsed_time(spark):
    rows = cleaned(
        spark,
        [
            request("spring", created_date="2024-03-10T01:30:00.000", closed_date="2024-03-10T03:30:00.000"),
            request("autumn", created_date="2024-11-03T00:30:00.000", closed_date="2024-11-03T02:30:00.000"),
        ],
    )
    assert rows["spring"]["resolution_hours"] == 1.0
    assert rows["autumn"]["resolution_hours"] == 3.0


def test_both_ends_are_cut_to_seconds(spark):
    rows = cleaned(
        spark,
        [request("a", created_date="2024-01-02T08:00:00.900", closed_date="2024-01-02T08:00:18.100")],
    )
    assert rows["a"]["resolution_hours"] == 0.01


def test_malformed_values_become_null(spark):
    rows = cleaned(
        spark,
        [
            request(
                "bad",
                created_date="2024-01-02 08:00",
                closed_date="2024-01-05T08:00:00",
                community_area="abc",
                ward=" 7.0 ",
                latitude="north",
                zip_code="   ",
            )
        ],
    )
    row = rows["bad"]
    assert row["created_ts"] is None and row["closed_ts"] is None
    assert row["is_closed"] is False and row["has_valid_resolution"] is False
    assert row["community_area"] is None and row["ward"] == 7
    assert row["latitude"] is None and row["has_valid_geo"] is False
    assert row["zip_code"] is None and row["created_year"] is None


@pytest.mark.parametrize(
    "raw, parsed",
    [
        ("2024-02-29T23:59:59.999", datetime(2024, 2, 29, 23, 59, 59, 999000)),
        ("2023-02-29T00:00:00.000", None),
        ("2024-01-01T24:00:00.000", None),
        ("2024-01-01T00:00:00.000Z", None),
        (" 2024-01-01T00:00:00.000", None),
        ("2024-01-01", None),
        ("", None),
        (None, None),
    ],
)
def test_wall_clock(spark, raw, parsed):
    df = spark.createDataFrame([(raw,)], "raw string")
    assert df.select(wall_clock(F.col("raw")).alias("ts")).first()["ts"] == parsed


def test_text_conversions(spark):
    values = [" 8 ", "8.7", "-3", "", "abc", "8e1", "99999999999", None]
    df = spark.createDataFrame([(v,) for v in values], "raw string")
    raw = F.col("raw")
    rows = df.select(
        text.to_int(raw).alias("cut"),
        text.to_int_rounded(raw).alias("rounded"),
        text.to_double(raw).alias("number"),
        text.blank_to_null(raw).alias("text"),
    ).collect()
    assert [r["cut"] for r in rows] == [8, 8, -3, None, None, None, None, None]
    assert [r["rounded"] for r in rows] == [8, 9, -3, None, None, 80, None, None]
    assert [r["number"] for r in rows] == [8.0, 8.7, -3.0, None, None, 80.0, 99999999999.0, None]
    assert [r["text"] for r in rows] == ["8", "8.7", "-3", None, "abc", "8e1", "99999999999", None]


def test_hours_equal_decimal_rounding(spark):
    seconds = spark.range(0, 2_000_000, 7)
    wrong = seconds.where(seconds_to_hours(F.col("id")) != F.round(F.col("id") / 3600.0, 2))
    assert wrong.count() == 0


def test_bounds_are_included(spark):
    df = spark.createDataFrame(
        [
            (41.6, -87.95, True),
            (42.1, -87.5, True),
            (41.59, -87.6, False),
            (41.8, -87.49, False),
            (None, -87.6, False),
            (41.8, None, False),
        ],
        "lat double, lon double, expected boolean",
    )
    assert df.where(is_inside(F.col("lat"), F.col("lon")) != F.col("expected")).count() == 0


def test_unknown_type_is_real(spark):
    df = spark.createDataFrame([(None,), ("x INFORMATION Only y",), ("aircraft NOISE",), ("Pothole",)], "kind string")
    flags = [r[0] for r in df.select(is_real_request(F.col("kind"))).collect()]
    assert flags == [True, False, False, True]


def test_missing_key_is_dropped_and_empty_key_is_kept(spark):
    assert set(cleaned(spark, [request(None), request(""), request("a")])) == {"", "a"}


def test_unknown_modification_time_loses(spark):
    rows = cleaned(spark, [request("a", last_modified_date=None, status="Open"), request("a")])
    assert rows["a"]["status"] == "Completed"


def test_ties_do_not_depend_on_input_order(spark):
    records = [
        request("a", closed_date=f"2024-01-0{day}T08:00:00.000", status=status)
        for day in (3, 5, 4)
        for status in ("Open", "Completed")
    ]
    results = set()
    for seed in range(4):
        random.Random(seed).shuffle(records)
        results.add(tuple(cleaned(spark, records)["a"]))
    assert len(results) == 1


def test_cleaning_twice_changes_nothing(spark):
    versions = typed_versions(bronze(spark, SIX))
    once = latest_version(versions, KEY, LATEST, TIES)
    twice = latest_version(once, KEY, LATEST, TIES)
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_pulls_may_overlap_and_lack_columns(spark):
    first = bronze(spark, SIX[:4]).drop("legacy_record")
    second = bronze(spark, SIX[2:])
    merged = merge_pulls([first, second], ["sr_number"], "last_modified_date", ["legacy_record"])
    assert merged.count() == 5
    kept = {r["sr_number"]: r for r in merged.collect()}
    assert kept["SR24-0003"]["status"] == "Completed"
    assert kept["SR24-0004"]["legacy_record"] is False


def test_cleaning_takes_one_shuffle(spark):
    plan = clean(bronze(spark, SIX))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("WindowGroupLimit") == 2


def test_stamp_pattern_is_the_declared_one():
    assert STAMP.count(r"\d") == 7

import random
import statistics
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from fairwait.operators.durations import duration_stats, mean_hours, median_hours, tick
from fairwait.operators.joins import count_by_dimension, fits_broadcast, orphan_count
from fairwait.operators.ranks import with_tile
from fairwait.plans import equity, star
from fairwait.plans.clean import clean
from fixtures import SIX, bronze, census, request


@pytest.fixture(scope="module")
def staged(spark):
    return star.stg_requests(clean(bronze(spark, SIX)))


@pytest.fixture(scope="module")
def areas(spark):
    return star.dim_area(star.stg_census(census(spark)))


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_real_request_flags(staged):
    flags = {r["sr_number"]: r["is_real_service_request"] for r in staged.collect()}
    assert [flags[f"SR24-000{i}"] for i in range(1, 6)] == [True, False, True, True, False]


def test_fact_keeps_every_request(staged):
    fact = star.fct_requests(staged)
    assert fact.count() == 5 and len(fact.columns) == 11


def test_date_dimension(staged):
    days = {str(r["date_day"]): r for r in star.dim_date(staged).collect()}
    assert sorted(days) == ["2024-01-01", "2024-01-02", "2024-01-10", "2024-01-15", "2024-01-20"]
    assert [days[d]["day_of_week"] for d in sorted(days)] == [1, 2, 3, 1, 6]
    assert [d for d in days if days[d]["is_weekend"]] == ["2024-01-20"]
    assert {r["month_name"] for r in days.values()} == {"Jan"}


def test_service_types(spark):
    records = [
        request("a", sr_type=None),
        request("b", sr_short_code="AAA"),
        request("c", sr_short_code="ZZZ", owner_department=None),
    ]
    types = {r["sr_type"]: r for r in star.dim_service_type(star.stg_requests(clean(bronze(spark, records)))).collect()}
    assert set(types) == {None, "Pothole in Street"}
    assert tuple(types["Pothole in Street"])[1:] == ("ZZZ", "Transport", True)


def test_quartiles_of_the_census(areas):
    sizes = {r["income_quartile"]: r["count"] for r in areas.groupBy("income_quartile").count().collect()}
    assert sizes == {1: 20, 2: 19, 3: 19, 4: 19}
    assert areas.where(F.col("community_area").isNull()).count() == 0


@pytest.mark.parametrize("count", [0, 3, 40, 77])
@pytest.mark.parametrize("tiles", [4, 10])
def test_tiles_beyond_one_task_equal_the_window(spark, count, tiles):
    """Half of the rows share one value, some have none."""
    pick = random.Random(count)
    data = [(i, None if i % 11 == 0 else (5 if i % 2 else pick.randrange(9))) for i in range(count)]
    df = spark.createDataFrame(data, "id int, value int").repartition(5)
    small = with_tile(df, tiles, ["value", "id"], "tile")
    large = with_tile(df, tiles, ["value", "id"], "tile", max_rows=0)
    assert sorted(rows(small), key=str) == sorted(rows(large), key=str)
    assert large.schema == small.schema or large.dtypes == small.dtypes


def test_equity_by_quartile(staged, areas):
    assert rows(equity.equity_by_quartile(star.fct_requests(staged), areas)) == [(4, 2, 130.3, 130.3)]


def test_equity_by_type(staged, areas):
    fact = star.fct_requests(staged)
    assert rows(equity.equity_by_type(fact, areas)) == []
    assert rows(equity.equity_by_type(fact, areas, 1)) == [
        ("Pothole in Street", 4, 1, 72.0, 72.0),
        ("Rodent Baiting", 4, 1, 188.5, 188.5),
    ]


def facts_of(spark, records):
    """Facts with area, type and hours; real and valid."""
    df = spark.createDataFrame(records, "community_area int, sr_type string, resolution_hours double")
    return df.select("*", F.lit(True).alias("is_real_service_request"), F.lit(True).alias("has_valid_resolution"))


def test_volume_counts_known_areas_over_all_quartiles(spark, areas):
    full = [(1 + i % 77, "full", 1.0) for i in range(1000)]
    short = [(1 + i % 77, "short", 1.0) for i in range(999)] + [(99, "short", 1.0), (None, "short", 1.0)]
    fact = facts_of(spark, full + short + [(1, None, 1.0)] * 1000)
    volume = {r["sr_type"]: r["request_count"] for r in equity.high_volume_types(fact, areas).collect()}
    assert volume == {"full": 1000, None: 1000}
    assert {r["sr_type"] for r in equity.equity_by_type(fact, areas).collect()} == {"full"}


def test_gap_is_taken_before_rounding(spark, areas):
    low = areas.where("income_quartile = 1").first()["community_area"]
    records = [(low, "t", 71.8), (8, "t", 53.8), (low, "zero", 1.0), (8, "zero", 0.0), (low, "one", 2.0)]
    records += [(low, "down", 1.0), (8, "down", 8.0)]
    gaps = {r["sr_type"]: tuple(r)[1:] for r in equity.equity_gap(facts_of(spark, records), areas, 1).collect()}
    assert gaps["t"] == (71.8, 53.8, 33)
    assert gaps["zero"] == (1.0, 0.0, None)
    assert gaps["one"] == (2.0, None, None)
    assert gaps["down"] == (1.0, 8.0, -88)


def test_statistics_equal_brute_force(spark):
    """Long and short durations, one group with a third of all rows in one value."""
    pick = random.Random(7)
    shapes = {"a": (3, 501), "b": (4000, 800), "c": (90, 1), "d": (50, 2)}
    data = {
        group: [round(pick.expovariate(1 / mean), 2) for _ in range(size)]
        for group, (mean, size) in shapes.items()
    }
    data["a"] += [12.34] * 700
    pairs = [(group, value) for group, values in data.items() for value in values]
    df = spark.createDataFrame([*pairs, ("a", None), ("e", None)], "g string, hours double")
    histogram = df.groupBy("g", tick("hours").alias("tick")).agg(F.count(F.lit(1)).alias("n"))
    stats = duration_stats(histogram, ["g"]).select(
        "g", "request_count", mean_hours().alias("mean"), median_hours().alias("median")
    )
    found = {r["g"]: tuple(r)[1:] for r in stats.collect()}

    def half_up(value):
        return float(value.quantize(Decimal("0.1"), ROUND_HALF_UP))

    for group, values in data.items():
        exact = [Decimal(str(v)) for v in values]
        expected = (len(values) + (group == "a"), half_up(sum(exact) / len(exact)), half_up(statistics.median(exact)))
        assert found[group] == expected
    assert found["e"] == (1, None, None)


def test_statistics_equal_the_built_in_median(spark):
    hours = F.pmod(F.hash("id"), F.lit(5_000_000)) / 100.0
    df = spark.range(20_000).select((F.col("id") % 3).alias("g"), hours.alias("hours"))
    histogram = df.groupBy("g", tick("hours").alias("tick")).agg(F.count(F.lit(1)).alias("n"))
    ours = duration_stats(histogram, ["g"]).select("g", (F.col("median_twice") / 200.0).alias("m"))
    theirs = df.groupBy("g").agg(F.median("hours").alias("m"))
    joined = ours.join(theirs.withColumnRenamed("m", "t"), "g")
    assert joined.count() == 3 and joined.where(F.abs(F.col("m") - F.col("t")) > 1e-9).count() == 0


def test_large_dimension_takes_the_other_way(spark, areas):
    fact = facts_of(spark, [(1 + i % 80, f"t{i % 3}", float(i % 7)) for i in range(500)])
    by = ["sr_type", "income_quartile", "resolution_hours"]
    broadcast = count_by_dimension(fact, areas, "community_area", by)
    shuffled = count_by_dimension(fact, areas, "community_area", by, max_rows=10)
    assert not fits_broadcast(areas, 10) and fits_broadcast(areas, 77)
    assert sorted(rows(broadcast)) == sorted(rows(shuffled))


def test_orphans_ignore_unknown_keys(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (3,)], "k int")
    parent = spark.createDataFrame([(1,), (1,), (None,)], "p int")
    assert orphan_count(child, "k", parent, "p").first()["failures"] == 2
    assert orphan_count(child.limit(0), "k", parent, "p").first()["failures"] == 0

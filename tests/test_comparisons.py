"""Rows that differ between tables, what fields landed records have, and values that break rules."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fairwait.operators import fingerprints, rules
from fairwait.schemas import BRONZE
from fairwait.sources import census
from fairwait.sources.scans import absent_fields
from fixtures import SIX, request, write_records
from workload.queries import REGISTRY

SCHEMA = "k string, p int, v double, w string"


def rows_of(seed, n=400):
    pick = random.Random(seed)
    values = [None, float("nan"), 0.0, 1.5, -2.0]
    return [(f"k{pick.randrange(n // 2)}", pick.choice([None, 1, 2, 3]), pick.choice(values), pick.choice([None, "", "x"])) for _ in range(n)]


def plain_differences(left, right):
    text = lambda rows: Counter(tuple(str(v) if v is not None else None for v in row) for row in rows)
    a, b = text(left), text(right)
    lost, new = Counter(), Counter()
    for row, n in (a - b).items():
        lost[row[0]] += n
    for row, n in (b - a).items():
        new[row[0]] += n
    kind = lambda k: "missing" if not new[k] else "additional" if not lost[k] else "changed"
    return {(k, kind(k), lost[k], new[k]) for k in {*lost, *new}}


@pytest.mark.parametrize("by", [(), ("p",)])
@pytest.mark.parametrize("bits, exact", [(24, 0), (4, 30), (8, 100_000)])
def test_rows_that_differ(spark, by, bits, exact):
    left = rows_of(bits)
    pick = random.Random(9)
    right = [(k, p, v, "changed" if pick.random() < 0.03 else w) for k, p, v, w in left if pick.random() > 0.03]
    right += [("new", 1, None, None), ("new", 1, None, None), left[0], (left[1][0], 7, 0.0, "moved")]
    pick.shuffle(right)
    source, target = spark.createDataFrame(left, SCHEMA).repartition(3), spark.createDataFrame(right, SCHEMA)
    found = fingerprints.differing_rows(source, target.select("w", "v", "p", "k"), ["k"], by, bits, exact)
    assert {tuple(r) for r in found.collect()} == plain_differences(left, right)


def test_differences_everywhere_shuffle_rows_once_and_as_hashes(spark, monkeypatch):
    rows = [(f"k{i}", i % 3, float(i), "x" * (i % 5)) for i in range(4000)]
    source = spark.createDataFrame(rows, SCHEMA)
    target = source.withColumn("w", F.when(F.col("v") % 2 == 0, F.lit("y")).otherwise(F.col("w")))
    steps, one = [], fingerprints.differing_groups
    monkeypatch.setattr(fingerprints, "differing_groups", lambda *given: steps.append(given) or one(*given))
    found = fingerprints.differing_rows(source, target, ["k"], ["p"], bits=4, exact_rows=100)
    assert len(steps) == 2  # months, and a cut that tells no more
    plan = found._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if " Exchange " in line]
    assert plan.count("SortMergeJoin") == 0 and len(shuffles) == 2 and not any("hashpartitioning(w" in line for line in shuffles)
    assert {(r["k"], r["change"], r["source_rows"], r["target_rows"]) for r in found.collect()} == {
        (f"k{i}", "changed", 1, 1) for i in range(0, 4000, 2)
    }


def test_equal_tables_and_a_null_that_moved(spark):
    rows = rows_of(3)
    one = spark.createDataFrame(rows, SCHEMA)
    other = spark.createDataFrame(rows[::-1], SCHEMA).repartition(5)
    assert fingerprints.differing_rows(one, other, ["k"]).count() == 0
    assert fingerprints.differing_partitions(one, other, ["p"]).count() == 0
    empty = one.where("false")
    assert fingerprints.differing_rows(empty, empty, ["k"]).count() == 0
    assert fingerprints.differing_rows(empty, one, ["k"]).where("change <> 'additional'").count() == 0
    pair = lambda a, b: spark.createDataFrame([("k", a, b)], "k string, a string, b string")
    assert fingerprints.differing_rows(pair(None, "x"), pair("x", None), ["k"]).count() == 1
    with pytest.raises(ValueError, match="other columns"):
        fingerprints.differing_rows(one, one.withColumn("p", F.col("p").cast("long")), ["k"])


def test_partitions_that_differ_are_named(spark):
    rows = [("a", 1, 0.0, "x"), ("b", 2, 0.0, "x"), ("c", None, 0.0, "x")]
    one = spark.createDataFrame(rows, SCHEMA)
    other = spark.createDataFrame([rows[0], ("b", 2, 0.0, "y"), ("c", None, 0.0, "x"), ("c", None, 0.0, "x")], SCHEMA)
    found = fingerprints.differing_partitions(one, other, ["p"])
    assert {tuple(r) for r in found.collect()} == {(2, 1, 1), (None, 1, 2)}


def without(name, new=None, **more):
    return [{(new if k == name and new else k): v for k, v in {**r, **more}.items() if k != name or new} for r in SIX]


def test_fields_by_pull(spark, tmp_path):
    pulls = {
        "a": SIX,
        "b": without("ward"),
        "c": without("latitude", "lat"),
        "d": [{**r, "zip_code": 60601, "note": "has \"status\": inside", "deep": {"ward": 1}} for r in without("status")],
        "e": [{**r, "origin": None, "deep": {"ward": 2}, "note": "x"} for r in SIX],
    }
    for name, records in pulls.items():
        write_records(tmp_path / "b" / name / "x.ndjson", records)
    with (tmp_path / "b" / "a" / "x.ndjson").open("a") as file:
        file.write('no json\n[1, 2]\n"text"\n')
    found = {tuple(r) for r in census.field_census(spark, str(tmp_path / "b")).collect()}
    n = len(SIX)
    assert found == {
        ("a", None, "broken", None, None, 3),
        ("b", "ward", "absent", None, "STRING", n),
        ("c", "lat", "renamed", "STRING", "latitude", n),
        ("d", "zip_code", "retyped", "BIGINT", "STRING", n),
        ("d", "note", "additional", "STRING", None, n),  # of its kind, two are gone
        ("d", "deep", "additional", "OBJECT<ward: BIGINT>", None, n),
        ("d", "lat", "absent", None, "STRING", n),
        ("d", "status", "absent", None, "STRING", n),
    }


def test_a_name_in_a_value_is_no_field(spark, tmp_path):
    records = [{"sr_number": "A", "note": 'say "ward": 3', "deep": {"status": "x"}, "zip_code": None}]
    path = write_records(tmp_path / "b" / "x.ndjson", records)
    assert absent_fields(spark, path, ["sr_number", "ward", "status", "zip_code"]) == ["ward", "status"]


def test_names_with_signs(spark):
    assert census.fields_of("OBJECT<`a,b`: ARRAY<OBJECT<c: BIGINT, d: STRING>>, `x``y>`: DECIMAL(10,2), z: VOID>") == {
        "a,b": "ARRAY<OBJECT<c: BIGINT, d: STRING>>", "x`y>": "DECIMAL(10,2)", "z": "VOID",
    }
    assert census.fields_of("OBJECT<>") == census.fields_of("VOID") == census.fields_of(None) == {}


def test_no_pulls_no_findings(spark, tmp_path):
    (tmp_path / "b").mkdir()
    assert census.field_census(spark, str(tmp_path / "b")).count() == 0
    write_records(tmp_path / "b" / "w" / "x.ndjson", [request("A")])
    assert census.field_census(spark, str(tmp_path / "b"), BRONZE).count() == 0


def test_values_that_break_rules(spark):
    rows = [(1, "a"), (1, "b"), (2, "b"), (9, None), (9, "b"), (None, "c"), (8, "a"), (9, "b")]
    suite = (
        rules.between("n", 0, 5), rules.in_set("s", ("a",)), rules.not_null("n"), rules.unique("n", "s"), rules.between("n", 0, 100),
    )
    found = rules.unexpected_values(spark.createDataFrame(rows, "n int, s string"), suite, 2)
    assert {tuple(r) for r in found.collect()} == {
        ("between", "n", 1, "9", 3), ("between", "n", 2, "8", 1), ("in_set", "s", 1, "b", 4), ("in_set", "s", 2, "c", 1),
        ("not_null", "n", 1, None, 1), ("unique", "n,s", 1, "9,b", 2),
    }


def test_versions_are_typed_once_for_both_sides(spark):
    found = REGISTRY["reconcile_partitions"](spark, "/root/testdata/sf0.001")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Window") > 0

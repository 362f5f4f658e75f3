import pytest
from pyspark.sql import functions as F

from fairwait.operators.rules import (
    GateFailed,
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
    verdict,
)
from fairwait.plans.clean import clean
from fairwait.plans.jobs import SILVER_RULES, gate
from fixtures import SIX, bronze, request


def outcome(df, *rules):
    return {
        (r["rule"], r["column"]): (r["element_count"], r["unexpected_count"], r["success"])
        for r in report(df, rules).collect()
    }


@pytest.fixture(scope="module")
def values(spark):
    return spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "a"), (9, "a")], "n int, s string")


def test_rules_count_rows(values):
    found = outcome(values, not_null("n"), unique("n"), unique("n", "s"), between("n", 1, 5), in_set("s", ["a"]))
    assert found == {
        ("not_null", "n"): (5, 1, False),
        ("unique", "n"): (5, 2, False),
        ("unique", "n,s"): (5, 0, True),
        ("between", "n"): (5, 1, False),
        ("in_set", "s"): (5, 1, False),
    }
    assert outcome(values, between("n", high=1)) == {("between", "n"): (5, 2, False)}


@pytest.mark.parametrize("mostly, passes", [(0.75, True), (0.76, False), (0.0, True)])
def test_mostly_looks_at_known_values(values, mostly, passes):
    assert outcome(values, between("n", 1, 5, mostly=mostly))[("between", "n")][2] is passes


def test_empty_table_passes(values):
    empty = values.limit(0)
    found = outcome(empty, not_null("n"), unique("n"), between("n", 1, 5), in_set("s", ["a"]))
    assert all(result == (0, 0, True) for result in found.values())
    assert verdict(report(empty, [not_null("n")])).first()["passed"] is True


def test_warnings_do_not_fail_the_verdict(values):
    assert tuple(verdict(report(values, [not_null("n", severity="warn"), unique("n", "s")])).first()) == (2, 1, True)
    assert tuple(verdict(report(values, [not_null("n"), unique("n", "s")])).first()) == (2, 1, False)


def test_clean_fixture_passes_the_gate(spark):
    results = gate(clean(bronze(spark, SIX)))
    assert results.count() == len(SILVER_RULES) == 10
    assert results.where(~F.col("success")).count() == 0
    enforce(results)


@pytest.mark.parametrize(
    "bad, rule",
    [
        ({"community_area": "99"}, "between(community_area)"),
        ({"latitude": "41.59"}, "between(latitude)"),
        ({"longitude": "-87.49"}, "between(longitude)"),
        ({"status": None}, "not_null(status)"),
    ],
)
def test_one_bad_row_stops_the_gate(spark, bad, rule):
    cleaned = clean(bronze(spark, [*SIX, request("bad", **bad)]))
    with pytest.raises(GateFailed) as failure:
        enforce(gate(cleaned))
    assert str(failure.value) == f"{rule}: 1 rows"


def test_repeated_number_stops_the_gate(spark):
    cleaned = clean(bronze(spark, SIX))
    with pytest.raises(GateFailed, match=r"unique\(sr_number\): 10 rows"):
        enforce(gate(cleaned.union(cleaned)))


def test_model_tests(spark):
    models = {
        "child": spark.createDataFrame([(1, 1), (1, 2), (2, 7), (None, None)], "id int, ref int"),
        "parent": spark.createDataFrame([(1,), (2,)], "id int"),
    }
    tests = [
        KeyTest("child", "id"),
        KeyTest("parent", "id"),
        RelationTest("child", "ref", "parent", "id", "warn"),
        RelationTest("child", "id", "parent", "id"),
    ]
    results = run_model_tests(models, tests)
    found = {(r["model"], r["test"], r["column"]): (r["failures"], r["status"]) for r in results.collect()}
    assert found == {
        ("child", "unique", "id"): (1, "fail"),
        ("child", "not_null", "id"): (1, "fail"),
        ("parent", "unique", "id"): (0, "pass"),
        ("parent", "not_null", "id"): (0, "pass"),
        ("child", "relationships", "ref"): (1, "warn"),
        ("child", "relationships", "id"): (0, "pass"),
    }
    with pytest.raises(GateFailed):
        enforce_tests(results)
    enforce_tests(run_model_tests(models, tests[1:]))

"""Declarative data-quality rules that run as aggregations and report one row per rule."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairwait.operators.joins import orphan_count


@dataclass(frozen=True)
class Rule:
    """``columns`` must pass ``kind``; a share of at least ``mostly`` of the judged rows is enough."""

    kind: str
    columns: tuple[str, ...]
    low: float | None = None
    high: float | None = None
    allowed: tuple = ()
    mostly: float = 1.0
    severity: str = "error"

    @property
    def label(self) -> str:
        return ",".join(self.columns)

    def judged(self) -> Column:
        """Rows the rule looks at: only ``not_null`` looks at unknown values."""
        if self.kind == "not_null":
            return F.lit(True)
        return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in self.columns])

    def broken(self) -> Column:
        col = F.col(self.columns[0])
        if self.kind == "not_null":
            return col.isNull()
        if self.kind == "in_set":
            return ~col.isin(*self.allowed)
        below = col < F.lit(self.low) if self.low is not None else F.lit(False)
        above = col > F.lit(self.high) if self.high is not None else F.lit(False)
        return below | above


def not_null(column: str, **options) -> Rule:
    return Rule("not_null", (column,), **options)


def between(column: str, low=None, high=None, **options) -> Rule:
    """Bounds are included; leave one out for an open end."""
    return Rule("between", (column,), low=low, high=high, **options)


def in_set(column: str, allowed: Sequence, **options) -> Rule:
    return Rule("in_set", (column,), allowed=tuple(allowed), **options)


def unique(*columns: str, **options) -> Rule:
    """Every row of a repeated value breaks the rule."""
    return Rule("unique", columns, **options)


def _result(rule: Rule, total: Column, judged: Column, bad: Column) -> Column:
    share = (judged - bad) / F.nullif(judged, F.lit(0))
    passed = (judged == F.lit(0)) | (share >= F.lit(rule.mostly))
    return F.struct(
        F.lit(rule.kind).alias("rule"),
        F.lit(rule.label).alias("column"),
        total.alias("element_count"),
        bad.alias("unexpected_count"),
        passed.alias("success"),
        F.lit(rule.severity).alias("severity"),
    )


def _one_pass(df: DataFrame, rules: Sequence[Rule], key: Rule | None = None) -> DataFrame:
    """All rules that judge a row by itself and, with ``key``, one ``unique`` rule, in one scan.

    With ``key`` every count is formed per key ahead of the only shuffle, so a hot key travels as
    one row per task, and the counts per key are then summed.
    """
    counts = [F.count(F.lit(1)).alias("__total")]
    for i, rule in enumerate(rules):
        if rule.kind != "not_null":
            counts.append(F.count_if(rule.judged()).alias(f"__judged{i}"))
        counts.append(F.count_if(rule.broken()).alias(f"__bad{i}"))
    if key is None:
        totals = df.agg(*counts)
    else:
        n = F.col("__total")
        groups = df.groupBy(*key.columns).agg(*counts)
        names = [c for c in groups.columns if c not in key.columns]
        totals = groups.agg(
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names],
            F.coalesce(F.sum(F.when(key.judged(), n)), F.lit(0)).alias("__judged_key"),
            F.coalesce(F.sum(F.when(key.judged() & (n > 1), n)), F.lit(0)).alias("__bad_key"),
        )
    total = F.col("__total")
    results = [
        _result(
            rule, total, total if rule.kind == "not_null" else F.col(f"__judged{i}"), F.col(f"__bad{i}")
        )
        for i, rule in enumerate(rules)
    ]
    if key is not None:
        results.append(_result(key, total, F.col("__judged_key"), F.col("__bad_key")))
    return totals.select(F.inline(F.array(*results)))


def report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``rule, column, element_count, unexpected_count, success, severity`` per rule.

    An empty table passes every rule. Row rules are counted along with the first ``unique`` rule;
    each further ``unique`` rule is a scan and a shuffle of its own.
    """
    by_row = [rule for rule in rules if rule.kind != "unique"]
    keys = [rule for rule in rules if rule.kind == "unique"]
    parts = [_one_pass(df, by_row, keys[0] if keys else None)]
    parts += [_one_pass(df, (), key) for key in keys[1:]]
    return reduce(DataFrame.unionByName, parts)


def unexpected_values(df: DataFrame, rules: Sequence[Rule], most: int = 5) -> DataFrame:
    """``rule, column, position, value, n``: the ``most`` frequent values that break each rule, ties by value.

    Row rules share one scan; what they find wrong is counted per value ahead of the shuffle, so a frequent value is one row per
    task and the shuffle carries unexpected values only. For ``unique`` the values are repeated keys, by a scan of its own. Values are
    text; NULL is a value of its own, and columns of one key are joined by commas.
    """
    by_row = [(i, rule) for i, rule in enumerate(rules) if rule.kind != "unique"]
    found = []
    if by_row:
        wrong = [
            F.when(rule.judged() & rule.broken(), F.struct(F.lit(i).alias("_rule"), F.col(rule.columns[0]).cast("string").alias("value")))
            for i, rule in by_row
        ]
        values = df.select(F.inline(F.filter(F.array(*wrong), lambda w: w.isNotNull())))
        found.append(values.groupBy("_rule", "value").agg(F.count(F.lit(1)).alias("n")))
    for i, rule in enumerate(rules):
        if rule.kind == "unique":
            counts = df.where(rule.judged()).groupBy(*rule.columns).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
            value = F.concat_ws(",", *[F.col(c).cast("string") for c in rule.columns])
            found.append(counts.select(F.lit(i).alias("_rule"), value.alias("value"), F.col("_n").alias("n")))
    order = Window.partitionBy("_rule").orderBy(F.col("n").desc(), F.col("value").asc_nulls_first())
    ranked = reduce(DataFrame.unionByName, found).withColumn("position", F.row_number().over(order))
    named = lambda f: F.element_at(F.array(*[F.lit(f(rule)) for rule in rules]), F.col("_rule") + 1)
    return ranked.where(F.col("position") <= most).select(
        named(lambda r: r.kind).alias("rule"), named(lambda r: r.label).alias("column"), "position", "value", "n"
    )


def verdict(results: DataFrame) -> DataFrame:
    """One row: number of rules, of failed rules, and whether no failed rule is an error."""
    failed = ~F.col("success")
    return results.agg(
        F.count(F.lit(1)).alias("rules"),
        F.count_if(failed).alias("failed"),
        (F.count_if(failed & (F.col("severity") == "error")) == 0).alias("passed"),
    )


class GateFailed(Exception):
    """Raised when a rule of severity ``error`` does not hold."""


def enforce(results: DataFrame) -> None:
    """Stop with ``GateFailed`` unless the report passes. Collects one row per failed rule."""
    failed = results.where(~F.col("success") & (F.col("severity") == "error")).collect()
    if failed:
        lines = [f"{r['rule']}({r['column']}): {r['unexpected_count']} rows" for r in failed]
        raise GateFailed("; ".join(lines))


@dataclass(frozen=True)
class KeyTest:
    """``column`` of ``model`` must be unique and not NULL."""

    model: str
    column: str


@dataclass(frozen=True)
class RelationTest:
    """Every known ``column`` of ``model`` must occur as ``field`` of ``parent``."""

    model: str
    column: str
    parent: str
    field: str
    severity: str = "error"


def _tested(model: str, test: str, column: str, failures: Column, severity: str) -> Column:
    status = F.when(failures == 0, F.lit("pass")).otherwise(
        F.lit("warn" if severity == "warn" else "fail")
    )
    return F.struct(
        F.lit(model).alias("model"),
        F.lit(test).alias("test"),
        F.lit(column).alias("column"),
        failures.alias("failures"),
        F.lit(severity).alias("severity"),
        status.alias("status"),
    )


def _key_test(df: DataFrame, test: KeyTest) -> DataFrame:
    groups = df.groupBy(test.column).agg(F.count(F.lit(1)).alias("_n"))
    known = F.col(test.column).isNotNull()
    counts = groups.agg(
        F.count_if(known & (F.col("_n") > 1)).alias("repeated"),
        F.coalesce(F.sum(F.when(~known, F.col("_n"))), F.lit(0)).alias("missing"),
    )
    rows = [
        _tested(test.model, "unique", test.column, F.col("repeated"), "error"),
        _tested(test.model, "not_null", test.column, F.col("missing"), "error"),
    ]
    return counts.select(F.inline(F.array(*rows)))


def _relation_test(models: dict[str, DataFrame], test: RelationTest) -> DataFrame:
    counts = orphan_count(models[test.model], test.column, models[test.parent], test.field)
    row = _tested(test.model, "relationships", test.column, F.col("failures"), test.severity)
    return counts.select(F.inline(F.array(row)))


def run_model_tests(
    models: dict[str, DataFrame], tests: Sequence[KeyTest | RelationTest]
) -> DataFrame:
    """``model, test, column, failures, severity, status`` per test.

    ``unique`` counts repeated values, ``not_null`` and ``relationships`` count rows.
    """
    parts = [
        _key_test(models[t.model], t) if isinstance(t, KeyTest) else _relation_test(models, t)
        for t in tests
    ]
    return reduce(DataFrame.unionByName, parts)


def enforce_tests(results: DataFrame) -> None:
    """Stop with ``GateFailed`` when a model test fails; a warning does not stop."""
    failed = results.where(F.col("status") == "fail").collect()
    if failed:
        lines = [f"{r['test']}({r['model']}.{r['column']}): {r['failures']}" for r in failed]
        raise GateFailed("; ".join(lines))

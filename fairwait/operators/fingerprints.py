"""Which rows differ between two tables: multiset fingerprints, then halving of hash ranges down to the keys.

The fingerprint of a set of rows is the sum of two 64-bit hashes of each row, 128 bits that neither depend on the order of
rows nor lose repeated ones. Rows of the second table count negative, so equal sets sum to zero and a single
aggregation compares both tables. Only groups that do not are looked at again, cut finer by a hash of the
key, until so few rows are left that they can be compared whole, or until cutting tells no more apart: where differences are
everywhere, rows meet by key as their two hashes, in the only shuffle of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairwait.operators.joins import fits_broadcast
from fairwait.session import shared_path

BITS = 8  # each step cuts a group that differs in 2^8
MOST_BITS = 48
EXACT_ROWS = 100_000  # in groups that differ; not more are compared column by column while they can be cut finer


def row_hash(columns: Sequence[str], seed: int) -> Column:
    """Hash of a row; NULL is a value of its own in every column."""
    parts = [part for c in columns for part in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.xxhash64(F.lit(seed), *parts)


def signed(source: DataFrame, target: DataFrame) -> DataFrame:
    """Rows of both with ``_sign`` 1 and -1. Both have the same columns, in any order, of the same types."""
    kinds = [{f.name: f.dataType for f in side.schema} for side in (source, target)]
    if kinds[0] != kinds[1]:
        raise ValueError(f"other columns or types: {sorted(kinds[0].items() ^ kinds[1].items(), key=str)}")
    sides = [side.select(*[F.col(f"`{c}`") for c in source.columns], F.lit(n).alias("_sign")) for side, n in ((source, 1), (target, -1))]
    return sides[0].unionAll(sides[1])


def differing_groups(rows: DataFrame, columns: Sequence[str], groups: dict[str, Column]) -> DataFrame:
    """Groups of signed ``rows`` whose fingerprints differ, with the number of their rows on both sides.

    Sums are aggregated before the shuffle, so a group is one row per task.
    """
    sums = [F.sum(row_hash(columns, seed).cast("decimal(20,0)") * F.col("_sign")).alias(f"_sum{seed}") for seed in (1, 2)]
    found = rows.groupBy(*[c.alias(name) for name, c in groups.items()]).agg(
        F.count_if(F.col("_sign") > 0).alias("source_rows"), F.count_if(F.col("_sign") < 0).alias("target_rows"), *sums
    )
    differ = (F.col("source_rows") != F.col("target_rows")) | (F.col("_sum1") != 0) | (F.col("_sum2") != 0)
    return found.where(differ).drop("_sum1", "_sum2")


def differing_partitions(source: DataFrame, target: DataFrame, by: Sequence[str]) -> DataFrame:
    """Values of ``by`` whose rows differ, with both numbers of rows. One pass over each table."""
    return differing_groups(signed(source, target), source.columns, {c: F.col(f"`{c}`") for c in by})


def differing_rows(
    source: DataFrame,
    target: DataFrame,
    key: Sequence[str],
    by: Sequence[str] = (),
    bits: int = BITS,
    exact_rows: int = EXACT_ROWS,
) -> DataFrame:
    """``key``, ``change``, ``source_rows`` and ``target_rows`` of keys whose rows differ: ``missing`` from the target,
    ``additional`` in it, or ``changed``. The numbers count the rows of the key that the other side lacks.

    ``by`` are columns to compare by first, such as those a table is partitioned by: later steps read differing ones alone. A key that moved
    from one partition to another differs in both, and is a changed one. Repeated rows count as often as they occur.
    Each step is one pass over what still differs, and shuffles one row per task and group. Steps end as soon as a cut leaves
    more than half of the rows in groups that differ, or finds more groups than can be broadcast; so no step shuffles
    rows, and what is left is counted by key and both hashes of a row.
    """
    spark, columns = source.sparkSession, source.columns
    rows = signed(source, target)
    base = {f"_by{i}": F.col(f"`{c}`") for i, c in enumerate(by)}
    cut = F.xxhash64(F.lit(3), *[F.col(f"`{c}`") for c in key])
    depth, groups, before = 0, base, None
    left = rows
    while True:
        path = shared_path(spark, "differences")
        differing_groups(left, columns, groups).write.parquet(path)
        found = spark.read.parquet(path)
        n = found.agg(F.sum(F.col("source_rows") + F.col("target_rows"))).first()[0] or 0
        names = list(groups)
        labels = found.select(*names)
        if names and not fits_broadcast(labels):
            break
        if names:
            tagged, side = left.withColumns(groups), F.broadcast(labels)
            same = [tagged[name].eqNullSafe(side[name]) for name in names]
            left = tagged.join(side, same, "left_semi").drop(*names)
        if n <= exact_rows or depth >= MOST_BITS or depth and 2 * n > before:
            break
        depth, before = depth + bits, n
        groups = {**base, "_cut": F.shiftrightunsigned(cut, 64 - depth)}
    by_key, told_by = [F.col(f"`{c}`") for c in key], [F.col(f"`{c}`") for c in columns]
    if n > exact_rows:
        told_by = [*by_key, F.col("_row1"), F.col("_row2")]
        left = left.select(*by_key, *[row_hash(columns, seed).alias(f"_row{seed}") for seed in (1, 2)], "_sign")
    whole = left.groupBy(*told_by).agg(F.sum("_sign").alias("_sign")).where("_sign <> 0")
    keys = whole.groupBy(*by_key).agg(
        F.sum(F.greatest("_sign", F.lit(0))).alias("source_rows"), F.sum(F.greatest(-F.col("_sign"), F.lit(0))).alias("target_rows")
    )
    change = F.when(F.col("target_rows") == 0, "missing").when(F.col("source_rows") == 0, "additional").otherwise("changed")
    return keys.select(*by_key, change.alias("change"), "source_rows", "target_rows")

"""Latest version per key, over any number of overlapping pulls."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def newest_first(key: Sequence[str], latest: str, ties: Sequence[str] = ()) -> WindowSpec:
    """Versions per ``key``: the greatest ``latest`` first, unknown values last, then by ``ties`` alike."""
    return Window.partitionBy(*key).orderBy(*[F.col(name).desc_nulls_last() for name in (latest, *ties)])


def latest_version(
    df: DataFrame, key: Sequence[str], latest: str, ties: Sequence[str] = ()
) -> DataFrame:
    """One row per ``key``: the greatest ``latest``, unknown values last.

    ``ties`` settle equal values, greatest first. With every remaining column named
    there, the result does not depend on the order of the input.

    Each task keeps only its own best row per key before the shuffle, so a key that
    holds a large share of all rows arrives as one row per task.
    """
    ranked = df.select("*", F.row_number().over(newest_first(key, latest, ties)).alias("_version"))
    return ranked.where(F.col("_version") == 1).drop("_version")


def merge_pulls(
    pulls: Sequence[DataFrame], key: Sequence[str], latest: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Union of pulls that may overlap and may lack columns, reduced to the latest versions."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pulls)
    return latest_version(stacked, key, latest, ties)

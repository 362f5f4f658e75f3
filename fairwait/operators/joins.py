"""Joins to a dimension whose size is checked first, and referential checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Both bounds hold for a broadcast side: its rows, and the bytes of its values as text.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 16 << 20


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes; reads no more than one
    row beyond."""
    width = F.octet_length(F.to_json(F.struct("*")))
    size = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("bytes")).first()
    return size["n"] <= max_rows and (size["bytes"] or 0) <= max_bytes


def count_by_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    on: str,
    by: list[str],
    max_rows: int = BROADCAST_ROWS,
    weight: str | None = None,
) -> DataFrame:
    """Rows of ``facts`` per ``by`` columns, which may come from either side of the join; or the sums of ``weight``, where
    facts are counted already.

    Facts without a match drop out. A dimension within ``max_rows`` and ``BROADCAST_BYTES`` is broadcast, and
    the facts are counted before their only shuffle. A larger one is joined to facts
    that are already counted per join key, so a hot key meets it as few rows.
    """
    n = (F.count(F.lit(1)) if weight is None else F.sum(weight)).alias("n")
    labels = dimension.select(on, *[c for c in by if c in dimension.columns and c != on])
    if fits_broadcast(labels, max_rows):
        joined = facts.join(F.broadcast(labels), on)
        return joined.groupBy(*by).agg(n)
    own = [c for c in by if c not in labels.columns]
    counted = facts.groupBy(on, *own).agg(n)
    return counted.join(labels, on).groupBy(*by).agg(F.sum("n").alias("n"))


def orphan_count(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """One row: how many ``child`` rows have a key that ``parent`` lacks. NULL keys are fine.

    Both sides are reduced to distinct keys before they meet.
    """
    known = parent.select(F.col(parent_key).alias("_key")).distinct()
    used = (
        child.select(F.col(child_key).alias("_key"))
        .where(F.col("_key").isNotNull())
        .groupBy("_key")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    lost = used.join(known, "_key", "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures"))

"""Equal-sized tiles over a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairwait.session import shared_root

# Up to here one task ranks the table, which is what an unpartitioned window does.
WINDOW_ROWS = 100_000


def with_tile(
    df: DataFrame, tiles: int, order: Sequence[str], name: str, max_rows: int = WINDOW_ROWS
) -> DataFrame:
    """``ntile(tiles)`` in ascending ``order``, unknown values last.

    ``order`` should end in a unique column; it decides ties and keeps equal values
    from gathering in one partition. The input is checkpointed, because it is both
    counted and ranked.
    """
    shared_root(df.sparkSession)
    pinned = df.checkpoint()
    rows = pinned.count()
    ascending = [F.col(c).asc_nulls_last() for c in order]
    if rows <= max_rows:
        return pinned.select("*", F.ntile(tiles).over(Window.orderBy(*ascending)).alias(name))
    placed = with_position(pinned.orderBy(*ascending))
    return placed.select(*df.columns, _tile_of(F.col("_position"), rows, tiles).alias(name))


def with_position(ordered: DataFrame) -> DataFrame:
    """Add ``_position``, counted from 0, to a globally sorted frame.

    The generated id holds the partition in its upper bits and the place within the
    partition in the lower 33. It is checkpointed, so that both uses see the same
    partition bounds even after an executor is lost.
    """
    tagged = ordered.select("*", F.monotonically_increasing_id().alias("_id")).checkpoint()
    part = F.shiftright("_id", 33)
    sizes = tagged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the sort: small by construction.
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start")
    )
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        tagged.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn("_position", F.col("_start") + place)
    )


def _tile_of(position: Column, rows: int, tiles: int) -> Column:
    """Tile of a position; the first ``rows % tiles`` tiles hold one row more."""
    size, extra = divmod(rows, tiles)
    longer = extra * (size + 1)
    head = F.floor(position / F.lit(size + 1)) + F.lit(1)
    if size == 0:
        return head.cast("int")
    tail = F.floor((position - F.lit(longer)) / F.lit(size)) + F.lit(extra + 1)
    return F.when(position < F.lit(longer), head).otherwise(tail).cast("int")

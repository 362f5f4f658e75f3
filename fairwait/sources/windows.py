"""Time-window extracts and ordered pages of a source."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def incremental_window(as_of: date, days: int) -> tuple[str, str]:
    """Start and end (excluded) of the last ``days`` days and ``as_of`` itself."""
    return (as_of - timedelta(days=days)).isoformat(), (as_of + timedelta(days=1)).isoformat()


def window_extract(df: DataFrame, on: str, start: str, end: str) -> DataFrame:
    """Rows with ``start <= on < end`` for ISO dates; ``on`` is a timestamp or its ISO text.

    The comparison is left to literals of the column's own type, so it reaches the scan.
    """
    low, high = F.lit(f"{start}T00:00:00"), F.lit(f"{end}T00:00:00")
    kind = df.schema[on].dataType
    if kind.typeName() != "string":
        low, high = low.cast(kind), high.cast(kind)
    return df.where((F.col(on) >= low) & (F.col(on) < high))


def incremental_extract(df: DataFrame, on: str, as_of: date, days: int) -> DataFrame:
    return window_extract(df, on, *incremental_window(as_of, days))


def ordered_page(df: DataFrame, order: Sequence[str], offset: int, size: int) -> DataFrame:
    """Rows ``offset`` to ``offset + size`` in ``order``, which should end in a unique column.

    Each task keeps ``offset + size`` rows at most; for pages far into a source use
    ``page_after``. To extract a whole window, filter it: pages are not needed.
    """
    return df.orderBy(*_ascending(order)).offset(offset).limit(size)


def page_after(df: DataFrame, order: Sequence[str], last: Sequence | None, size: int) -> DataFrame:
    """The ``size`` rows that follow the row with ``order`` values ``last``; from the top if None.

    The order columns must not be NULL. A short page is the final one.
    """
    rows = df if last is None else df.where(_beyond(df, order, last))
    return rows.orderBy(*_ascending(order)).limit(size)


def _ascending(order: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order]


def _beyond(df: DataFrame, order: Sequence[str], last: Sequence) -> Column:
    """Row comparison ``order > last``; the leading column alone bounds the scan.

    Times pass as text, so that a zone-less one does not take on the session's zone.
    """
    values = [
        F.lit(str(v) if isinstance(v, date) else v).cast(df.schema[c].dataType)
        for c, v in zip(order, last)
    ]
    cases = []
    for i, name in enumerate(order):
        equal = [F.col(c) == v for c, v in zip(order[:i], values)]
        cases.append(reduce(lambda a, b: a & b, [*equal, F.col(name) > values[i]]))
    beyond = reduce(lambda a, b: a | b, cases)
    return (F.col(order[0]) >= values[0]) & beyond

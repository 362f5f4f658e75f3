"""Lenient conversion of text columns: what does not parse is NULL, never an error.

Shapes are tested before a cast where bad text is common, as a failing ``try_cast``
costs many times a successful one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)\s*$"
_WHOLE = r"^\s*([+-]?\d*)"


def blank_to_null(col: Column) -> Column:
    """Text without outer spaces; NULL when nothing is left."""
    return F.nullif(F.trim(col), F.lit(""))


def to_int(col: Column) -> Column:
    """Integer of a text with any white space around it. A fraction is cut off, so ``'8.7'`` is 8
    and ``'.5'`` is 0."""
    whole = F.regexp_extract(col, _WHOLE, 1)
    whole = F.when(whole.isin("", "+", "-"), F.lit(0)).otherwise(whole.try_cast("int"))
    return F.when(col.rlike(_NUMBER), whole)


def to_double(col: Column) -> Column:
    text = F.trim(col)
    return F.when(text != F.lit(""), text.try_cast("double"))


def to_int_rounded(col: Column) -> Column:
    """Integer of a text as warehouses cast it: a fraction is rounded, so ``'8.7'`` is 9."""
    rounded = F.round(col.try_cast("decimal(20,4)"))
    return F.coalesce(col.try_cast("int"), rounded.try_cast("int"))

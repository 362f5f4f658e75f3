"""Flags of a request. None of them is ever NULL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from fairwait.schemas import LATITUDE_BOUNDS, LONGITUDE_BOUNDS, NOT_A_SERVICE


def is_valid_duration(seconds: Column) -> Column:
    """Both ends known and not reversed; zero seconds are valid."""
    return F.coalesce(seconds >= F.lit(0), F.lit(False))


def is_inside(
    latitude: Column,
    longitude: Column,
    lat: tuple[float, float] = LATITUDE_BOUNDS,
    lon: tuple[float, float] = LONGITUDE_BOUNDS,
) -> Column:
    """Inside the box, bounds included; an unknown coordinate is outside."""
    inside = latitude.between(*map(F.lit, lat)) & longitude.between(*map(F.lit, lon))
    return F.ifnull(inside, F.lit(False))


def is_real_request(kind: Column, excluded: tuple[str, ...] = NOT_A_SERVICE) -> Column:
    """False for types that match an excluded pattern in any case; an unknown type is real."""
    matches = reduce(lambda a, b: a | b, [kind.ilike(pattern) for pattern in excluded])
    return ~F.coalesce(matches, F.lit(False))

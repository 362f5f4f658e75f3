"""Spans of a text as columns: counts, the listing and its digest."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN_TYPE = "array<struct<kind:string,start:bigint,end:bigint>>"
SPAN_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def listing(spans: Column) -> Column:
    """kind:start:end, comma-joined; ``spans`` are in the order to be listed."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def of_kinds(spans: Column, kinds) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def span_columns(spans: Column, base_kinds) -> list[Column]:
    """A count per base kind, the digest of the base spans, and the listing of all."""
    counts = [
        F.size(of_kinds(spans, [k])).cast("long").alias(f"n_{k}") for k in base_kinds
    ]
    digest = F.sha2(listing(of_kinds(spans, base_kinds)), 256).alias("base_sha256")
    return [*counts, digest, listing(spans).alias("spans")]


def to_code_points(data: bytes, found: list[tuple]) -> list[tuple]:
    """(kind, start, end) in bytes of UTF-8 to the same in code points."""
    marks, at, points = {}, 0, 0
    for place in sorted({p for _, *ends in found for p in ends}):
        points += len(data[at:place].decode("utf-8", "surrogatepass"))
        at = place
        marks[place] = points
    return [(kind, marks[start], marks[end]) for kind, start, end in found]

"""Compare a Spark result with DuckDB: names, kinds of type, and all rows regardless of order."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def _rows(names, records) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(
        tuple(None if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in order)
        for r in records
    )


def differences(df, con, sql: str) -> list[str]:
    relation = con.sql(sql)
    names, types = relation.columns, [str(t) for t in relation.types]
    want = dict(zip(names, types))
    got = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    found = [f"columns {got} != {want}"] if got != want else []
    left, right = _rows(df.columns, [tuple(r) for r in df.collect()]), _rows(names, relation.fetchall())
    if left.total() != right.total():
        found.append(f"rows {left.total()} != {right.total()}")
    if left != right:
        found.append(f"only Spark {list((left - right).items())[:3]}, only SQL {list((right - left).items())[:3]}")
    return found

"""Small raw records and a census, one row per case that matters."""

from __future__ import annotations

import json
from pathlib import Path

from fairwait.schemas import BRONZE, CENSUS

DEFAULTS = {
    "sr_type": "Pothole in Street",
    "sr_short_code": "POT",
    "owner_department": "Transport",
    "status": "Completed",
    "origin": "Internet",
    "created_date": "2024-01-02T08:00:00.000",
    "last_modified_date": "2024-01-05T10:00:00.000",
    "closed_date": "2024-01-05T08:00:00.000",
    "community_area": "8",
    "ward": "42",
    "zip_code": "60601",
    "duplicate": False,
    "legacy_record": False,
    "latitude": "41.8850",
    "longitude": "-87.6300",
}


def request(number: str | None, **fields) -> dict:
    return {"sr_number": number, **DEFAULTS, **fields}


# The expected results depend on them.
SIX = [
    request("SR24-0001"),
    request(
        "SR24-0002",
        sr_type="Aircraft Noise Complaint",
        created_date="2024-01-01T00:00:12.000",
        closed_date="2024-01-01T00:00:13.000",
        last_modified_date="2024-01-01T00:30:39.000",
        community_area="76",
        ward="41",
        zip_code="60666",
        latitude="41.9949",
        longitude="-87.8877",
    ),
    request(
        "SR24-0003",
        sr_type="Rodent Baiting",
        status="Open",
        created_date="2024-01-10T14:30:00.000",
        closed_date=None,
        last_modified_date="2024-01-10T14:30:00.000",
        community_area="22",
        ward="1",
        zip_code="60647",
    ),
    request(
        "SR24-0004",
        sr_type="Tree Trim",
        created_date="2024-01-15T09:00:00.000",
        closed_date="2024-01-14T09:00:00.000",
        last_modified_date="2024-01-14T09:00:00.000",
        community_area="5",
        ward="47",
        zip_code="60613",
    ),
    request(
        "SR24-0003",
        sr_type="Rodent Baiting",
        created_date="2024-01-10T14:30:00.000",
        closed_date="2024-01-18T11:00:00.000",
        last_modified_date="2024-01-18T11:00:00.000",
        community_area="22",
        ward="1",
        zip_code="60647",
    ),
    request(
        "SR24-0005",
        sr_type="CITY INFORMATION ONLY CALL",
        created_date="2024-01-20T12:00:00.000",
        closed_date="2024-01-20T12:05:00.000",
        last_modified_date="2024-01-20T12:05:00.000",
        community_area="",
        ward="",
        zip_code="",
        latitude=None,
        longitude=None,
    ),
]


def bronze(spark, records):
    rows = [tuple(r.get(name) for name in BRONZE.names) for r in records]
    return spark.createDataFrame(rows, BRONZE)


def write_records(path, records) -> str:
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text("".join(json.dumps(r) + "\n" for r in records))
    return str(target)


def census_records() -> list[tuple]:
    """77 areas with distinct incomes; areas 8 and 22 are among the richest. Then the total."""
    rich = {8: 88669, 22: 31908}
    areas = [
        (str(n), f"Area {n}", "4.7", "19.7", "12.9", "x", "33.5", str(rich.get(n, 8000 + 300 * n)), str(n))
        for n in range(1, 78)
    ]
    return [*areas, (None, "TOTAL", "4.7", "19.7", "12.9", "19.5", "33.5", "28202", None)]


def census(spark):
    return spark.createDataFrame(census_records(), CENSUS)


def write_census(path) -> str:
    lines = [",".join(CENSUS.names)]
    for record in census_records():
        lines.append(",".join("" if v is None else f'"{v}"' for v in record))
    Path(path).write_text("\n".join(lines) + "\n")
    return str(path)

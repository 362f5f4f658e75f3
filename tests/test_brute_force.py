"""Random raw records, cleaned and compared by plain Python over the same fixture."""

from __future__ import annotations

import random
import re
import statistics
from collections import defaultdict
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal
from zoneinfo import ZoneInfo

import pytest

from fairwait.plans import equity, star
from fairwait.plans.clean import TIES, clean
from fixtures import bronze, census, request

ZONE = ZoneInfo("America/Chicago")
TYPES = ["Pothole in Street", "Rodent Baiting", "Aircraft Noise Complaint", "Information only call", None]


def raw_time(pick, base):
    """Mostly valid, at times a clock change, at times malformed or absent."""
    kind = pick.random()
    if kind < 0.06:
        return pick.choice([None, "", "soon", "2024-02-30T00:00:00.000", base.isoformat()])
    if kind < 0.2:
        base = datetime(*pick.choice([(2024, 3, 10), (2024, 11, 3)]), pick.randrange(4), pick.randrange(60))
    return base.isoformat(timespec="milliseconds")


def random_records(seed, count):
    pick = random.Random(seed)
    start = datetime(2024, 1, 1)
    for i in range(count):
        created = start + timedelta(seconds=pick.randrange(320 * 86400), milliseconds=pick.randrange(1000))
        closed = created + timedelta(seconds=pick.randrange(-3600, 200 * 3600), milliseconds=pick.randrange(1000))
        yield request(
            pick.choice([None, "", f"N{pick.randrange(count // 2)}", "HOT"]) if pick.random() < 0.4 else f"N{i}",
            sr_type=pick.choice(TYPES),
            status=pick.choice(["Open", "Completed", None]),
            created_date=raw_time(pick, created),
            closed_date=raw_time(pick, closed),
            last_modified_date=raw_time(pick, start + timedelta(days=pick.randrange(5))),
            community_area=pick.choice(["8", " 22 ", "1", "5.0", "abc", "", None, "99", "40"]),
            ward=pick.choice(["1", "x", " ", "3.9"]),
            zip_code=pick.choice(["60601", " 60602", "", "  "]),
            latitude=pick.choice(["41.60", "41.885", "42.10", "42.2", "", None, "north"]),
            longitude=pick.choice(["-87.95", "-87.63", "-87.5", "-87.4", None]),
            duplicate=pick.choice([True, False, None]),
        )


def to_time(text):
    if text is None or not re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{3}", text):
        return None
    try:
        return datetime.fromisoformat(text)
    except ValueError:
        return None


def to_number(text, kind):
    stripped = (text or "").strip(" ")
    if kind is int and not re.fullmatch(r"[+-]?\d+(\.\d*)?", stripped):
        return None
    try:
        return int(stripped.split(".")[0]) if kind is int else float(stripped)
    except ValueError:
        return None


def typed(record):
    row = dict(record)
    row["created_ts"], row["closed_ts"], row["last_modified_ts"] = (
        to_time(record[f"{c}_date"]) for c in ("created", "closed", "last_modified")
    )
    for column, kind in (("community_area", int), ("ward", int), ("latitude", float), ("longitude", float)):
        row[column] = to_number(record[column], kind)
    row["zip_code"] = (record["zip_code"] or "").strip(" ") or None
    return row


def rank(row):
    """Greatest first, absent last, column by column."""
    return [(row[c] is not None, row[c] if row[c] is not None else 0) for c in ("last_modified_ts", *TIES)]


def seconds(ts):
    return int(ts.replace(tzinfo=ZONE, fold=0).timestamp() // 1)


def half_up(value, places):
    return float(Decimal(value).quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP))


def outcome(row):
    created, closed = row["created_ts"], row["closed_ts"]
    taken = seconds(closed) - seconds(created) if created and closed else None
    valid = taken is not None and taken >= 0
    lat, lon = row["latitude"], row["longitude"]
    row["has_valid_resolution"] = valid
    row["resolution_hours"] = half_up(Decimal(taken) / 3600, 2) if valid else None
    row["is_closed"] = closed is not None
    row["has_valid_geo"] = lat is not None and lon is not None and 41.6 <= lat <= 42.1 and -87.95 <= lon <= -87.5
    row["city_flagged_duplicate"] = row["duplicate"]
    row["created_date_only"] = created.date() if created else None
    row["created_year"], row["created_month"] = (created.year, created.month) if created else (None, None)
    return row


def cleaned(records):
    best = {}
    for row in map(typed, records):
        key = row["sr_number"]
        if key is not None and (key not in best or rank(row) > rank(best[key])):
            best[key] = row
    return {key: outcome(row) for key, row in best.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_cleaning_and_marts(spark, seed):
    records = list(random_records(seed, 1500))
    expected = cleaned(records)
    silver = clean(bronze(spark, records))
    found = {r["sr_number"]: r.asDict() for r in silver.collect()}
    assert found.keys() == expected.keys()
    for key, row in found.items():
        assert row == {c: expected[key][c] for c in row}, key

    areas = star.dim_area(star.stg_census(census(spark)))
    quartile = {r["community_area"]: r["income_quartile"] for r in areas.collect()}
    groups = defaultdict(list)
    for row in expected.values():
        kind = (row["sr_type"] or "").lower()
        real = "information only" not in kind and "aircraft noise" not in kind
        if real and row["has_valid_resolution"] and row["community_area"] in quartile:
            q = quartile[row["community_area"]]
            hours = Decimal(str(row["resolution_hours"]))
            groups[(q,)].append(hours)
            if row["sr_type"] is not None:
                groups[(row["sr_type"], q)].append(hours)
    summary = {
        group: (len(v), half_up(sum(v) / len(v), 1), half_up(statistics.median(v), 1)) for group, v in groups.items()
    }
    facts = star.fct_requests(star.stg_requests(silver))
    by_quartile = {(r[0],): tuple(r)[1:] for r in equity.equity_by_quartile(facts, areas).collect()}
    by_type = {tuple(r)[:2]: tuple(r)[2:] for r in equity.equity_by_type(facts, areas, 1).collect()}
    assert by_quartile | by_type == summary
    assert len(by_quartile) == 3 and len(by_type) > 4

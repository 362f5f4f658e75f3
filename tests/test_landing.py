"""Landing from a paged service: slices by its counts, a ledger of what is fetched, damage."""

import json
import random

import pytest

from fairwait.plans.jobs import land_pages
from fairwait.sources import landing, pages, snapshots
from fairwait.sources.pages import Slice, halved
from fairwait.sources.scans import scan_json
from test_sources import service

DAYS = ("2024-01-01", "2024-01-11")


def records(n=40):
    return [{"sr_number": f"A{i:04d}", "created_date": f"2024-01-{1 + i % 10:02d}T08:00:00.{i:03d}"} for i in range(n)]


def counting(rows, calls=None):
    whole = service(rows)

    def count(condition):
        if calls is not None:
            calls.append(condition)
        return len(whole(condition, 0, 10**9))

    return count


def numbers(spark, out):
    return sorted(r["sr_number"] for r in scan_json(spark, out).collect())


def test_a_busy_minute_is_many_slices():
    pick = random.Random(1)
    busy = [{"sr_number": f"B{i}", "created_date": f"2024-01-05T10:30:{pick.randrange(60):02d}.{pick.randrange(1000):03d}"} for i in range(900)]
    rows, asked = busy + records(100), []
    slices = halved(counting(rows, asked), "t", *DAYS, most=20)
    assert max(s.rows for s in slices) <= 20 and sum(s.rows for s in slices) == 1000
    assert all(s.rows == counting(rows)(s.condition("t")) for s in slices)
    assert slices[0].low == "2024-01-01T00:00:00" and slices[-1].high == "2024-01-11T00:00:00"
    assert all(a.high == b.low for a, b in zip(slices, slices[1:]))
    assert len(asked) <= len(slices)  # one count per split


def test_an_instant_is_dealt_by_offset(spark, tmp_path):
    rows = [{"sr_number": f"C{i:03d}", "created_date": "2024-01-05T10:30:00.250"} for i in range(50)]
    slices = halved(counting(rows), "t", *DAYS, most=8)
    assert [(s.offset, s.rows) for s in slices if s.rows] == [(0, 8), (8, 8), (16, 8), (24, 8), (32, 8), (40, 8), (48, 2)]
    out = str(tmp_path / "bronze")
    assert land_pages(spark, service(rows), *DAYS, out, size=2, count=counting(rows)) == 50
    assert numbers(spark, out) == [r["sr_number"] for r in rows]


def test_nothing_to_slice():
    assert [s.rows for s in halved(lambda c: 0, "t", *DAYS, most=5)] == [0]
    assert halved(lambda c: 0, "t", "2024-01-02", "2024-01-01", most=5) == []


def test_a_repeated_job_fetches_what_is_missing(spark, tmp_path):
    """Ten slices, one at a time; the seventh fails."""
    rows, out, log = records(), str(tmp_path / "bronze"), tmp_path / "asked"
    assert land_pages(spark, service(rows[:10]), *DAYS, out) == 10
    whole, asked_for = service(rows), str(log)

    def fetch(condition, offset, size, broken=True):
        with open(asked_for, "a") as file:
            file.write(condition + "\n")
        if broken and "'2024-01-07" in condition.split(" AND ")[0]:
            raise RuntimeError("no answer")
        return whole(condition, offset, size)

    with pytest.raises(landing.LandingIncomplete, match="4 of 10 slices left to fetch: RuntimeError: no answer"):
        land_pages(spark, fetch, *DAYS, out, slice_hours=24, at_once=1)
    assert numbers(spark, out) == sorted(r["sr_number"] for r in rows[:10])
    log.unlink()
    assert land_pages(spark, lambda *a: fetch(*a, broken=False), *DAYS, out, slice_hours=24, at_once=1) == 40
    assert len(set(log.read_text().splitlines())) == 4
    assert numbers(spark, out) == sorted(r["sr_number"] for r in rows)


def test_other_slices_of_a_wave_count_though_one_fails(spark, tmp_path):
    rows, out = records(), str(tmp_path / "bronze")
    whole, count = service(rows), counting(rows)

    def fetch(condition, offset, size):
        page = whole(condition, offset, size)
        if any("-07T" in r["created_date"] for r in page):
            raise RuntimeError("no answer")
        return page

    options = {"size": 1, "count": count, "at_once": 64}
    with pytest.raises(landing.LandingIncomplete):
        land_pages(spark, fetch, *DAYS, out, **options)
    with pytest.raises(landing.LandingIncomplete, match=r"^1 of 1 "):
        land_pages(spark, fetch, *DAYS, out, **options)
    assert land_pages(spark, whole, *DAYS, out, **options) == 40
    assert numbers(spark, out) == sorted(r["sr_number"] for r in rows)


def test_a_large_job_is_few_waves(spark, tmp_path, monkeypatch):
    rows, out, waves, read = records(300), str(tmp_path / "bronze"), [], landing.read_slices
    monkeypatch.setattr(landing, "read_slices", lambda *given, **more: waves.append(len(given[2])) or read(*given, **more))
    monkeypatch.setattr(landing, "ROWS_IN_TURN", 32)
    assert land_pages(spark, service(rows), *DAYS, out, size=1, count=counting(rows), at_once=2) == 300
    assert waves[:4] == [2, 4, 8, 16] and max(waves) == 16 and sum(waves) >= 75 and len(waves) < sum(waves) / 8
    assert numbers(spark, out) == sorted(r["sr_number"] for r in rows)


def test_slices_that_changed_meanwhile_are_fetched_again(spark, tmp_path):
    rows, out = records(20), str(tmp_path / "bronze")
    whole = service(rows)
    fail = lambda c, o, s: 1 / 0 if "'2024-01-10" in c else whole(c, o, s)
    with pytest.raises(landing.LandingIncomplete):
        land_pages(spark, fail, *DAYS, out, slice_hours=24, at_once=2)
    more = [*rows, {"sr_number": "late", "created_date": "2024-01-02T23:00:00.000"}]
    assert land_pages(spark, service(more), *DAYS, out, count=counting(more)) == 21
    assert "late" in numbers(spark, out)


def test_a_ledger_cut_short_is_no_ledger(spark, tmp_path):
    rows, out = records(), str(tmp_path / "bronze")
    whole = service(rows)
    broken = lambda c, o, s: 1 / 0 if "'2024-01-09" in c.split(" AND ")[0] else whole(c, o, s)
    with pytest.raises(landing.LandingIncomplete, match="ZeroDivisionError"):
        land_pages(spark, broken, *DAYS, out, at_once=1)
    for file in sorted((tmp_path / "bronze").rglob("_ledger/*.json"))[-2:]:
        file.write_text(file.read_text()[:-3])
    assert land_pages(spark, whole, *DAYS, out, at_once=1) == 40
    assert numbers(spark, out) == sorted(r["sr_number"] for r in rows)


def test_damaged_slices_are_named(spark, tmp_path):
    rows, out = records(), str(tmp_path / "bronze")
    land_pages(spark, service(rows), *DAYS, out, count=counting(rows), size=2)
    target = f"{out}/{DAYS[0]}_to_{DAYS[1]}"
    assert landing.damaged(spark, target).count() == 0
    victim = next((tmp_path / "bronze").rglob("kind=data/part-*.txt"))
    victim.with_name(f".{victim.name}.crc").unlink()
    victim.write_text(victim.read_text().replace("A", "a", 1))
    found = landing.damaged(spark, target).collect()
    assert len(found) == 1 and found[0]["rows"] == found[0]["found_rows"]


def test_the_data_source_plans_its_own_slices(spark):
    rows = records()
    whole, count = service(rows), counting(rows)
    name = pages.registered(spark, whole, count)
    reader = spark.read.format(name).option("start", DAYS[0]).option("end", DAYS[1]).option("size", "3")
    frame = reader.option("slice_pages", "2").load()
    assert frame.rdd.getNumPartitions() == len(halved(count, "created_date", *DAYS, most=6))
    assert sorted(json.loads(r["value"])["sr_number"] for r in frame.collect()) == [r["sr_number"] for r in rows]


def test_spans_between_known_slices():
    known = [landing.Entry("2024-01-02", "2024-01-03T00:00:00", 0, 1, 0, ""), landing.Entry("2024-01-05T00:00:00.500", "2024-01-06", 0, 1, 0, "")]
    assert landing.gaps(*DAYS, known) == [
        ("2024-01-01", "2024-01-02"), ("2024-01-03T00:00:00", "2024-01-05T00:00:00.500"), ("2024-01-06", "2024-01-11"),
    ]
    assert landing.gaps(*DAYS, []) == [DAYS] and Slice(*DAYS).condition("t") == "t >= '2024-01-01' AND t < '2024-01-11'"


def test_the_service_is_asked_for_a_window_without_records(spark, tmp_path):
    out = str(tmp_path / "bronze")
    assert land_pages(spark, service([]), *DAYS, out, count=lambda c: 0) == 0
    assert scan_json(spark, out).count() == 0
    assert snapshots.commits(spark, f"{out}/{DAYS[0]}_to_{DAYS[1]}", 1)[0].facts["rows"] == 0

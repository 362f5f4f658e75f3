from datetime import datetime, timedelta, timezone

import pytest

from fairwait import __main__ as cli
from fairwait.plans.jobs import read_models
from fairwait.sources.scans import scan_silver
from fairwait.streaming.levels import log_state
from fixtures import SIX, request, write_census, write_records


def test_jobs_in_order(spark, tmp_path, capsys):
    write_records(tmp_path / "bronze" / "a.ndjson", SIX)
    write_census(tmp_path / "census.csv")
    bronze, silver, raw, marts = (str(tmp_path / n) for n in ("bronze", "silver", "raw", "marts"))
    assert cli.main(["clean", "--input", bronze, "--output", silver]) == 0
    assert cli.main(["gate", "--input", silver]) == 0
    assert cli.main(["load", "--input", silver, "--path", raw, "--dry-run"]) == 0
    assert not (tmp_path / "raw").exists()
    assert cli.main(["load", "--input", silver, "--path", raw]) == 0
    assert cli.main(["build", "--path", raw, "--seed", str(tmp_path / "census.csv"), "--output", marts]) == 0
    out = capsys.readouterr().out
    assert out.count("PASS") == 10 and "pass fct_service_requests unique sr_number 0" in out
    assert read_models(spark, marts)["mart_service_equity"].first()["median_resolution_hours"] == 130.3


def test_gate_exits_with_one(spark, tmp_path, capsys):
    write_records(tmp_path / "bronze" / "a.ndjson", [request("far", longitude="-80")])
    silver = str(tmp_path / "silver")
    cli.main(["clean", "--input", str(tmp_path / "bronze"), "--output", silver])
    assert cli.main(["gate", "--input", silver]) == 1
    assert "FAIL between longitude" in capsys.readouterr().out


def test_upsert_job(spark, tmp_path):
    write_records(tmp_path / "bronze" / "a.ndjson", SIX)
    places = [x for n in ("log", "progress", "output") for x in (f"--{n}", str(tmp_path / n))]
    assert cli.main(["upsert", "--input", str(tmp_path / "bronze"), *places]) == 0
    assert scan_silver(spark, str(tmp_path / "output")).count() == 5


def test_marts_from_counts_and_the_census(spark, tmp_path, capsys):
    write_records(tmp_path / "bronze" / "a" / "a.ndjson", SIX)
    write_census(tmp_path / "census.csv")
    places = [x for n in ("log", "progress", "output", "counts") for x in (f"--{n}", str(tmp_path / n))]
    upsert = ["upsert", "--input", str(tmp_path / "bronze"), *places, "--buckets", "2"]
    assert cli.main(upsert) == cli.main(upsert) == 0
    assert not log_state(spark, str(tmp_path / "log")).changes
    marts = ["marts", "--counts", str(tmp_path / "counts"), "--seed", str(tmp_path / "census.csv")]
    assert cli.main([*marts, "--output", str(tmp_path / "marts"), "--at-least", "1"]) == 0
    assert read_models(spark, str(tmp_path / "marts"))["mart_service_equity"].first()["median_resolution_hours"] == 130.3
    assert cli.main(["census", "--input", str(tmp_path / "bronze")]) == 0
    write_records(tmp_path / "bronze" / "b" / "b.ndjson", [{k: v for k, v in request("x").items() if k != "ward"}])
    assert cli.main(["census", "--input", str(tmp_path / "bronze")]) == 1
    assert "b absent ward" in capsys.readouterr().out


def test_compare_after_a_load(spark, tmp_path):
    write_records(tmp_path / "bronze" / "a.ndjson", SIX)
    bronze, silver, raw = (str(tmp_path / n) for n in ("bronze", "silver", "raw"))
    cli.main(["clean", "--input", bronze, "--output", silver])
    cli.main(["load", "--input", silver, "--path", raw])
    assert cli.main(["compare", "--input", silver, "--path", raw]) == 0
    write_records(tmp_path / "bronze" / "b.ndjson", [request("SR24-0003", status="Open", last_modified_date="2024-03-01T00:00:00.000")])
    cli.main(["clean", "--input", bronze, "--output", silver])
    assert cli.main(["compare", "--input", silver, "--path", raw]) == 1


def test_landing_window():
    args = cli.parser().parse_args(["land", "--url", "u", "--out", "o", "--incremental", "3"])
    start, end = cli.landing_window(args)
    today = datetime.now(timezone.utc).date()
    assert (start, end) == (str(today - timedelta(days=3)), str(today + timedelta(days=1)))
    bad = cli.parser().parse_args(["land", "--url", "u", "--out", "o", "--incremental", "0"])
    with pytest.raises(SystemExit):
        cli.landing_window(bad)

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from fairwait.operators.rules import GateFailed, enforce_tests
from fairwait.plans import jobs
from fairwait.plans.clean import clean
from fairwait.plans.jobs import (
    Settings,
    build_marts,
    build_silver,
    create_views,
    load,
    model_tests,
    read_models,
    run_all,
)
from fairwait.schemas import SILVER
from fairwait.sources.scans import scan_json, scan_raw, scan_seed, scan_silver
from fairwait.streaming.levels import log_state
from fairwait.streaming.upsert import (
    append_versions,
    compact_versions,
    current_silver,
    publish_silver,
)
from fixtures import SIX, bronze, request, write_census, write_records


def settings(tmp_path, **options):
    write_census(tmp_path / "census.csv")
    places = {name: str(tmp_path / name) for name in ("bronze", "silver", "raw", "marts")}
    return Settings(seed=str(tmp_path / "census.csv"), start="2024-01-01", end="2024-02-01", **places, **options)


def texts(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_build_silver_counts_rows_and_rejects(spark, tmp_path):
    write_records(tmp_path / "b" / "a.ndjson", [*SIX, request("x", community_area="abc", closed_date="soon"), request(None)])
    counts = build_silver(spark, str(tmp_path / "b"), str(tmp_path / "s"))
    assert counts["bronze_rows"] == 8 and counts["silver_rows"] == 6
    assert counts["rows_without_number"] == 1
    rejected = {k: v for k, v in counts.items() if k.startswith("rejected") and v}
    assert rejected == {"rejected_community_area": 1, "rejected_closed_date": 1}
    assert scan_silver(spark, str(tmp_path / "s")).count() == 6


def test_a_renamed_field_stops_the_run(spark, tmp_path):
    renamed = [{("lat" if k == "latitude" else k): v for k, v in record.items()} for record in SIX]
    write_records(tmp_path / "b" / "a.ndjson", renamed)
    with pytest.raises(jobs.AbsentField, match=": latitude$"):
        build_silver(spark, str(tmp_path / "b"), str(tmp_path / "s"))


def test_a_field_that_is_always_null_is_not_absent(spark, tmp_path):
    write_records(tmp_path / "b" / "a.ndjson", [{**record, "latitude": None} for record in SIX])
    assert build_silver(spark, str(tmp_path / "b"), str(tmp_path / "s"))["silver_rows"] == 5


def test_empty_window_gives_empty_models(spark, tmp_path):
    conf = settings(tmp_path)
    models = run_all(spark, conf, bronze(spark, SIX).where("sr_number = 'none'"))
    assert scan_raw(spark, path=conf.raw).count() == 0
    assert models["dim_community_area"].count() == 77 and models["mart_service_equity"].count() == 0


def test_only_undated_requests(spark, tmp_path):
    write_records(tmp_path / "b" / "a.ndjson", [request("a", created_date=None)])
    counts = build_silver(spark, str(tmp_path / "b"), str(tmp_path / "s"))
    assert counts["silver_rows"] == 1
    inferred = scan_silver(spark, str(tmp_path / "s"), schema=None)
    for silver in (scan_silver(spark, str(tmp_path / "s")), inferred):
        assert load(silver, path=str(tmp_path / "raw"))["matches"] is True
    assert scan_raw(spark, path=str(tmp_path / "raw")).schema["CREATED_YEAR"].dataType.simpleString() == "int"


def test_full_run(spark, tmp_path):
    conf = settings(tmp_path, at_least=1)
    models = run_all(spark, conf, bronze(spark, SIX))
    assert [tuple(r) for r in models["mart_service_equity"].collect()] == [(4, 2, 130.3, 130.3)]
    assert models["mart_equity_by_type"].count() == 2
    assert {name: model.count() for name, model in models.items() if name[:3] != "stg"} == {
        "fct_service_requests": 5,
        "dim_date": 5,
        "dim_community_area": 77,
        "dim_service_type": 5,
        "mart_service_equity": 1,
        "mart_equity_by_type": 2,
    }
    results = model_tests(models)
    assert results.count() == 14 and results.where("status <> 'pass'").count() == 0
    before = texts(models["fct_service_requests"])
    assert texts(run_all(spark, conf, bronze(spark, SIX))["fct_service_requests"]) == before


def test_marts_in_a_database_answer_sql(spark, tmp_path):
    spark.sql("create database if not exists wait_marts")
    try:
        seed = scan_seed(spark, write_census(tmp_path / "census.csv"))
        models = build_marts(clean(bronze(spark, SIX)), seed, database="wait_marts", at_least=1)
        create_views(models)
        joined = spark.sql(
            """select d.day_of_week, a.income_quartile, t.owner_department, s.ward
            from wait_marts.fct_service_requests f
            join wait_marts.dim_date d using (date_day)
            join wait_marts.dim_community_area a using (community_area)
            join wait_marts.dim_service_type t using (sr_type)
            join stg_requests s using (sr_number)
            where f.sr_number = 'SR24-0003'"""
        )
        assert [tuple(r) for r in joined.collect()] == [(3, 4, "Transport", 1)]
        assert spark.table("mart_service_equity").count() == 1
    finally:
        spark.sql("drop database wait_marts cascade")


def test_an_unknown_area_stays_in_the_fact_only(spark, tmp_path):
    records = [*SIX, request("far", community_area="99")]
    seed = scan_seed(spark, write_census(tmp_path / "census.csv"))
    models = build_marts(clean(bronze(spark, records)), seed)
    assert models["fct_service_requests"].where("community_area = 99").count() == 1
    assert models["mart_service_equity"].first()["request_count"] == 2
    results = model_tests(models)
    assert [tuple(r)[:4] for r in results.where("status <> 'pass'").collect()] == [
        ("fct_service_requests", "relationships", "community_area", 1)
    ]
    enforce_tests(results)


def test_failing_gate_keeps_the_last_load(spark, tmp_path):
    conf = settings(tmp_path)
    run_all(spark, conf, bronze(spark, SIX))
    with pytest.raises(GateFailed):
        run_all(spark, conf, bronze(spark, [*SIX, request("far", community_area="99")]))
    assert scan_raw(spark, path=conf.raw).count() == 5


def drops(seed):
    """Versions of 40 requests with ties and unknown times, dealt to three drops."""
    pick = random.Random(seed)
    records = []
    for i in range(300):
        day, closed = pick.randrange(1, 10), pick.choice([None, "2024-01-20T08:00:00.000"])
        records.append(
            request(
                f"N{pick.randrange(40)}",
                last_modified_date=pick.choice([None, f"2024-01-0{day}T10:00:00.000"]),
                created_date=f"2024-0{pick.randrange(1, 4)}-02T08:00:00.000",
                closed_date=closed,
                status=pick.choice(["Open", "Completed"]),
            )
        )
    return [records[i::3] for i in range(3)]


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_upsert_equals_cleaning_everything(spark, tmp_path, order):
    landed, log, progress = (str(tmp_path / p) for p in ("landed", "log", "progress"))
    parts = drops(1)
    for i in order:
        write_records(tmp_path / "landed" / f"{i}.ndjson", parts[i])
        append_versions(spark, landed, log, progress)
    append_versions(spark, landed, log, progress)
    whole = clean(scan_json(spark, landed))
    assert texts(current_silver(spark, log)) == texts(whole)
    publish_silver(spark, log, str(tmp_path / "silver"))
    assert texts(scan_silver(spark, str(tmp_path / "silver")).to(SILVER)) == texts(whole)


def test_a_repeated_batch_is_not_logged_again(spark, tmp_path):
    """Without its commit mark Spark takes the batch for unfinished and runs it again."""
    landed, log, progress = (str(tmp_path / p) for p in ("landed", "log", "progress"))
    for i, part in enumerate(drops(4)):
        write_records(tmp_path / "landed" / f"{i}.ndjson", part)
        append_versions(spark, landed, log, progress)
    logged = log_state(spark, log)
    last = tmp_path / "progress" / "commits" / "2"
    last.unlink()
    last.with_name(".2.crc").unlink(missing_ok=True)
    append_versions(spark, landed, log, progress)
    assert last.exists()
    assert log_state(spark, log) == logged


def test_upsert_goes_on_after_compaction(spark, tmp_path):
    landed, log, short, progress = (str(tmp_path / p) for p in ("landed", "log", "short", "progress"))
    first, second, third = drops(3)
    write_records(tmp_path / "landed" / "1.ndjson", first + second)
    append_versions(spark, landed, log, progress)
    compact_versions(spark, log, short)
    write_records(tmp_path / "landed" / "2.ndjson", third)
    append_versions(spark, landed, short, progress)
    assert texts(current_silver(spark, short)) == texts(clean(scan_json(spark, landed)))


def test_upsert_of_many_small_batches(spark, tmp_path):
    landed, log, progress = (str(tmp_path / p) for p in ("landed", "log", "progress"))
    for i, part in enumerate(drops(2)):
        write_records(tmp_path / "landed" / f"{i}.ndjson", part)
    append_versions(spark, landed, log, progress, files_per_batch=1)
    assert len(log_state(spark, log).recent) == 1 + 3
    assert texts(current_silver(spark, log)) == texts(clean(scan_json(spark, landed)))


def test_a_hot_request_reaches_the_shuffle_as_one_row_per_task(spark):
    """A third of all versions belong to one request."""
    records = [
        request(
            "hot" if i % 3 == 0 else f"N{i}",
            last_modified_date=f"2024-01-0{1 + i % 9}T10:00:00.000",
            zip_code=str(i),
        )
        for i in range(600)
    ]
    df = clean(bronze(spark, records).repartition(4))
    assert df.count() == 401
    plan = df._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan.split("Exchange hashpartitioning")[1]
    assert "row_number(), 1, Partial" in before_shuffle
    assert df.where(F.col("sr_number") == "hot").count() == 1


def test_upsert_takes_in_files_with_an_old_modification_time(spark, tmp_path):
    """A copy that keeps times, or a restore, may land a file older than those seen."""
    landed, log, progress = (str(tmp_path / p) for p in ("landed", "log", "progress"))
    for i, part in enumerate(drops(5)):
        file = tmp_path / "landed" / f"{i}.ndjson"
        write_records(file, part)
        past = time.time() - i * 40 * 86_400
        os.utime(file, (past, past))
        append_versions(spark, landed, log, progress)
    assert texts(current_silver(spark, log)) == texts(clean(scan_json(spark, landed)))


def test_a_fresh_progress_folder_replaces_nothing(spark, tmp_path):
    """The first file is archived; a new stream on the same log starts at batch 0 again."""
    log = str(tmp_path / "log")
    first, second, third = drops(6)
    write_records(tmp_path / "one" / "1.ndjson", first)
    append_versions(spark, str(tmp_path / "one"), log, str(tmp_path / "p1"))
    write_records(tmp_path / "two" / "2.ndjson", second + third)
    append_versions(spark, str(tmp_path / "two"), log, str(tmp_path / "p2"))
    both = scan_json(spark, [str(tmp_path / "one"), str(tmp_path / "two")])
    assert texts(current_silver(spark, log)) == texts(clean(both))


def test_upsert_before_the_first_file(spark, tmp_path):
    (tmp_path / "landed").mkdir()
    append_versions(spark, *(str(tmp_path / p) for p in ("landed", "log", "progress")))
    publish_silver(spark, str(tmp_path / "log"), str(tmp_path / "silver"))
    assert scan_silver(spark, str(tmp_path / "silver")).count() == 0


def test_a_failing_model_test_leaves_the_marts(spark, tmp_path):
    """A fact of a type that the dimension lacks fails before any mart is written."""
    conf = settings(tmp_path)
    run_all(spark, conf, bronze(spark, SIX))
    mart = lambda: read_models(spark, conf.marts)["mart_service_equity"]
    before = texts(mart())
    with pytest.raises(GateFailed):
        run_all(spark, conf, bronze(spark, [*SIX, request("typeless", sr_type=None)]))
    assert texts(mart()) == before


def test_a_load_that_does_not_match_stops_the_run(spark, tmp_path, monkeypatch):
    conf = settings(tmp_path)
    run_all(spark, conf, bronze(spark, SIX))
    mart = lambda: read_models(spark, conf.marts)["mart_service_equity"]
    before = texts(mart())
    whole = jobs.sinks.upper_names
    monkeypatch.setattr(jobs.sinks, "upper_names", lambda df: whole(df).limit(2))
    with pytest.raises(jobs.LoadMismatch):
        run_all(spark, conf, bronze(spark, [*SIX, request("SR24-0099")]))
    assert texts(mart()) == before

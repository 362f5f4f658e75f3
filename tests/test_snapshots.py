"""Targets whose writers end at any point, partitions that keep their files, and tables that change at once."""

import json

import pytest
from pyspark.sql import functions as F

from fairwait.plans import jobs
from fairwait.plans.clean import clean
from fairwait.schemas import SILVER
from fairwait.sources import scans, sinks, snapshots
from fairwait.sources.snapshots import Folder, read_parquet
from fixtures import SIX, bronze, write_census


class Killed(BaseException):
    """The driver is gone: nothing after it runs, no clean-up either."""


@pytest.fixture
def ends_after(monkeypatch):
    """Let every change of a file system but the first n fail, for good."""
    real = {name: getattr(Folder, name) for name in ("put_new", "delete")}

    def limit(n):
        left = [n]

        def wrapped(name):
            def call(self, *args):
                if left[0] <= 0:
                    raise Killed
                left[0] -= 1
                return real[name](self, *args)

            return call

        for name in real:
            monkeypatch.setattr(Folder, name, wrapped(name))

    yield limit
    monkeypatch.undo()


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_a_writer_that_ends_at_any_point_leaves_a_state(spark, tmp_path, ends_after):
    path, old, new = str(tmp_path / "t"), list(range(3)), list(range(7))
    sinks.replace_table(spark.range(3), path=path)
    sinks.replace_table(spark.range(3), path=path)
    for n in range(30):
        ends_after(n)
        try:
            sinks.replace_table(spark.range(7), path=path)
            ended = False
        except Killed:
            ended = True
        assert ids(read_parquet(spark, path)) in (old, new)
        if not ended:
            break
        ends_after(1000)
        sinks.replace_table(spark.range(3), path=path)
    assert n > 2 and ids(read_parquet(spark, path)) == new


def test_a_write_that_fails_and_a_commit_cut_short_change_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_table(spark.range(3), path=path)
    broken = spark.range(5).select(F.raise_error(F.lit("stop")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        sinks.replace_table(broken, path=path)
    number, _ = snapshots.begin(spark, path)
    for text in ("", '{"paths": ["x"', json.dumps({"paths": ["x"], "facts": {}}) + "\n0000"):
        (tmp_path / "t" / "_commits" / f"{number:08d}.json").write_text(text)
        assert ids(read_parquet(spark, path)) == [0, 1, 2]
    sinks.replace_table(spark.range(4), path=path)
    assert ids(read_parquet(spark, path)) == [0, 1, 2, 3]


def test_the_second_of_two_writers_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(snapshots.Conflict):
        with snapshots.replaced(spark, path) as mine:
            spark.range(1).write.parquet(mine)
            sinks.replace_table(spark.range(2), path=path)
    assert ids(read_parquet(spark, path)) == [0, 1]


def test_old_states_stay_for_a_while_and_then_go(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(4):
        before = read_parquet(spark, path) if n else None
        sinks.replace_table(spark.range(n + 1), path=path)
        assert before is None or before.count() == n
    held = [p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("_snapshot=")]
    assert len(held) == snapshots.KEEP
    (tmp_path / "t" / "_snapshot=00000002-lost").mkdir()
    (tmp_path / "t" / "_snapshot=00000009-at-work").mkdir()
    snapshots.expire(spark, path)
    left = {p.name for p in (tmp_path / "t").iterdir()}
    assert "_snapshot=00000002-lost" not in left and "_snapshot=00000009-at-work" in left


def test_a_target_without_a_commit_is_an_error(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "t" / "_snapshot=00000001-x"))
    with pytest.raises(snapshots.NoSnapshot):
        read_parquet(spark, str(tmp_path / "t"))
    assert snapshots.landed(spark, str(tmp_path)) == []


def parted(spark, rows):
    return spark.createDataFrame(rows, "id long, y int, m int")


def test_partitions_that_did_not_change_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_partitioned(parted(spark, [(1, 2024, 1), (2, 2024, 2), (3, None, None), (4, 2023, 1)]), path, ("y", "m"))
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("*.parquet")}
    new = parted(spark, [(12, 2024, 2), (13, 2024, 2), (5, 2025, 1)])
    touched = parted(spark, [(0, 2024, 2), (0, None, None), (0, 2025, 1)]).select("y", "m").collect()
    written = sinks.replace_partitions(new, path, touched, ("y", "m"), note=1)
    found = read_parquet(spark, path, new.schema)
    assert sorted(map(tuple, found.collect())) == [(1, 2024, 1), (4, 2023, 1), (5, 2025, 1), (12, 2024, 2), (13, 2024, 2)]
    assert sorted(p.partition("/")[2] for p in written) == ["y=2024/m=2", "y=2025/m=1"]
    still = {f for f in files if f.exists() and f.stat().st_mtime_ns == files[f]}
    assert {"y=2024/m=1" in str(f) or "y=2023/m=1" in str(f) for f in files if f in still} >= {True}
    assert snapshots.commits(spark, path, 1)[0].facts == {"note": 1}
    with pytest.raises(ValueError, match="not said to differ"):
        sinks.replace_partitions(new, path, touched[:1], ("y", "m"))
    for _ in range(snapshots.KEEP):
        sinks.replace_partitions(new.where("y = 2025"), path, touched[-1:], ("y", "m"))
    assert read_parquet(spark, path, new.schema).count() == 5
    assert not list((tmp_path / "t").glob("_snapshot=00000001-*/y=2024/m=2"))


def test_states_that_became_empty(spark, tmp_path):
    path, schema = str(tmp_path / "t"), parted(spark, []).schema
    sinks.write_partitioned(parted(spark, [(1, 2024, 1)]), path, ("y", "m"))
    touched = parted(spark, [(0, 2024, 1)]).select("y", "m").collect()
    sinks.replace_partitions(parted(spark, []), path, touched, ("y", "m"))
    assert read_parquet(spark, path, schema).count() == 0


def test_a_landing_that_fails_keeps_the_last_one(spark, tmp_path):
    source = bronze(spark, SIX)
    out = str(tmp_path / "bronze")
    jobs.land_window(source, "2024-01-01", "2024-02-01", out)
    broken = source.withColumn("status", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        jobs.land_window(broken, "2024-01-01", "2024-02-01", out)
    assert scans.scan_json(spark, out).count() == 6


def test_a_column_that_silver_lacks_stops_gate_and_load(spark, tmp_path):
    from fairwait import __main__ as cli

    whole, less = str(tmp_path / "whole"), str(tmp_path / "less")
    sinks.write_partitioned(clean(bronze(spark, SIX)), whole)
    scans.scan_silver(spark, whole)
    lacking = clean(bronze(spark, SIX)).drop("sr_type", "owner_department")
    sinks.write_partitioned(lacking, less)
    lacking.write.partitionBy("created_year", "created_month").parquet(str(tmp_path / "plain"))
    for path in (less, str(tmp_path / "plain")):
        with pytest.raises(scans.AbsentColumn, match="sr_type, owner_department"):
            scans.scan_silver(spark, path)
    for job in (["gate", "--input", less], ["load", "--input", less, "--path", str(tmp_path / "raw")]):
        with pytest.raises(scans.AbsentColumn):
            cli.main(job)
    assert not (tmp_path / "raw").exists()
    sinks.write_partitioned(lacking.where("false"), less)
    assert scans.scan_silver(spark, less).count() == 0


def test_a_snapshot_that_lacks_a_column_is_noticed_among_others(spark, tmp_path):
    path, silver = str(tmp_path / "t"), clean(bronze(spark, SIX))
    sinks.write_partitioned(silver, path)
    later = silver.withColumn("created_year", F.lit(2031)).drop("ward")
    sinks.replace_partitions(later, path, later.select("created_year", "created_month").distinct().collect())
    with pytest.raises(scans.AbsentColumn, match="ward"):
        scans.scan_silver(spark, path)


@pytest.mark.parametrize("stop", ["tests", "write"])
def test_no_model_changes_when_a_build_fails(spark, tmp_path, monkeypatch, stop):
    seed, out = scans.scan_seed(spark, write_census(tmp_path / "census.csv")), str(tmp_path / "marts")
    jobs.build_marts(clean(bronze(spark, SIX)), seed, out=out, at_least=1)
    before = {name: sorted(map(str, m.collect())) for name, m in jobs.read_models(spark, out).items()}
    fewer = clean(bronze(spark, SIX[:2]))
    if stop == "tests":
        assert "mart_service_equity" not in jobs.build_marts(fewer, seed, out=out, at_least=1, check=lambda m: False)
    else:
        monkeypatch.setattr(jobs.equity, "equity_by_type", lambda *_: spark.range(1).select(F.raise_error(F.lit("stop"))))
        with pytest.raises(Exception, match="stop"):
            jobs.build_marts(fewer, seed, out=out, at_least=1)
    assert {name: sorted(map(str, m.collect())) for name, m in jobs.read_models(spark, out).items()} == before
    assert len(before) == 6


def test_catalog_tables_change_when_they_are_complete(spark, tmp_path):
    spark.sql(f"create database if not exists wait_tables location '{tmp_path}/db'")
    try:
        table = "wait_tables.raw"
        spark.range(2).write.saveAsTable(table)  # as Spark keeps it, before snapshots
        for n in (3, 4, 5):
            sinks.replace_table(spark.range(n), table=table)
            assert spark.table(table).count() == n
        broken = spark.range(5).select(F.raise_error(F.lit("stop")).cast("long").alias("id"))
        with pytest.raises(Exception, match="stop"):
            sinks.replace_table(broken, table=table)
        assert spark.table(table).count() == 5
        sinks.replace_table(spark.range(2).withColumn("more", F.lit("x")), table=table)
        assert spark.table(table).columns == ["id", "more"] and spark.table(table).count() == 2
        counts = jobs.load(clean(bronze(spark, SIX)), table="wait_tables.sr")
        assert counts["matches"] and spark.table("wait_tables.sr").columns == [c.upper() for c in SILVER.names]
    finally:
        spark.sql("drop database wait_tables cascade")


def test_a_load_of_other_rows_leaves_the_table(spark, tmp_path, monkeypatch):
    silver, path = clean(bronze(spark, SIX)), str(tmp_path / "raw")
    jobs.load(silver, path=path)
    whole = sinks.upper_names
    monkeypatch.setattr(jobs.sinks, "upper_names", lambda df: whole(df).limit(2))
    with pytest.raises(jobs.LoadMismatch):
        jobs.load(silver, path=path)
    assert scans.scan_raw(spark, path=path).count() == 5

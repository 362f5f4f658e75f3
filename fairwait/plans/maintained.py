"""Marts kept up to date by differences.

A mart needs no more than how many comparable requests have which duration, per area and type. Such counts can be
added and taken away: what changed in the version log since the last time is counted once for the old versions, with a
minus, and once for the new ones. So an update costs what changed, and a mart what the counts hold, however many
requests there are. Counts are kept as runs in levels, like the log they come from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairwait.plans import equity, star
from fairwait.plans.clean import KEY, with_outcome
from fairwait.schemas import HIGH_VOLUME, TIME_ZONE
from fairwait.sources import snapshots
from fairwait.sources.snapshots import PREFIX, Folder
from fairwait.streaming import levels
from fairwait.streaming.upsert import VERSIONS, current_versions, publish_silver

COUNTED = "community_area int, sr_type string, tick long, n long"


def counted(versions: DataFrame, zone: str = TIME_ZONE) -> DataFrame:
    """Comparable requests among ``versions``, counted per area, type and duration."""
    return equity.comparable_counts(star.fct_requests(star.stg_requests(with_outcome(versions, zone))))


def _summed(counts: DataFrame) -> DataFrame:
    keys = ("community_area", "sr_type", "tick")
    return counts.groupBy(*keys).agg(F.sum("n").alias("n")).where("n <> 0")


def advance_counts(
    spark: SparkSession, log: str, target: str, zone: str = TIME_ZONE, ratio: int = levels.RATIO
) -> bool:
    """Bring the counts at ``target`` up to the version log; false where nothing changed.

    The first time, and where the log no longer keeps the changes in between, all versions are counted.
    """
    state = levels.fold(spark, log, VERSIONS)
    last = snapshots.commits(spark, target, 1)
    facts = last[0].facts if last and last[0].facts.get("log") == log else {}
    changed = levels.changes_since(spark, log, state, KEY, facts["folds"]) if facts else None
    runs: list[list] = facts.get("runs", []) if changed is not None else []
    if changed is None:
        added = counted(current_versions(spark, log), zone)
    elif changed.isEmpty():
        return False
    else:
        minus = counted(changed.where(F.col("old").isNotNull()).select("old.*"), zone)
        added = _summed(counted(changed.select("new.*"), zone).unionByName(minus.withColumn("n", -F.col("n"))))
    number, name = snapshots.begin(spark, target)
    folder = Folder(spark, target)
    added.write.parquet(folder.at(name))
    runs = [*runs, [name, 0]]
    level = 0
    while level <= max(depth for _, depth in runs):
        same = [path for path, depth in runs if depth == level]
        if len(same) >= ratio:
            merged = f"{PREFIX}{number:08d}-level{level + 1}-{name[-12:]}"
            _summed(_read(spark, target, same)).write.parquet(folder.at(merged))
            runs = [run for run in runs if run[1] != level] + [[merged, level + 1]]
        level += 1
    snapshots.commit(spark, target, number, [path for path, _ in runs], log=log, folds=state.folds, runs=runs)
    snapshots.expire(spark, target)
    return True


def _read(spark: SparkSession, target: str, runs: list[str]) -> DataFrame:
    return spark.read.schema(COUNTED).parquet(*[f"{target}/{run}" for run in runs])


def current_counts(spark: SparkSession, target: str) -> DataFrame:
    """(community_area, sr_type, tick, n) of the current state."""
    last = snapshots.commits(spark, target, 1)
    if not last:
        raise snapshots.NoSnapshot(f"nothing was ever committed to {target}")
    return _summed(_read(spark, target, list(last[0].paths)))


def marts(spark: SparkSession, target: str, areas: DataFrame, at_least: int = HIGH_VOLUME) -> dict[str, DataFrame]:
    """Both marts from the counts, as the models build them from all facts."""
    counts = current_counts(spark, target)
    return {
        "mart_service_equity": equity.equity_by_quartile_of(counts, areas),
        "mart_equity_by_type": equity.equity_by_type_of(counts, areas, at_least),
    }


def advance(
    spark: SparkSession, log: str, silver: str | None = None, counts: str | None = None, zone: str = TIME_ZONE
) -> None:
    """Bring silver and the counts up to the log, each by what changed; then drop the changes that both have taken in.

    A job that ends in between is run again: what is up to date already costs nothing.
    """
    if silver is not None:
        publish_silver(spark, log, silver, zone)
    if counts is not None:
        advance_counts(spark, log, counts, zone)
    readers = [target for target in (silver, counts) if target is not None]
    if readers:
        levels.forget_changes(spark, log, min(snapshots.commits(spark, target, 1)[0].facts["folds"] for target in readers))

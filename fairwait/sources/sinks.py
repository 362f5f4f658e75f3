"""Sinks. Every one replaces the state of its target when the new one is complete, so a job can be run again."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from fairwait.schemas import SILVER, SILVER_PARTITIONS
from fairwait.sources.snapshots import Folder, begin, commit, commits, expire, is_target, replaced

# Landed text is packed, to about a tenth. A packed file is read by one task, so it holds no more lines than these: some
# 100 MB of text.
PACKED = {"compression": "gzip", "maxRecordsPerFile": 250_000}


def land_text(lines: DataFrame, path: str) -> int:
    """Write a column of JSON lines as they are, packed, as the new state of ``path``; returns their number.

    The number is taken while writing. For a source that is only filtered it is exact
    even when tasks are repeated.
    """
    written = Observation()
    counted = lines.observe(written, F.count(F.lit(1)).alias("rows"))
    with replaced(lines.sparkSession, path) as folder:
        counted.write.options(**PACKED).text(folder)
    return written.get["rows"]


def land_json(df: DataFrame, path: str, **options: str) -> int:
    """Write rows as JSON lines with explicit nulls; returns their number.

    ``options`` are those of ``to_json``, such as ``timestampNTZFormat``.
    """
    record = F.to_json(F.struct("*"), {"ignoreNullFields": "false", **options})
    return land_text(df.select(record.alias("value")), path)


def _laid_out(df: DataFrame, by: Sequence[str], derive: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    dealt = df.hint("rebalance", *by)
    return dealt if derive is None else derive(dealt)


def write_partitioned(
    df: DataFrame,
    path: str,
    by: tuple[str, ...] = SILVER_PARTITIONS,
    check: Callable[[], None] | None = None,
    derive: Callable[[DataFrame], DataFrame] | None = None,
    **facts,
) -> None:
    """Parquet in one folder per value of ``by``; NULL goes to the default partition.

    The rebalance gathers a partition's rows into files of the advisory size. It splits
    a partition that holds many rows over many tasks and merges small ones. Partitions that
    are not written again go away. The new state holds when it is complete and ``check`` did not raise; ``facts`` are noted with it.
    ``derive`` adds columns that need not be shuffled; it leaves those of ``by`` as they are.
    """
    writer = _laid_out(df, by, derive).write.partitionBy(*by)
    with replaced(df.sparkSession, path, **facts) as folder:
        writer.parquet(folder)
        if check is not None:
            check()


def replace_partitions(
    df: DataFrame,
    path: str,
    touched: Sequence[Row],
    by: tuple[str, ...] = SILVER_PARTITIONS,
    derive: Callable[[DataFrame], DataFrame] | None = None,
    **facts,
) -> list[str]:
    """A new state of ``path`` with the partitions in ``touched`` as ``df`` has them, and all others as they are; returns
    the folders written anew.

    ``touched`` has one row per partition that may differ, ``df`` all rows of those. Files of others are neither read nor
    written: the commit lists their folders again. A partition that ``df`` has no row for goes away. ``derive`` is that of
    ``write_partitioned``.
    """
    spark = df.sparkSession
    folder, last = Folder(spark, path), commits(spark, path, 1)
    if not last and folder.names() and not is_target(spark, path):
        raise ValueError(f"{path} is a plain folder; write it once as a whole")
    before = [leaf for state_path in (last[0].paths if last else ()) for leaf in _leaves(folder, state_path, by)]
    left_out = {_leaf_name(row, by) for row in touched}
    number, name = begin(spark, path)
    try:
        _laid_out(df, by, derive).write.partitionBy(*by).parquet(folder.at(name))
        written = _leaves(folder, name, by)
        kept = [leaf for leaf in before if leaf.partition("/")[2] not in left_out]
        double = {leaf.partition("/")[2] for leaf in kept} & {leaf.partition("/")[2] for leaf in written}
        if double:
            raise ValueError(f"partitions with rows that were not said to differ: {sorted(double)}")
    except BaseException:
        folder.delete(name)
        raise
    commit(spark, path, number, kept + written, **facts)
    expire(spark, path)
    return written


def _leaf_name(row: Row, by: tuple[str, ...]) -> str:
    null = "__HIVE_DEFAULT_PARTITION__"
    return "/".join(f"{c}={null if row[c] is None else row[c]}" for c in by)


def _leaves(folder: Folder, path: str, by: tuple[str, ...]) -> list[str]:
    """The folders of partitions at or below ``path``, relative to the target."""
    missing = len(by) - path.count("/")
    found = [path]
    for _ in range(missing):
        found = [f"{p}/{n}" for p in found for n, is_folder in folder.names(p).items() if is_folder and "=" in n]
    return found


def conform(df: DataFrame, schema: StructType = SILVER) -> DataFrame:
    """Names, order and types of the declared target; a column that is absent is an error."""
    absent = [c for c in schema.names if c not in df.columns]
    if absent:
        raise ValueError(f"columns not found: {', '.join(absent)}")
    whole = tuple(f.name for f in schema if isinstance(f.dataType, IntegerType))
    return int_columns(df, whole).to(schema)


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def int_columns(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Nullable integers for those of ``names`` that the frame has."""
    return df.withColumns({c: F.col(c).cast("int") for c in names if c in df.columns})


def replace_table(
    df: DataFrame,
    table: str | None = None,
    path: str | None = None,
    source: str = "parquet",
    **options: str,
) -> None:
    """Full reload of a catalog table, a path, or another Spark sink.

    A path and a catalog table change when the new state is complete. For a database:
    ``source="jdbc", truncate="true", url=..., dbtable=...``, which changes as its driver does it.
    """
    writer = df.write.format(source).options(**options)
    if table:
        written_table(df, table, source, **options).switch()
    elif path:
        with replaced(df.sparkSession, path) as folder:
            writer.save(folder)
    else:
        writer.mode("overwrite").save()


@dataclass(frozen=True)
class WrittenTable:
    """The next state of a catalog table, complete in its folder, and not yet what the table's name stands for."""

    spark: SparkSession
    table: str
    source: str
    target: str
    number: int
    name: str

    @property
    def folder(self) -> str:
        return f"{self.target}/{self.name}"

    def read(self) -> DataFrame:
        return self.spark.read.format(self.source).load(self.folder)

    def switch(self) -> None:
        """Make the table this state. With the columns as before the catalog takes it as one change of location; else the
        table is made anew. A table that Spark kept in the warehouse itself is replaced by one over the snapshots.
        """
        spark, schema = self.spark, self.read().schema
        commit(spark, self.target, self.number, [self.name])
        location = self.folder.replace("'", "\\'")
        known = spark.catalog.tableExists(self.table)
        if known and spark.catalog.getTable(self.table).tableType == "EXTERNAL" and spark.table(self.table).schema == schema:
            spark.sql(f"alter table {self.table} set location '{location}'")
        else:
            spark.sql(f"drop table if exists {self.table}")
            spark.sql(f"create table {self.table} using {self.source} location '{location}'")
        spark.catalog.refreshTable(self.table)
        expire(spark, self.target)


def written_table(df: DataFrame, table: str, source: str = "parquet", **options: str) -> WrittenTable:
    """Write the next state of ``table`` beside the current one, below its database's location."""
    spark = df.sparkSession
    database, _, name = table.rpartition(".")
    place = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri.rstrip("/")
    target = f"{place}/_tables/{name}"
    number, folder = begin(spark, target)
    written = WrittenTable(spark, table, source, target, number, folder)
    df.write.format(source).options(**options).save(written.folder)
    return written


def dry_run(df: DataFrame) -> DataFrame:
    """What a load would write: one row per column with its type and the number of rows."""
    columns = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("column_type"),
            F.col("row_count"),
        )
        for i, field in enumerate(df.schema.fields, 1)
    ]
    counted = df.agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select(F.inline(F.array(*columns)))


def reconcile(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: rows on both sides and whether they agree. Parquet answers from its footers."""
    sides = [
        side.agg(
            F.count(F.lit(1)).alias("n"),
        ).select(F.lit(label).alias("side"), "n")
        for label, side in (("source", source), ("target", target))
    ]
    n_of = {
        label: F.max(F.when(F.col("side") == label, F.col("n"))) for label in ("source", "target")
    }
    return (
        sides[0]
        .unionByName(sides[1])
        .agg(n_of["source"].alias("source_rows"), n_of["target"].alias("target_rows"))
        .withColumn("matches", F.col("source_rows") == F.col("target_rows"))
    )

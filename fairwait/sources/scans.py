"""Scans with declared schemas: no inference pass, absent fields read as NULL."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fairwait.schemas import BRONZE, CENSUS, SILVER
from fairwait.sources.snapshots import PREFIX, landed, read_parquet, state


class AbsentColumn(ValueError):
    """The files of a table lack columns that its schema declares."""



def scan_json(spark: SparkSession, path: str | list[str], schema: StructType = BRONZE) -> DataFrame:
    """All JSON-lines files below ``path``, which is every pull landed so far: of each window its current state.

    A line that is no JSON reads as a record of NULLs.
    """
    paths = landed_paths(spark, path)
    if not paths:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE")
    return reader.option("recursiveFileLookup", "true").json(paths)


def landed_paths(spark: SparkSession, path: str | list[str]) -> list[str]:
    return [found for one in ([path] if isinstance(path, str) else path) for found in landed(spark, one)]


def absent_fields(spark: SparkSession, path: str | list[str], names: list[str]) -> list[str]:
    """Those of ``names`` that no landed record has as a field at its top. A field that is there and
    always null is not absent; a name within a value or a nested record does not count. One pass over the text."""
    lines = spark.read.option("recursiveFileLookup", "true").text(landed_paths(spark, path))
    fields = lines.select(F.json_object_keys("value").alias("fields"))
    row = fields.agg(*[F.bool_or(F.array_contains("fields", name)).alias(name) for name in names]).first()
    return [name for name in names if row[name] is False]


def scan_silver(spark: SparkSession, path: str, schema: StructType | None = SILVER) -> DataFrame:
    """A partitioned Parquet dataset; the partition columns come last.

    Declaring the schema types a partition column that holds only NULL, and lets a
    dataset without files read as empty. A declared column that the files lack is an error. With ``None`` the schema is inferred.
    """
    if schema is not None:
        absent = absent_columns(spark, path, schema)
        if absent:
            raise AbsentColumn(f"columns not found in {path}: {', '.join(absent)}")
    return read_parquet(spark, path, schema)


def absent_columns(spark: SparkSession, path: str, schema: StructType) -> list[str]:
    """Declared columns that are neither in the files nor in the names of their folders.

    Reads one footer per snapshot that the state takes files from, as a job writes its files alike. A dataset without
    files lacks nothing.
    """
    one_of = {place.partition(PREFIX)[2].partition("/")[0]: place for place in state(spark, path) or [path]}
    absent = []
    for place in one_of.values():
        try:
            found = spark.read.option("basePath", path).parquet(place).columns
        except AnalysisException as unknown:
            if unknown.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            continue
        absent += [name for name in schema.names if name not in found and name not in absent]
    return absent


def scan_seed(spark: SparkSession, path: str, schema: StructType | str = CENSUS) -> DataFrame:
    """A CSV with quoted text; empty fields read as NULL, quoted or not.

    Columns are found by the names in the header, so their order does not matter and others
    are left out; a declared column that the header lacks is an error.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    seed = spark.read.csv(path, header=True)
    return seed.select(
        *[F.nullif(F.col(f"`{f.name}`"), F.lit("")).try_cast(f.dataType).alias(f.name) for f in schema]
    )


def scan_raw(spark: SparkSession, table: str | None = None, path: str | None = None) -> DataFrame:
    """The loaded raw table, by catalog name or by path."""
    return spark.table(table) if table else read_parquet(spark, path)

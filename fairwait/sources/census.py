"""What fields landed records really have, pull by pull, against the declared schema and the pull before.

One pass over the text: every record is parsed as a variant, and the schemas of a pull's records are merged where they
are read. So a name counts as a field only where it is one, at the top of a record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fairwait.schemas import BRONZE
from fairwait.sources.scans import landed_paths
from fairwait.sources.snapshots import COMMITS, PREFIX

CENSUS_ROW = "pull string, field string, finding string, kind string, expected string, records long"
OF_TYPE = {"string": "STRING", "boolean": "BOOLEAN", "double": "DOUBLE", "int": "BIGINT", "bigint": "BIGINT"}


def pull_of(path: str = "_metadata.file_path"):
    """The folder that a file was landed in: its window, or its folder."""
    folder = F.regexp_replace(F.url_decode(F.col(path)), f"/({PREFIX}[^/]*|{COMMITS})(/.*)?$|/[^/]*$", "")
    return F.regexp_extract(folder, "([^/]*)$", 1)


def pull_schemas(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(pull, records, broken, schema): the merged schema of a pull's records as text; broken lines are no objects."""
    lines = spark.read.option("recursiveFileLookup", "true").text(landed_paths(spark, path))
    record = F.try_parse_json("value")
    is_object = F.schema_of_variant(record).startswith("OBJECT")
    parsed = lines.select(pull_of().alias("pull"), F.when(is_object, record).alias("record"))
    return parsed.groupBy("pull").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("record").isNull()).alias("broken"),
        F.schema_of_variant_agg("record").alias("schema"),
    )


def fields_of(schema: str | None) -> dict[str, str]:
    """Names and kinds at the top of a merged schema such as ``OBJECT<a: BIGINT, b: ARRAY<STRING>>``."""
    if not schema or not schema.startswith("OBJECT<"):
        return {}
    found, depth, quoted, start = [], 0, False, 0
    text = schema[len("OBJECT<") : -1]
    for at, sign in enumerate(text):
        if sign == "`":
            quoted = not quoted
        elif not quoted and sign in "<(":
            depth += 1
        elif not quoted and sign in ">)":
            depth -= 1
        elif not quoted and not depth and sign == ",":
            found.append(text[start:at])
            start = at + 1
    if text.strip():
        found.append(text[start:])
    fields = {}
    for item in found:
        name, kind = _name_and_kind(item.strip())
        fields[name] = kind
    return fields


def _name_and_kind(item: str) -> tuple[str, str]:
    if item.startswith("`"):
        end = 1
        while item[end : end + 1] != "`" or item[end + 1 : end + 2] == "`":
            end += 2 if item[end] == "`" else 1
        return item[1:end].replace("``", "`"), item[end + 1 :].partition(":")[2].strip()
    name, _, kind = item.partition(":")
    return name.strip(), kind.strip()


def findings(pulls: list[tuple[str, int, int, str | None]], declared: dict[str, str]) -> list[tuple]:
    """Rows of the census from (pull, records, broken, schema), in the order of pulls.

    A field is expected with its declared kind, or with that of the pull before where it is not declared. ``VOID``, a
    field that is always null, agrees with every kind. Of a pull that lacks one expected field and has one unexpected field of its
    kind, the two are one field that was renamed; with more of them the kinds must tell which.
    """
    rows, before = [], {}
    for pull, records, broken, schema in sorted(pulls):
        fields = fields_of(schema)
        if broken:
            rows.append((pull, None, "broken", None, None, broken))
        if records == broken:
            continue
        expected = {**before, **declared}
        absent = {name: kind for name, kind in expected.items() if name not in fields}
        extra = {name: kind for name, kind in fields.items() if name not in expected}
        for name, kind in fields.items():
            if name in expected and "VOID" not in (kind, expected[name]) and kind != expected[name]:
                rows.append((pull, name, "retyped", kind, expected[name], records))
        for name, kind in sorted(extra.items()):
            like = [n for n, k in absent.items() if k == kind and list(extra.values()).count(kind) == 1]
            if len(like) == 1:
                rows.append((pull, name, "renamed", kind, like[0], records))
                absent.pop(like[0])
            else:
                rows.append((pull, name, "additional", kind, None, records))
        rows += [(pull, name, "absent", None, kind, records) for name, kind in sorted(absent.items())]
        before = {name: kind for name, kind in fields.items() if kind != "VOID" or name not in before}
    return rows


def field_census(spark: SparkSession, path: str | list[str], schema: StructType = BRONZE) -> DataFrame:
    """``pull, field, finding, kind, expected, records`` for every field of a pull that is ``absent``, ``additional``, ``renamed`` or
    ``retyped``, and for lines that are ``broken``; nothing for pulls as declared. ``expected`` is the kind expected, for a
    renamed field its name before. One row per pull comes to the driver.
    """
    declared = {f.name: OF_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString().upper()) for f in schema}
    if not landed_paths(spark, path):
        return spark.createDataFrame([], CENSUS_ROW)
    pulls = [tuple(row) for row in pull_schemas(spark, path).collect()]
    return spark.createDataFrame(findings(pulls, declared), CENSUS_ROW)

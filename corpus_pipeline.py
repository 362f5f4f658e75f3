"""From raw documents to token ids: quality rules, line dedup, near-duplicates, mix, encoding.

Each stage takes what its predecessor kept, as a table read back from the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairwait.llm.bpe import decode, default_vocabulary, encode
from fairwait.llm.common import staged, table
from fairwait.llm.jaccard import grouped
from fairwait.llm.line_runs import without_repeats
from fairwait.llm.mixing import take
from fairwait.llm.quality import cleaned


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, without their lines that fail."""
    return cleaned(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of runs of lines.

    A document of which no line is left is a copy of earlier ones, and goes; a text that had no
    line with a word to begin with stays.
    """
    left = without_repeats(docs).where("_deleted < _lines or _lines = 0")
    return left.drop("_lines", "_deleted")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of similar ones: the first by doc_id, then row; a NULL doc_id comes first.

    Rows are numbered and written first, and told apart by that number, so rows that repeat a doc_id, or
    have none, stay or go each by its own text.
    """
    rows = staged(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    groups = grouped(rows.select(F.col("_row").alias("doc_id"), "text"))
    groups = groups.select(F.col("doc_id").alias("_row"), "component_id")
    members = groups.join(rows.select("_row", "doc_id").hint("merge"), "_row")
    firsts = members.groupBy("component_id").agg(F.min(F.struct("doc_id", "_row"))["_row"].alias("_row"))
    firsts = staged(firsts.select("_row"), "firsts")
    return rows.join(firsts.hint("merge"), "_row", "left_semi").select(*docs.columns)


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; a repeat is a row of its own."""
    return take(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, ids and their number for every row, and the digest of the bytes that the ids decode to.

    A row whose bytes are not those of its text is an error. NULL text counts as empty.
    """
    vocabulary = default_vocabulary()
    marked = docs.withColumn("_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))
    found = decode(encode(marked, vocabulary, keep=("doc_id", "source", "_sha256")), vocabulary)
    decoded = F.sha2("data", 256)
    wrong = F.raise_error(F.concat(F.lit("ids do not decode to the text of doc_id "), F.coalesce(F.col("doc_id").cast("string"), F.lit("NULL"))))
    return found.select(
        "doc_id",
        "source",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.when(decoded == F.col("_sha256"), decoded).otherwise(wrong).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("target_mix", target_mix),
    ("token_ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs


# Line runs, components of a similarity join and BPE merges are not stated in SQL.
ORACLE_SQL = None

"""Deleting repeated runs of lines: later copies of a run that occurred before.

The lines with a word of every text are suffixes of it, told apart by (row, place). A table of them is ordered
by prefix doubling: at first a suffix ranks by its line, then, round by round, by its own rank and that
of the suffix as many lines further on as the rank covers, so a round doubles what is covered. Suffixes of
one rank are an interval of the suffix array: they share that many lines at least. A suffix that is alone in its interval
is settled and leaves; rounds end when none is left, so their number is the logarithm of the longest repeated run.

In an interval the first occurrence stays, and all others begin a repeated run as long as the interval is
deep. It counts from the depth on at which it has enough words; where this is no power of two, two
overlapping ranks name the interval. Runs of a text that meet are put together to longest ones, and go.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from fairwait.llm.common import WORD, staged, table
from fairwait.operators.ranks import with_position

LEAST_WORDS = 1  # any line with a word; a larger number leaves shorter runs in place
SPACES = " \t\n\v\f\r"
PLACE = ("doc_id", "_row", "at")  # of equal runs the first stays in this order


def digest(line: bytes) -> bytes:
    """16 bytes that name a line."""
    return blake2b(line, digest_size=16).digest()


def lines_of(text: str) -> list[tuple[int, str, int]]:
    """(number, line without white space around it, words) of the lines with a word."""
    found = []
    for number, line in enumerate(text.split("\n")):
        line = line.strip(SPACES)
        if line:
            words = sum(map(bool, line.translate(TO_SPACE).split(" ")))
            found.append((number, line, words))
    return found


TO_SPACE = str.maketrans(SPACES, " " * len(SPACES))


def depths_of(words: list[int], least: int) -> list[list[int]]:
    """For each line the depths, in lines, at which its suffix is looked up: the least with ``least`` words,
    where there is one, then those of the shortest such windows up to a line that begin here."""
    sums = [0, *accumulate(words)]
    found: list[list[int]] = [[] for _ in words]
    end = 0
    for start in range(len(words)):
        while end < len(words) and sums[end] - sums[start] < least:
            end += 1
        if sums[end] - sums[start] >= least:
            found[start].append(end - start)
    start = 0
    for end in range(1, len(words) + 1):
        while sums[end] - sums[start + 1] >= least:
            start += 1
        if sums[end] - sums[start] >= least and end - start not in found[start][:1]:
            found[start].append(end - start)
    return found


def suffixes(docs: DataFrame, least_words: int) -> DataFrame:
    """(_row, doc_id, at, depths, name) of every line with a word of ``docs`` (_row, doc_id, text);
    ``at`` counts these lines from 0 and ``name`` is the digest of the line."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row, doc, text in zip(*[c.to_pylist() for c in batch.columns]):
                lines = lines_of(text or "")
                depths = depths_of([n for _, _, n in lines], least_words)
                rows += [
                    (row, doc, at, depths[at], digest(line.encode("utf-8", "surrogatepass")))
                    for at, (_, line, _) in enumerate(lines)
                ]
            columns = zip(*rows) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    doc_type = docs.schema["doc_id"].dataType
    types = [pa.int64(), to_arrow_type(doc_type), pa.int32(), pa.list_(pa.int32()), pa.binary()]
    names = ["_row", "doc_id", "at", "depths", "name"]
    return docs.select("_row", "doc_id", "text").mapInArrow(
        name, f"_row long, doc_id {doc_type.simpleString()}, at int, depths array<int>, name binary"
    )


def intervals_of(table: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, origin) of the groups of two suffixes or more; the origin is the first by doc_id, row and place.
    Minima are aggregated before the shuffle."""
    found = table.groupBy(*keys).agg(F.count("*").alias("n"), F.min(F.struct(*PLACE)).alias("origin"))
    return found.where("n > 1").drop("n")


def later_in(table: DataFrame, intervals: DataFrame, keys: list[str]) -> DataFrame:
    """``table``, as far as in ``intervals``, and whether a suffix is a ``later`` one of its interval. The
    merge join can split an interval that very many suffixes share."""
    return table.join(intervals.hint("merge"), keys).withColumn("later", F.col("origin") < F.struct(*PLACE)).drop("origin")


def ranked(table: DataFrame, keys: list[str]) -> DataFrame:
    """Suffixes that share ``keys`` with another: _row, doc_id, at, depths, later, and as ``rank`` the number of
    their interval in the order of the keys."""
    intervals = staged(intervals_of(table, keys), "intervals")
    intervals = with_position(intervals.orderBy(*keys)).select(*keys, "origin", F.col("_position").alias("rank0"))
    found = later_in(table, intervals, keys)
    return staged(found.select("_row", "doc_id", "at", "depths", "later", F.col("rank0").alias("rank")), "ranks")


def ranks_ahead(table: DataFrame, level: DataFrame, further: Column) -> DataFrame:
    """``table`` with ``next``, the rank in ``level`` of the suffix ``further`` lines on; without
    suffixes that have none there, as they share what lies between with no other."""
    ahead = level.select("_row", F.col("at").alias("ahead"), F.col("rank").alias("next"))
    moved = table.withColumn("ahead", F.col("at") + further)
    return moved.join(ahead.hint("merge"), ["_row", "ahead"]).drop("ahead")


def run_from(first: Column, lines: Column) -> list[Column]:
    return ["_row", first.alias("first"), (first + lines - 1).cast("int").alias("last")]


def repeated_runs(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(_row, first, last): runs of lines of ``docs`` (_row, doc_id, text) that occurred before, by
    places among the lines with a word. They overlap; together they are all lines that go."""
    level = ranked(staged(suffixes(docs, least_words), "suffixes"), ["name"])
    found, lines = [], 1
    while not level.isEmpty():
        deep = F.lit(lines)
        enough = F.get("depths", F.lit(0)) <= deep
        found.append(level.where(F.col("later") & enough).select(*run_from(F.col("at"), deep)))
        if least_words > 1:
            # Depths between two rounds: two ranks of this one, the second ending where the depth does.
            asked = level.withColumn("depth", F.explode("depths"))
            asked = asked.where((F.col("depth") > deep) & (F.col("depth") < 2 * lines))
            asked = staged(ranks_ahead(asked, level, F.col("depth") - deep), "asked")
            keys = ["depth", "rank", "next"]
            later = later_in(asked, staged(intervals_of(asked, keys), "intervals"), keys).where("later")
            found.append(later.select(*run_from(F.col("at"), F.col("depth"))))
        pairs = staged(ranks_ahead(level, level, deep).drop("later"), "pairs")
        level = ranked(pairs, ["rank", "next"])
        lines *= 2
    found.append(level.select(*run_from(F.col("at"), F.lit(1))))  # none, for its columns
    return reduce(DataFrame.union, found)


def repeated(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(_row, _runs) for rows of ``docs`` (_row, doc_id, text) with lines to delete: the longest runs
    (first, last), apart from each other, by places among the lines with a word."""
    runs = staged(repeated_runs(docs, least_words), "repeats")
    of_row = Window.partitionBy("_row").orderBy("first", "last")
    until = F.max("last").over(of_row.rowsBetween(Window.unboundedPreceding, -1))
    apart = runs.withColumn("apart", F.when(F.col("first") <= until + 1, 0).otherwise(1))
    joined = apart.withColumn("run", F.sum("apart").over(of_row.rowsBetween(Window.unboundedPreceding, 0)))
    longest = joined.groupBy("_row", "run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return longest.groupBy("_row").agg(F.collect_list(F.struct("first", "last")).alias("_runs"))


def without_repeats(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` (doc_id, text, any others) with ``text`` rid of later copies of runs of lines, and
    ``_lines`` and ``_deleted``, the numbers of lines with a word and of those deleted.

    * A run is any number of consecutive lines with a word, ``least_words`` words or more in all;
      white space around lines and lines without a word between them do not matter, and the
      latter stay. Of equal runs the first stays, by doc_id, then row, then line.
    * NULL text stays NULL. A text all of whose lines go keeps its row. Rows that repeat a doc_id, wholly or
      not, are rows of their own, so a repeated row loses its text. A NULL doc_id comes first.
    * An empty table gives an empty one. Other columns are kept; names with an underscore
      are reserved, and ``n_chars``, where present, is counted again.

    The rows are numbered and written first; everything is keyed by that number. Joins are
    shuffles at every size, as what they bring together grows with the documents.
    """
    rows = staged(docs.withColumn("_row", F.monotonically_increasing_id()), "lines")
    runs = staged(repeated(rows, least_words), "runs")
    holds_word = lambda x: x.rlike(WORD)
    joined = (
        rows.join(runs.hint("merge"), "_row", "left")
        .withColumn("_split", F.split("text", "\n"))
        .withColumn("_all", F.sequence(F.lit(0), F.size("_split") - 1))
        .withColumn("_worded", F.filter("_all", lambda i: holds_word(F.get("_split", i))))
        .withColumn(
            "_gone",
            F.flatten(F.transform("_runs", lambda r: F.slice("_worded", r["first"] + 1, r["last"] - r["first"] + 1))),
        )
        .withColumn("_left", F.array_except("_all", "_gone"))
        .withColumn("_kept", F.transform("_left", lambda i: F.get("_split", i)))
    )
    out = joined.withColumn("_lines", F.when(F.col("text").isNull(), 0).otherwise(F.size("_worded")))
    out = out.withColumn(
        "_deleted", F.when(F.col("_kept").isNull(), 0).otherwise(F.size("_gone"))
    ).withColumn("text", F.when(F.col("_kept").isNull(), F.col("text")).otherwise(F.array_join("_kept", "\n")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], "_lines", "_deleted")


def op6_line_runs(spark, sf_dir):
    found = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", F.col("_lines").alias("n_lines"), F.col("_deleted").alias("n_deleted"), "text"
    )


OP6_SQL = r"""
with split as (
    select doc_id, string_split(text, chr(10)) as l from documents where text is not null
), lines as (
    select doc_id, unnest(l) as line, unnest(range(len(l))) as place from split
), bare as (
    select *, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) as name from lines
), marked as (
    select *, name <> '' and row_number() over (partition by name order by doc_id, place) > 1 as gone from bare
), kept as (
    select doc_id, count(*) filter (name <> '') as n_lines, count(*) filter (gone) as n_deleted,
        coalesce(string_agg(line, chr(10) order by place) filter (not gone), '') as left_over
    from marked group by doc_id
)
select d.doc_id, coalesce(n_lines, 0)::integer as n_lines, coalesce(n_deleted, 0)::integer as n_deleted, k.left_over as text
from documents d left join kept k on d.doc_id = k.doc_id
"""

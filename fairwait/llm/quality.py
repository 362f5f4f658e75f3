"""Quality rules, line first: lines that fail are removed, then documents that lose too much."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairwait.llm.common import SPACE, WORD, table

LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
MOST_LOST_PERCENT = 30
MOST_MARKED_PERCENT = 20
SHORT_LINE = 5
SYMBOLS = "#*$%&|<>"

# Fixed words of notices and navigation; a line that holds one is no prose.
BOILERPLATE = (
    r"(?i)\b(lorem ipsum|javascript|cookie policy|uses cookies|privacy policy|terms of (use|service)"
    r"|all rights reserved|sign up|log ?in|subscribe|click here|read more|share this)\b"
)
# Separators of menus and trails, and words that are signs or end in several of them.
NAVIGATION = r"(?<![^\x20\x09-\x0D])[|>»›•·/]+(?![^\x20\x09-\x0D])"
# A run is taken from its start and as a whole, so that a long one is read once.
MARKED = r"(?<![#*$%&|<>!?])[#*$%&|<>!?]{2,}+(?![^\x20\x09-\x0D])"
ENDS = r"""[.!?:;…。！？]["'”’»)\]]*[\x20\x09-\x0D]*$"""


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def line_passes(line: Column) -> Column:
    """Whether one line is prose.

    * Punctuation: it ends a sentence, or it is long enough to be a part of one.
    * Signs: at most a fifth of its words end in a run of signs or exclamation marks.
    * Navigation: at most a fifth of its words are separators.
    * Boilerplate: a short line holds none of the fixed phrases.
    """
    words = F.regexp_count(line, F.lit(WORD))
    marked = F.regexp_count(line, F.lit(MARKED)) + F.regexp_count(line, F.lit(NAVIGATION))
    ends = line.rlike(ENDS) | (words >= SHORT_LINE)
    notice = (words <= 4 * SHORT_LINE) & line.rlike(BOILERPLATE)
    return ends & (marked * 100 <= words * MOST_MARKED_PERCENT) & ~notice


def judged(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measures of the rules and two verdicts, ``base_failed`` and ``kept``.

    * NULL, empty and blank text has no words and fails. Lines without a word neither pass nor fail.
    * All measures are per row: repeated rows, repeated ids and NULL ids change nothing, and an
      empty table gives an empty table. Added names start with an underscore, apart from the digest.
    * Nothing is shuffled. A document's words, windows and lines are arrays of its own row; its
      repeated windows are found by sorting them with their positions, and only where the
      number of distinct windows says that there are any.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    measured = (
        docs.withColumn("_body", body)
        .withColumn("_words", words_of(F.col("_body")))
        .withColumn("_n", F.size("_words").cast("long"))
        .withColumn(
            "_windows",
            F.when(
                F.col("_n") >= 3,
                F.transform(
                    F.slice("_words", 1, F.greatest(F.col("_n") - 2, F.lit(0)).cast("int")),
                    lambda w, i: F.concat_ws(" ", w, F.get("_words", i + 1), F.get("_words", i + 2)),
                ),
            ).otherwise(F.array().cast("array<string>")),
        )
        .withColumn("_repeats", F.size(F.array_distinct("_windows")) < F.size("_windows"))
        .withColumn(
            "_sorted",
            F.when(
                F.col("_repeats"),
                F.sort_array(
                    F.transform("_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))
                ),
            ),
        )
        .withColumn(
            "_starts",
            F.when(
                F.col("_repeats"),
                F.sort_array(
                    F.transform(
                        F.filter(
                            "_sorted",
                            lambda x, k: (x["w"] == F.get("_sorted", k - 1)["w"])
                            | (x["w"] == F.get("_sorted", k + 1)["w"]),
                        ),
                        lambda x: x["i"],
                    )
                ),
            ),
        )
        .withColumn(
            "n_repeat_words",
            F.coalesce(
                F.aggregate(
                    F.transform(
                        "_starts",
                        lambda s, k: F.least(
                            F.lit(3), F.coalesce(F.get("_starts", k + 1) - s, F.lit(3))
                        ),
                    ),
                    F.lit(0).cast("long"),
                    lambda total, x: total + x,
                ),
                F.lit(0).cast("long"),
            ),
        )
        .drop("_windows", "_sorted", "_starts", "_repeats")
        .withColumn("_lines", F.filter(F.split("_body", "\n"), lambda x: x.rlike(WORD)))
    )
    lost = F.aggregate(
        F.filter("_lines", lambda x: ~line_passes(x)),
        F.lit(0),
        lambda total, x: total + F.regexp_count(x, F.lit(WORD)),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED_PERCENT
    )
    return (
        measured.withColumn("n_words", F.col("_n"))
        .withColumn("word_chars", F.length(F.regexp_replace("_body", SPACE, "")).cast("long"))
        .withColumn(
            "n_symbols",
            (F.length("_body") - F.length(F.translate("_body", SYMBOLS, ""))).cast("long"),
        )
        .withColumn(
            "n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long")
        )
        .withColumn("_lost", lost.cast("long"))
        .withColumn("base_failed", failed)
        .withColumn(
            "kept",
            ~F.col("base_failed") & (F.col("_lost") * 100 <= F.col("n_words") * MOST_LOST_PERCENT),
        )
    )


def cleaned(docs: DataFrame) -> DataFrame:
    """Documents that the rules keep, without the lines that fail; blank lines stay.

    ``n_chars``, where present, is counted again. Other columns keep their values, whatever their names.
    """
    whole = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_input"))
    # The row number keeps the filter above the measures. Pushed below, it would repeat each of
    # them inside the next, which takes the optimizer forever.
    kept = judged(whole).withColumn("_row", F.monotonically_increasing_id()).where("kept and _row >= 0")
    good = F.filter(F.split("_body", "\n"), lambda x: ~x.rlike(WORD) | line_passes(x))
    text = F.array_join(good, "\n")
    columns = [(text if c == "text" else F.col(f"_input.`{c}`")).alias(c) for c in docs.columns]
    out = kept.select(*columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def op10_quality_rules(spark, sf_dir):
    return judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )

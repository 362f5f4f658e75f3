"""Importance resampling towards a target: weights by hashed features, then a distributed radix sort.

Features of all documents and of the target are counted in a fixed number of buckets. The gain of a
bucket is an array that every task scores its documents with. The ranking sorts by score and
doc_id with stable counting passes, from the least digit of the composite key to the greatest (LSD): a pass
counts digits per block of positions, turns the counts into global offsets and sends each row to its
destination. After the last pass the position is the rank.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairwait.llm.common import staged, table

BUCKETS = 10_000
LONGEST = 3  # words in a feature
LEAST_WORDS = 20
PERCENT = 5
DIGIT_BITS = 11  # 2,048 counters per block of positions
BLOCK_ROWS = 1 << 18  # positions per block

# Fixed by the contract: words hold ASCII letters and digits, and everything beyond ASCII.
OTHER = bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))
TO_WORDS = bytes.maketrans(OTHER, b" " * len(OTHER))


def features(text: bytes, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """Number of words, and the buckets of all runs of one to three words, repeats included.

    The checksum of a run is continued from the run without its last word.
    """
    words = text.lower().translate(TO_WORDS).split()
    spaced = [b" " + w for w in words]
    sums = [list(map(crc32, words))]
    for length in range(1, LONGEST):
        sums.append(list(map(crc32, spaced[length:], sums[-1])))
    return len(words), np.array([s for run in sums for s in run], np.int64) % buckets


def feature_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over the whole column ``text``; each task hands over one array of counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                total += np.bincount(features(text.as_py() or b"", buckets)[1], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["bucket", "n"])

    counted = texts.select(F.col("text").cast("binary")).mapInArrow(count, "bucket int, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(documents: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 * ln) of the smoothed share of a bucket in ``target`` over that in ``documents``.

    At most ``buckets`` rows of either side come to the driver.
    """
    sides = []
    for frame in (documents, target):
        counts = np.zeros(buckets, np.int64)
        for bucket, n in feature_counts(frame, buckets).collect():
            counts[bucket] = n
        sides.append(counts.tolist())
    source, wanted = sides
    all_source, all_wanted = sum(source) + buckets, sum(wanted) + buckets
    return np.array(
        [
            math.floor(1000 * math.log(float((t + 1) * all_source) / float((s + 1) * all_wanted)))
            for s, t in zip(source, wanted)
        ],
        np.int64,
    )


def weighted(documents: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) per row of ``documents``."""
    buckets = len(gain)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(1):
                n, held = features(text.as_py() or b"", buckets)
                found.append((n, len(held), int(gain[held].sum())))
            arrays = [pa.array([row[k] for row in found], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", "n_words", "n_features", "weight"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(score, f"doc_id {kind}, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int) -> Column:
    """floor(-1000 * ln(-ln(u))) with u from the first 32 bits of a sha256 of seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    u = (h + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln(u))).cast("long")


def digits_of(rows: DataFrame, keys: list[str], digit_bits: int) -> list[Column]:
    """The digits of the composite key, the least first: those bits in which a key differs between rows.

    Longs are read without sign after their sign bit is turned, which keeps their order.
    """
    ends = rows.agg(*[F.struct(F.min(k), F.max(k)).alias(k) for k in keys]).first()
    digits = []
    for key in reversed(keys):
        low, high = ends[key]
        unsigned = F.col(key).bitwiseXOR(F.lit(-(1 << 63)))
        for shift in range(0, ((low ^ high) & ((1 << 64) - 1)).bit_length(), digit_bits):
            digit = F.shiftrightunsigned(unsigned, shift).bitwiseAND(F.lit((1 << digit_bits) - 1))
            digits.append(digit.cast("int"))
    return digits


def radix_ranks(
    rows: DataFrame, keys: list[str], digit_bits: int = DIGIT_BITS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``rows`` with ``position`` from 0 in ascending order of ``keys``, the first one leading; rows with equal keys
    stay in the order of the column ``at``.

    ``keys`` are long without NULL, ``at`` is any distinct number from 0. There are as many passes as the bits in which keys differ
    need. In a pass rows are dealt by (block of positions, digit), so a digit that all rows share is as many groups as there are
    blocks. A group counts its rows; the offset of a group is the number of rows with a smaller digit, and with
    the same digit in earlier blocks; offset and place in the group are the destination.
    """
    rows = staged(rows.withColumn("position", F.col("at")), "radix")
    if rows.isEmpty():
        return rows
    block = F.shiftright("position", 33)  # the partitions that ``at`` was numbered in
    for digit in digits_of(rows, keys, digit_bits) or [F.lit(0)]:
        dealt = rows.select("*", digit.alias("digit"), block.alias("block"))
        sizes = staged(dealt.groupBy("block", "digit").agg(F.count("*").alias("n")), "histogram")
        # One row per digit, 2^digit_bits at most.
        digit_sizes = sizes.groupBy("digit").agg(F.sum("n").alias("n"))
        smaller = Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
        before = digit_sizes.select("digit", F.coalesce(F.sum("n").over(smaller), F.lit(0)).alias("smaller"))
        earlier = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        offsets = (
            sizes.withColumn("same", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
            .join(F.broadcast(before), "digit")
            .select("block", "digit", (F.col("smaller") + F.col("same")).alias("offset"))
        )
        place = F.row_number().over(Window.partitionBy("block", "digit").orderBy("position")) - F.lit(1)
        placed = dealt.withColumn("place", place).join(offsets.hint("merge"), ["block", "digit"])
        moved = placed.withColumn("position", F.col("offset") + F.col("place"))
        rows = staged(moved.select(*rows.columns), "radix")
        block = F.floor(F.col("position") / F.lit(block_rows)).cast("long")
    return rows


def resampled(
    documents: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = 42,
    buckets: int = BUCKETS,
    digit_bits: int = DIGIT_BITS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Every row of ``documents`` (doc_id as a whole number, text) as doc_id, n_words, n_features, weight, score and rank.

    * ``rank`` counts from 1 over the ``percent`` of documents with ``least_words`` words or more that are drawn:
      highest scores first, ties to the smaller doc_id. It is NULL for others.
    * The score is the weight and Gumbel noise from doc_id and ``seed``, so draws are without replacement and
      in proportion to exp(weight / 1000), and reruns agree.
    * NULL, empty and blank texts have no words, no features and weight 0. Rows that repeat a doc_id are rows of their
      own and draw the same noise; those with equal scores keep the order in which they are read. A NULL doc_id draws with the empty id and comes
      first in ties. Empty documents give no row; with an empty target all counts of it are 0.
    * Other columns are not read, whatever their names.
    """
    found = weighted(documents, gains(documents, target, buckets)).withColumn("at", F.monotonically_increasing_id())
    rows = staged(found.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "weights")
    able = rows.where(F.col("n_words") >= least_words)
    n, highest = able.agg(F.count("*"), F.max("score")).first()
    drawn = percent * n // 100
    key = able.select(
        "at",
        (F.lit(highest).cast("long") - F.col("score")).alias("below"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"),
    )
    ranked = radix_ranks(key, ["below", "id"], digit_bits, block_rows).where(F.col("position") < drawn)
    ranks = ranked.select("at", (F.col("position") + F.lit(1)).alias("rank"))
    return rows.join(ranks.hint("merge"), "at", "left").drop("at")


def op12_importance_resampling(spark, sf_dir):
    documents, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return resampled(documents, target).select("doc_id", "n_features", "weight", "score", "rank")

"""What several operators of this package need: tables, staged results, connected components."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairwait.session import shared_path

# Fixed by the contract: words are runs of anything but these six characters.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

BATCH_BYTES = 8 << 20  # texts that go to a Python worker at once; it and the JVM hold a batch or two beside their work


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later steps neither repeat its
    work after a lost executor nor see other rows than the first reader."""
    path = shared_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def batches_of(spark: SparkSession, size: int) -> Iterator[None]:
    """Arrow batches of ``size`` bytes at most, or of what the session says where that is less, as long as it lasts."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    bound = int(before.rstrip("bB")) if before.rstrip("bB").lstrip("-").isdigit() else None
    if bound is not None and 0 < bound <= size:
        yield
        return
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def parts_for(size: int | None, each: int = 16 << 20, most: int = 20_000) -> int:
    """Partitions for ``size`` bytes; beyond ``most`` they grow, and sort with spilling."""
    return max(1, min(math.ceil((size or 0) / each), most))


def width(spark: SparkSession, size: int | None) -> int:
    """Partitions of a shuffle of ``size`` bytes: those of the session, and more where they would pass 64 MB each."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), parts_for(size, 64 << 20))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (src, dst; any order, repeats allowed);
    the component is the smallest node reachable.

    Alternates two contractions until nothing changes: every node hands its larger neighbours,
    then its smaller ones, to the smallest node it sees. What remains is one star per component.
    Minima are aggregated before the shuffle and joined back, so a node with very many
    neighbours is never a group in one task. Each round is written to the shared folder; the
    number of rounds grows with the logarithm of the longest chain.
    """
    pairs = edges.select(
        F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")
    ).where("u <> v")
    pairs = staged(pairs.distinct(), "components")
    seen = None
    for _ in range(rounds):
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return (
                pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
                .union(pairs.select(F.col("v"), F.col("v")))
                .distinct()
            )
        seen = state
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        larger = _to_least(both, both.where("v > u")).distinct()
        larger = staged(larger.where("u <> v"), "components")
        smaller = _to_least(larger, larger)
        pairs = staged(
            smaller.where("u <> v").union(larger.groupBy("u").agg(F.min("v"))).distinct(), "components"
        )
    raise RuntimeError(f"components not settled after {rounds} rounds")


def _to_least(edges: DataFrame, moved: DataFrame) -> DataFrame:
    """``moved`` with each neighbour v of u handed to the smallest node among u and its neighbours.

    The minima are written before they are joined. Both sides of the join are then plain
    shuffles, which Spark can split where a node has very many neighbours.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    least = staged(least.select("u", F.least("u", "m").alias("m")), "components")
    return moved.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def in_pieces(members: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """``members`` (id, keys) of groups with more than one row, dealt for comparison within groups.

    A group of more than ``rows`` rows is cut in pieces by a hash of the id, and each pair of
    pieces, a piece with itself included, is a task's business of its own: ``low`` and
    ``high`` name the pair, ``piece`` the row's own piece. Smaller groups are one pair, (0, 0).
    """
    pieces = F.ceil(F.col("_rows") / F.lit(rows)).cast("int")
    sizes = members.groupBy(*keys).agg(F.count("*").alias("_rows")).where("_rows > 1")
    sizes = staged(sizes.select(*keys, pieces.alias("_pieces")), "pieces")
    return (
        members.join(sizes, keys)
        .withColumn("piece", F.pmod(F.xxhash64("id"), F.col("_pieces")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)))
        .withColumn("low", F.least("piece", "_other"))
        .withColumn("high", F.greatest("piece", "_other"))
        .drop("_pieces", "_other")
    )


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[dict[str, list]]:
    """Groups of consecutive rows with equal ``keys``, across batches: values by column."""
    rest: dict[str, list] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = {
            name: rest.get(name, []) + batch.column(k).to_pylist() for k, name in enumerate(batch.schema.names)
        }
        rows = list(zip(*[columns[k] for k in keys]))
        bounds = [0] + [i for i in range(1, len(rows)) if rows[i] != rows[i - 1]]
        for start, end in zip(bounds, bounds[1:]):
            yield {name: values[start:end] for name, values in columns.items()}
        rest = {name: values[bounds[-1] :] for name, values in columns.items()}
    if rest:
        yield rest


class Forest:
    """Groups of the numbers 0 to n - 1, each with its smallest number as root."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        self.up[max(a, b)] = min(a, b)

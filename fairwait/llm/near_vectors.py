"""Near-duplicate embeddings: Euclidean p-stable hashing in several tables, exact cosines within buckets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from fairwait.llm.common import Forest, components, in_pieces, runs, staged, table

LEAST_COSINE = 0.95
TABLES = 28
PROJECTIONS = 8
WIDTH = 1.5  # of a bucket, for vectors of length one
SEED = 7
BUCKET_ROWS = 2_048  # larger buckets are split and compared piece by piece


def unit_rows(vectors: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length one as rows, and which of the input they are.

    Left out: NULL, empty and zero vectors, and those with NULL or non-finite components. Vectors
    are scaled by their largest component first, so squares neither overflow nor vanish.
    """
    rows, where = [], []
    for i, vector in enumerate(vectors):
        if vector.is_valid and len(vector.values) and not vector.values.null_count:
            row = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
            top = np.abs(row).max()
            if np.isfinite(top) and top > 0:
                row = row / top
                rows.append(row / np.sqrt((row * row).sum()))
                where.append(i)
    return rows, np.array(where, np.int64)


def hashes(rows: list[np.ndarray], seed: int, tables: int, projections: int, width: float) -> np.ndarray:
    """A bucket per row and table: the quantised projections, mixed to one number.

    Vectors of another length have projections of their own, and never meet.
    """
    out = np.zeros((len(rows), tables), np.int64)
    sizes = np.array([len(r) for r in rows])
    for size in np.unique(sizes):
        rng = np.random.default_rng([seed, int(size)])
        directions = rng.standard_normal((int(size), tables * projections))
        shifts = rng.uniform(0, width, tables * projections)
        odd = rng.integers(1, 2**62, (tables, projections + 1), dtype=np.int64) * 2 + 1
        own = np.flatnonzero(sizes == size)
        for some in np.array_split(own, len(own) // 4096 + 1):
            cells = np.floor((np.stack([rows[i] for i in some]) @ directions + shifts) / width)
            cells = cells.astype(np.int64).reshape(len(some), tables, projections)
            mixed = (cells * odd[:, :projections]).sum(axis=2) + odd[:, projections]
            out[some] = mixed ^ (mixed >> 29)
    return out


def compare(ids, units, signatures, weights, at: int, pieces: np.ndarray, least: float):
    """Links within one bucket: per row the number that it has, and edges that connect them.

    A pair counts in the first table in which it meets. In a bucket cut in pieces, the
    rows here are of one piece or of two, and only pairs across are compared. Rows are
    taken some at a time, and no pair is returned: edges form a forest.
    """
    n = len(ids)
    links, forest = np.zeros(n, np.int64), Forest(n)
    two = pieces.min() != pieces.max()
    for low in range(0, n, 512):
        high = min(n, low + 512)
        near = units[low:high] @ units[low:].T >= least
        near &= np.arange(low, high)[:, None] < np.arange(low, n)[None, :]
        if two:
            near &= pieces[low:high, None] != pieces[None, low:]
        if not near.any():
            continue
        rows, columns = np.nonzero(near)
        # The product of a matrix may differ in the last bit; the sum of products decides.
        left, right = units[rows + low], units[columns + low]
        exact = (left * right).sum(axis=1) >= least
        rows, columns = rows[exact] + low, columns[exact] + low
        for a, b in zip(rows.tolist(), columns.tolist()):
            if forest.root(a) != forest.root(b):
                forest.join(a, b)
        first = ~(signatures[rows, :at] == signatures[columns, :at]).any(axis=1)
        np.add.at(links, rows[first], weights[columns[first]])
        np.add.at(links, columns[first], weights[rows[first]])
    return links, [(ids[i], ids[forest.root(i)]) for i in range(n) if forest.root(i) != i]


def linked(
    vectors: DataFrame,
    least: float = LEAST_COSINE,
    tables: int = TABLES,
    projections: int = PROJECTIONS,
    width: float = WIDTH,
    seed: int = SEED,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, any others): vec_id, n_links, component_id.

    * Two vectors are linked when their cosine is ``least`` or more, in double precision. Pairs
      are found when they share a bucket in one of the tables: with the values above 99.9 %
      of pairs at 0.95 and practically all of closer ones; none below is linked.
    * Vectors that are NULL, empty or zero, or hold a NULL or non-finite component, link with
      nothing. Equal vectors are one class that is compared once; its members link each other.
    * Rows with a NULL vec_id are returned without links. Rows that repeat a vec_id are rows of their own for
      the count, and one node for the component. An empty table gives an empty one.

    A table multiplies the vectors by random directions and cuts each product into cells; the
    cells of all directions are the bucket. A bucket of more rows than ``bucket_rows`` is cut in
    pieces by a hash, and each pair of pieces is a group of its own, so no task holds more than two
    pieces. Buckets return counts and the edges of a forest, never all pairs.
    """
    spark = vectors.sparkSession
    classes = staged(
        vectors.where("vec_id is not null")
        .groupBy("embedding")
        .agg(F.min("vec_id").alias("id"), F.count("*").alias("members")),
        "vectors",
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, where = unit_rows(batch.column(1))
            if len(rows):
                found = hashes(rows, seed, tables, projections, width)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(where)),
                        batch.column(2).take(pa.array(where)),
                        pa.array([r.tobytes() for r in rows], pa.binary()),
                        pa.array(found.tolist(), pa.list_(pa.int64())),
                    ],
                    names=["id", "members", "unit", "signature"],
                )

    id_type = vectors.schema["vec_id"].dataType.simpleString()
    signed = staged(
        classes.select("id", "embedding", "members").mapInArrow(
            sign, f"id {id_type}, members long, unit binary, signature array<long>"
        ),
        "signatures",
    )
    placed = signed.select("id", F.posexplode("signature").alias("at", "bucket"))
    groups = in_pieces(placed, ["at", "bucket"], bucket_rows).join(signed, "id")
    keys = ["at", "bucket", "low", "high"]

    kind = to_arrow_type(vectors.schema["vec_id"].dataType)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, keys):
            ids, piece = rows["id"], np.array(rows["piece"])
            alone = rows["low"][0] < rows["high"][0] and piece.min() == piece.max()
            if len(ids) < 2 or alone or len(set(map(len, rows["unit"]))) > 1:
                continue
            units = np.frombuffer(b"".join(rows["unit"]), np.float64).reshape(len(ids), -1)
            signatures = np.array(rows["signature"], np.int64)
            weights = np.array(rows["members"], np.int64)
            links, edges = compare(ids, units, signatures, weights, rows["at"][0], piece, least)
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids[i] for i in some] + [a for a, _ in edges], kind),
                    pa.array(links[some].tolist() + [0] * len(edges), pa.int64()),
                    pa.array([None] * len(some) + [b for _, b in edges], kind),
                ],
                names=["id", "links", "to"],
            )

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = staged(
        groups.repartition(parts, *keys)
        .sortWithinPartitions(*keys)
        .select("id", "piece", "members", "unit", "signature", *keys)
        .mapInArrow(meet, f"id {id_type}, links long, to {id_type}"),
        "links",
    )
    counts = found.where("to is null").groupBy("id").agg(F.sum("links").alias("links"))
    joined = components(found.where("to is not null").select(F.col("id").alias("src"), F.col("to").alias("dst")))
    sound = signed.select("id", F.lit(True).alias("sound"))
    by_class = (
        classes.join(sound, "id", "left")
        .join(counts, "id", "left")
        .join(joined.withColumnRenamed("node", "id"), "id", "left")
        .select(
            F.col("embedding").alias("_embedding"),
            F.when(F.col("sound"), F.col("members") - 1 + F.coalesce("links", F.lit(0)))
            .otherwise(0)
            .alias("_links"),
            F.when(F.col("sound"), F.coalesce("component", "id")).alias("_component"),
        )
    )
    return (
        vectors.join(
            by_class,
            F.col("embedding").eqNullSafe(F.col("_embedding")) & F.col("vec_id").isNotNull(),
            "left",
        )
        .select(
            "vec_id",
            F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("_component", "vec_id").alias("component_id"),
        )
    )


def op1_near_vectors(spark, sf_dir):
    found = linked(table(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


OP1_SQL = r"""
with recursive vectors as (
    select vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings
    where embedding is not null and len(embedding) > 0
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), units as (
    select vec_id, list_transform(e, lambda x: x / sqrt(list_inner_product(e, e))) as u from vectors
    where list_inner_product(e, e) > 0
), links as (
    select a.vec_id as i, b.vec_id as j from units a join units b on a.vec_id <> b.vec_id
    where list_inner_product(a.u, b.u) >= 0.95
), reached as (
    select vec_id as node, vec_id as seen from embeddings
    union
    select r.node, l.j from reached r join links l on r.seen = l.i
), components as (
    select node, min(seen) as component_id from reached group by node
)
select e.vec_id, (select count(*) from links l where l.i = e.vec_id) as n_links, c.component_id, e.vec_id = c.component_id as kept
from embeddings e join components c on c.node = e.vec_id
"""

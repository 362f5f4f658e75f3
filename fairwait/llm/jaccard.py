"""Joining documents whose sets of shingles overlap: points of group counts, bounds by minima, exact checks.

A document is the set of its 5-word shingles. Hashing deals the shingles into groups, and the
counts per group are a point. Two sets share at most the sum of the smaller counts over all groups,
which bounds their similarity from above.

The index is dealt over the cluster by equal coordinates: the groups of two similar documents
differ in fewer places than there are, so they agree, content and all, in one of the groups that each lists.
Documents that list the same group are candidates. A tree of points, packed by size and bounded by
the largest counts below each node, finds the pairs of candidates whose bound suffices; these
are compared by their shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from fairwait.llm.common import BATCH_BYTES, batches_of, components, in_pieces, staged, table, width

WORDS = 5
# 100 * intersection >= 80 * union, in terms of the two sizes: 9 * intersection >= 4 * (a + b).
SINGLES = 32  # smaller sets list shingles instead of groups
MANY_COPIES = 256
CELL_ROWS = 2_048
LEAF = 32
OWN_CELLS = 64  # a pair is compared in the first cell of both; beyond so many, perhaps again
FEW = 8  # rows that are compared without a tree
TREE_GROUPS = 256  # of the tree; pairs that it leaves are bounded again by their full points
FULL = 255

_random = np.random.default_rng(5)
BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE[65:91] = BYTE[97:123]  # A-Z as a-z
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
STEP = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(int(STEP), -1, 2**64))
PLACE = _random.integers(1, 2**63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit hash of 64-bit numbers."""
    x = x + np.uint64((salt * int(STEP)) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class Shingles:
    """Hashed shingle sets of texts. Powers are kept for the longest text so far."""

    def __init__(self):
        self.up = powers(STEP, 1 << 16)
        self.down = powers(BACK, 1 << 16)

    def words(self, data: bytes) -> np.ndarray:
        """A hash per word: a polynomial of its bytes, taken from running sums over the text."""
        text = np.frombuffer(data, np.uint8)
        if len(text) >= len(self.up):
            self.up, self.down = powers(STEP, 2 * len(text)), powers(BACK, 2 * len(text))
        space = IS_SPACE[text]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
        start, end = edge[::2], edge[1::2]
        sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(BYTE[text] * self.up[: len(text)], out=sums[1:])
        return mixed((sums[end] - sums[start]) * self.down[start])

    def __call__(self, text: str | None) -> np.ndarray:
        """Distinct shingles in ascending order; all words as one where there are fewer than five."""
        words = self.words((text or "").encode("utf-8", "surrogatepass"))
        n = len(words)
        if not n:
            return words
        k = min(n, WORDS)
        total = np.zeros(n - k + 1, np.uint64)
        for i in range(k):
            total += words[i : n - k + 1 + i] * PLACE[i]
        return np.unique(mixed(total, k))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    if not len(a) or not len(b):
        return False
    small, large = (a, b) if len(a) < len(b) else (b, a)
    if 9 * len(small) < 4 * (len(a) + len(b)):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    return 9 * int((large[at] == small).sum()) >= 4 * (len(a) + len(b))


def listed(shingles: np.ndarray) -> np.ndarray:
    """The cells in which a set may meet similar ones.

    Similar sets differ in at most a quarter of the shingles of either, d. A set of n shingles is
    cut in 2^k groups, 2^k the power of two up to n. Of its filled groups at most d differ from
    the other set's. Taken in an order that depends on the content alone, the first group
    that is equal comes after at most d others in both sets, so d + 1 groups are enough. The
    fullest come first, which says the most. A set also lists the groups of the next
    smaller power if sets of that size can be similar to it. Below 32 shingles each is a group.

    The argument needs more than d filled groups. From 32 shingles on a set has fewer with a
    probability below 1e-11, for a hash that does not depend on the data.
    """
    n, d = len(shingles), len(shingles) // 4
    cells = []
    least = -(-4 * n // 5)
    k = n.bit_length() - 1
    for bits in {k, least.bit_length() - 1} if n else ():
        if 1 << bits < SINGLES:
            cells.append(mixed(shingles[: d + 1], 99))
            break
    for bits in {k, least.bit_length() - 1} if n else ():
        if 1 << bits >= SINGLES:
            group = shingles & np.uint64((1 << bits) - 1)
            order = np.argsort(group, kind="stable")
            starts = np.flatnonzero(np.diff(group[order], prepend=np.uint64(2**64 - 1)))
            content = np.add.reduceat(mixed(shingles[order], 1), starts)
            count = np.diff(np.append(starts, n))
            first = np.lexsort((content, -count))[: d + 1]
            cells.append(mixed(content[first], bits + 100))
    return np.concatenate(cells) if cells else shingles


def point(shingles: np.ndarray) -> np.ndarray:
    """Counts per group. There are about as many groups as shingles, so that what two sets do
    not share seldom falls together and the bound is close."""
    size = 1 << max(5, min(14, len(shingles).bit_length() - 1))
    counts = np.bincount((shingles & np.uint64(size - 1)).astype(np.int64), minlength=size)
    return np.minimum(counts, FULL).astype(np.uint8)


def folded(points: list[np.ndarray], most: int = 1 << 14) -> np.ndarray:
    """Points as rows with as many groups as the coarsest of them, ``most`` at most.

    Groups are low bits, so they add up. A full count bounds nothing and is taken as without limit.
    """
    size = min(most, *map(len, points))
    return np.stack(
        [np.where(p == FULL, 1 << 30, p.astype(np.int64)).reshape(-1, size).sum(axis=0) for p in points]
    )


def overlap(p: np.ndarray, q: np.ndarray) -> int:
    """The sum of the smaller counts: two sets share no more."""
    if len(p) != len(q) or p.max() == FULL or q.max() == FULL:
        p, q = folded([p, q])
    return int(np.minimum(p, q).sum(dtype=np.int64))


class Tree:
    """Points packed by size into leaves; a node keeps the largest count per group below it.

    The sum of minima of a point and a node's counts bounds that of all points below.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.order = np.argsort(sizes, kind="stable")
        self.points = points[self.order]
        self.sizes = sizes[self.order]
        self.levels = []
        top, largest = self.points, self.sizes
        while len(top) > 1:
            starts = np.arange(0, len(top), LEAF)
            top = np.maximum.reduceat(top, starts)
            smallest = np.minimum.reduceat(self.sizes if not self.levels else self.levels[-1][2], starts)
            largest = np.maximum.reduceat(largest, starts)
            self.levels.append((top, largest, smallest))

    def near(self, i: int) -> np.ndarray:
        """Places after ``i``, in order of size, whose bound suffices for similarity with ``i``."""
        query, size = self.points[i], self.sizes[i]
        nodes = np.arange(len(self.levels[-1][0])) if self.levels else np.arange(len(self.points))
        for depth in range(len(self.levels) - 1, -1, -1):
            top, largest, smallest = self.levels[depth]
            bound = np.minimum(top[nodes], query).sum(axis=1)
            nodes = nodes[
                (9 * bound >= 4 * (size + np.maximum(smallest[nodes], size))) & (9 * largest[nodes] >= 4 * (size + largest[nodes]))
            ]
            below = len(self.levels[depth - 1][0]) if depth else len(self.points)
            nodes = (nodes[:, None] * LEAF + np.arange(LEAF)).ravel()
            nodes = nodes[nodes < below]
        nodes = nodes[nodes > i]
        bound = np.minimum(self.points[nodes], query).sum(axis=1)
        return nodes[9 * bound >= 4 * (size + self.sizes[nodes])]


def measured(docs: DataFrame) -> DataFrame:
    """(id, n, digest, point, cells) per row of ``docs``; the digest tells sets apart."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in batches:
            sizes, digests, points, cells = [], [], [], []
            for text in batch.column(1):
                found = shingles(text.as_py())
                sizes.append(len(found))
                digests.append(
                    np.array([len(found), mixed(found, 7).sum(), mixed(found, 8).sum()], np.uint64).tobytes()
                )
                points.append(point(found).tobytes() if len(found) else None)
                cells.append(listed(found).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(points, pa.binary()),
                    pa.array(cells, pa.list_(pa.int64())),
                ],
                names=["id", "n", "digest", "point", "cells"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        measure, f"id {kind}, n long, digest binary, point binary, cells array<long>"
    )


def shared_cells(sets: DataFrame, id_type: str) -> DataFrame:
    """(cell, first, id) for every listing of a cell that another document lists too; ``first`` is
    the smallest id of the cell. Rows of a cell stream by in order, none is collected."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row, while it may be the only one of its cell
        last_cell, first_id = None, None
        for batch in batches:
            cells, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            if not len(cells):
                continue
            if held is not None:
                cells, ids = np.append(held[0], cells), np.append(held[1], ids)
            new = np.append(True, cells[1:] != cells[:-1])
            starts = np.flatnonzero(new)
            first = np.repeat(ids[starts], np.diff(np.append(starts, len(cells))))
            if held is None and cells[0] == last_cell:
                first[: starts[1] if len(starts) > 1 else len(cells)] = first_id
            shared = ~(new & np.append(new[1:], True))
            if held is None and cells[0] == last_cell:
                shared[0] = True
            single = not shared[-1]  # may go on in the next batch
            held = (cells[-1], ids[-1]) if single else None
            last_cell, first_id = cells[-1], first[-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells[shared]), pa.array(first[shared]), pa.array(ids[shared])],
                names=["cell", "first", "id"],
            )

    listings = sets.agg(F.sum(F.size("cells"))).first()[0]
    parts = width(sets.sparkSession, 24 * (listings or 0))
    return (
        sets.select(F.explode("cells").alias("cell"), "id")
        .repartition(parts, "cell")
        .sortWithinPartitions("cell", "id")
        .mapInArrow(members, f"cell long, first {id_type}, id {id_type}")
    )


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (src, dst) whose texts are similar."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in batches:
            keep = [
                similar(shingles(a.as_py()), shingles(b.as_py())) for a, b in zip(batch.column(2), batch.column(3))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).filter(pa.array(keep, pa.bool_())) for k in (0, 1)], names=["src", "dst"]
            )

    kind = pairs.schema["src"].dataType.simpleString()
    texts = docs.select("doc_id", "text")
    return (
        pairs.join(texts.toDF("src", "a"), "src")
        .join(texts.toDF("dst", "b"), "dst")
        .select("src", "dst", "a", "b")
        .mapInArrow(check, f"src {kind}, dst {kind}")
    )


def bounded(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (src, dst) that sizes and points allow; ``same`` where the sets are equal."""

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n, p, m, q in zip(*[batch.column(k).to_pylist() for k in range(3, 7)]):
                ok = 9 * min(n, m) >= 4 * (n + m)
                if ok:
                    shared = overlap(np.frombuffer(p, np.uint8), np.frombuffer(q, np.uint8))
                    ok = 9 * shared >= 4 * (n + m)
                keep.append(ok)
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).filter(pa.array(keep, pa.bool_())) for k in range(3)], names=["src", "dst", "same"]
            )

    kind = pairs.schema["src"].dataType.simpleString()
    side = lambda id, n, digest, p: sets.select("id", "n", "digest", "point").toDF(id, n, digest, p)
    return (
        pairs.join(side("src", "n", "d", "p"), "src")
        .join(side("dst", "m", "e", "q"), "dst")
        .select("src", "dst", (F.col("d") == F.col("e")).alias("same"), "n", "p", "m", "q")
        .mapInArrow(bound, f"src {kind}, dst {kind}, same boolean")
    )


def cell_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[dict[str, list]]:
    """Groups of consecutive rows with equal ``keys``, across batches, as ``runs`` gives them; lists stay arrays."""
    rest: dict[str, list] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = {}
        for name, column in zip(batch.schema.names, batch.columns):
            if pa.types.is_list(column.type):
                values, ends = column.values.to_numpy(), column.offsets.to_numpy()
                held = [values[start:end] for start, end in zip(ends.tolist(), ends[1:].tolist())]
            else:
                held = column.to_pylist()
            columns[name] = rest.get(name, []) + held
        rows = list(zip(*[columns[k] for k in keys]))
        bounds = [0] + [i for i in range(1, len(rows)) if rows[i] != rows[i - 1]]
        for start, end in zip(bounds, bounds[1:]):
            yield {name: values[start:end] for name, values in columns.items()}
        rest = {name: values[bounds[-1] :] for name, values in columns.items()}
    if rest:
        yield rest


def across(cells: DataFrame, groups: DataFrame, sets: DataFrame, id_type: str, cell_rows: int) -> DataFrame:
    """Candidate pairs (src, dst) between different components within cells, by the tree.

    A pair that shares many cells is compared in the lowest one. Documents carry their lowest
    cells for that; the lowest cell that two share is never skipped.
    """
    labelled = cells.select("cell", "id").join(groups.select(F.col("node").alias("id"), "component"), "id", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "id"))
    # Documents that share much share many cells; of cells with the same rows one is enough.
    mixed_cells = (
        labelled.groupBy("cell")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.count("*").alias("rows"),
            F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("one"),
            F.sum(F.xxhash64("id", F.lit(1)).cast("decimal(38,0)")).alias("two"),
        )
        .where("low <> high")
        .groupBy("rows", "one", "two")
        .agg(F.min("cell").alias("cell"))
        .select("cell")
    )
    left = staged(labelled.join(staged(mixed_cells, "cells"), "cell").distinct(), "candidates")
    # The smallest cells of a document tell in which cell a pair is to be compared.
    lowest = left.groupBy("id").agg(F.slice(F.sort_array(F.collect_set("cell")), 1, OWN_CELLS).alias("own"))
    about = sets.select("id", "n", "point").join(lowest, "id")
    dealt = in_pieces(left, ["cell"], cell_rows).join(about, "id")
    keys = ["cell", "low", "high"]
    kind = to_arrow_type(cells.schema["id"].dataType)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in cell_runs(batches, keys):
            ids, component, piece, sizes = rows["id"], rows["component"], rows["piece"], rows["n"]
            if len(ids) < 2 or component.count(component[0]) == len(component):
                continue
            two, cell, own = rows["low"][0] != rows["high"][0], rows["cell"][0], rows["own"]
            few = len(ids) <= FEW  # a leaf
            if few:
                points = rows["point"]
                order, near = range(len(ids)), lambda i: range(i + 1, len(ids))  # noqa: B023
            else:
                points = [np.frombuffer(p, np.uint8) for p in rows["point"]]
                tree = Tree(folded(points, TREE_GROUPS), np.array(sizes))
                order, near = tree.order.tolist(), lambda i: tree.near(i).tolist()  # noqa: B023
            pairs, lower = [], {}
            for i, a in enumerate(order):
                for b in (order[k] for k in near(i)):
                    n, m = sizes[a], sizes[b]
                    if component[a] == component[b] or 9 * min(n, m) < 4 * (n + m) or two and piece[a] == piece[b]:
                        continue
                    # What a row lists below this cell is made a set when a pair first asks for it.
                    for k in (a, b):
                        if k not in lower:
                            lower[k] = set(own[k][own[k] < cell].tolist())
                    if not lower[a].isdisjoint(lower[b]):
                        continue
                    p, q = (np.frombuffer(points[k], np.uint8) if few else points[k] for k in (a, b))
                    if 9 * overlap(p, q) >= 4 * (n + m):
                        pairs.append((min(ids[a], ids[b]), max(ids[a], ids[b])))
            if pairs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p[k] for p in pairs], kind) for k in (0, 1)], names=["src", "dst"]
                )

    # A row has its point and its own cells, about a kilobyte.
    parts = width(cells.sparkSession, left.count() << 10)
    return (
        dealt.repartition(parts, *keys)
        .sortWithinPartitions(*keys)
        .select("id", "component", "piece", "n", "point", "own", *keys)
        .mapInArrow(search, f"src {id_type}, dst {id_type}")
        .distinct()
    )


def grouped(docs: DataFrame, cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, any others): doc_id, n_shingles, component_id.

    * NULL, empty and blank text has an empty set and is linked with nothing; fewer than five
      words are one shingle. Rows with a NULL doc_id keep a NULL component.
    * Rows that repeat a doc_id are one node, linked by any of their texts; each has a row of its own in the
      result. An empty table gives an empty one.

    First every document is compared with one other, that which comes first in most of its cells.
    What that links is a component, and cells within one component are done: a group of
    copies costs a comparison per copy, not per pair. In the cells that still hold several components, the
    tree searches all pairs across components. Cells of many rows are cut in pieces. Groups of
    many equal sets are represented by one of them; which sets are equal is aggregated before.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    with batches_of(docs.sparkSession, BATCH_BYTES):  # texts, points and pairs of texts; 64 MB at once otherwise
        sets = staged(measured(docs), "shingles")
        known = sets.where("n > 0 and id is not null")
        classes = known.groupBy("digest").agg(F.min("id").alias("least"), F.count("*").alias("members"))
        crowds = staged(classes.where(f"members > {MANY_COPIES}").select("digest", "least"), "crowds")
        with_crowd = known.join(crowds, "digest", "left")
        alone = with_crowd.where("least is null or least = id").drop("least")
        copies = with_crowd.where("least <> id").select(F.col("id").alias("src"), F.col("least").alias("dst"))

        cells = staged(shared_cells(alone, id_type), "cells")
        firsts = (
            cells.where("first <> id")
            .groupBy("id", "first")
            .agg(F.count("*").alias("shared"))
            .groupBy("id")
            .agg(F.max(F.struct("shared", "first"))["first"].alias("src"))
            .select("src", F.col("id").alias("dst"))
        )
        sides = known.select("id", "n", "digest", "point")
        near = staged(bounded(firsts, sides), "bounded")
        sure = near.where("same").select("src", "dst")
        links = staged(verified(near.where("not same"), docs).union(sure).union(copies), "links")
        once = components(links)
        more = staged(verified(staged(across(cells, once, sides, id_type, cell_rows), "across"), docs), "links")
    renamed = more.join(once.toDF("src", "a"), "src", "left").join(once.toDF("dst", "b"), "dst", "left")
    bridges = renamed.select(F.coalesce("a", "src").alias("src"), F.coalesce("b", "dst").alias("dst"))
    joined = components(bridges).toDF("component", "final")
    final = once.unionByName(
        joined.select(F.col("component").alias("node"), "component").join(once, ["node"], "left_anti")
    ).join(joined, "component", "left")
    final = final.select(F.col("node").alias("id"), F.coalesce("final", "component").alias("component"))
    return sets.select("id", "n").join(final, "id", "left").select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"),
    )


def op5_jaccard_join(spark, sf_dir):
    return grouped(table(spark, sf_dir, "documents"))


OP5_SQL = r"""
with recursive worded as (
    select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
    from documents
), listed as (
    select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
        else [array_to_string(w[i : i + 4], ' ') for i in range(1, len(w) - 3)] end) as shingle
    from worded
), shingles as (
    select distinct doc_id, md5_number_lower(shingle) as shingle from listed
), sizes as (
    select doc_id, count(*) as n from shingles group by doc_id
), shared as (
    select a.doc_id as i, b.doc_id as j, count(*) as c
    from shingles a join shingles b on a.shingle = b.shingle and a.doc_id < b.doc_id group by a.doc_id, b.doc_id
), links as (
    select i, j from shared join sizes a on a.doc_id = i join sizes b on b.doc_id = j where 100 * c >= 80 * (a.n + b.n - c)
), edges as (
    select i, j from links union all select j, i from links
), reached as (
    select doc_id as node, doc_id as seen from documents
    union
    select r.node, e.j from reached r join edges e on r.seen = e.i
)
select d.doc_id, coalesce(s.n, 0) as n_shingles, c.component_id
from documents d left join sizes s on s.doc_id = d.doc_id
join (select node, min(seen) as component_id from reached group by node) c on c.node = d.doc_id
"""

"""Substring dedup: of equal windows of words the first stays, and words of later ones go.

Every window of ``WINDOW`` consecutive words gets a Rabin-Karp hash: a polynomial over the hashes of its
words, rolled along a block of texts by differences of prefix sums. Windows leave a block packed, each
hash once, so that a window that a third of all rows repeat is one entry a block. They are dealt by hash,
unpacked, and sorted by Spark, where equal ones are neighbours: one streaming pass counts them and
names all but the first. Overlapping windows to be removed then merge into maximal intervals of
their document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from fairwait.llm.common import parts_for, staged, table
from fairwait.operators.ranks import with_position

WINDOW = 20
BLOCK_WORDS = 750_000  # words that a task hashes at once
MARKS = 1 << 20  # bound on the rows that are broadcast to tell untouched documents

# Odd multipliers of the two polynomials and their inverses, modulo 2^64. They are 3 modulo 8, so that
# powers of them minus one have few factors of two, and words that swap places change the hash.
MULTIPLIERS = (0x9E3779B97F4A7C13, 0xC2B2AE3D27D4EB4B)
INVERSES = tuple(pow(m, -1, 1 << 64) for m in MULTIPLIERS)


def rolling(values: np.ndarray, family: int, window: int) -> np.ndarray:
    """The polynomial of each window: the sum of value[i + j] * m^j, modulo 2^64."""
    n = len(values)
    powers = np.full(n, MULTIPLIERS[family], np.uint64)
    powers[:1] = 1
    np.cumprod(powers, out=powers)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers, out=sums[1:])
    back = np.full(n - window + 1, INVERSES[family], np.uint64)
    back[:1] = 1
    np.cumprod(back, out=back)
    return (sums[window:] - sums[: n - window + 1]) * back


def word_values(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words per text, and two 64-bit hashes per word."""
    numbers: dict[bytes, int] = {}
    sizes, ids = np.zeros(len(texts), np.int64), []
    for i, text in enumerate(texts):
        words = text.split()  # bytes are split at exactly the six characters of the contract
        sizes[i] = len(words)
        ids.append(np.fromiter([numbers.setdefault(w, len(numbers)) for w in words], np.int32, len(words)))
    hashes = b"".join(hashlib.blake2b(w, digest_size=16).digest() for w in numbers)
    values = np.frombuffer(hashes, np.uint64).reshape(-1, 2)
    return sizes, values[np.concatenate(ids)] if ids else np.zeros((0, 2), np.uint64)


def packed_places(rows: np.ndarray, starts: np.ndarray) -> bytes:
    """Rows and starts, sorted: each row once with its count, and the planes of the gaps between starts."""
    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else np.zeros(0, np.int64)
    gaps = np.diff(starts, prepend=0)
    gaps[first] = starts[first]
    counts = np.diff(np.r_[first, len(rows)]).astype("<u4")
    planes = gaps.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(first).to_bytes(4, "little") + rows[first].astype("<i8").tobytes() + counts.tobytes() + planes


def unpacked_places(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:4], "little")
    rows = np.frombuffer(data, "<i8", n, 4)
    counts = np.frombuffer(data, "<u4", n, 4 + 8 * n).astype(np.int64)
    planes = np.frombuffer(data, np.uint8, offset=4 + 12 * n).reshape(4, -1)
    gaps = np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)
    sums = np.cumsum(gaps)
    first = np.cumsum(counts) - counts
    return np.repeat(rows, counts), sums - np.repeat(sums[first] - gaps[first], counts)


def block_windows(rows: list[int], texts: list[bytes], window: int, parts: int) -> Iterator[tuple]:
    """(part, hashes, second hashes, places, places of repeats in the block) per part."""
    order = np.argsort(np.array(rows, np.int64), kind="stable")
    sizes, values = word_values([texts[i] for i in order])
    n = len(values)
    if n < window:
        return
    ends = np.cumsum(sizes)
    left = np.repeat(ends, sizes) - np.arange(n)  # words from here to the end of the document
    inside = np.flatnonzero(left >= window)
    low = rolling(np.ascontiguousarray(values[:, 0]), 0, window)[inside]
    high = rolling(np.ascontiguousarray(values[:, 1]), 1, window)[inside]
    sort = np.argsort(low, kind="stable")  # equal windows stay in order of their place
    a, b = low[sort], high[sort]
    again = np.r_[False, (a[1:] == a[:-1]) & (b[1:] == b[:-1])]
    document = np.repeat(np.arange(len(sizes)), sizes)
    starts_of = np.arange(n) - np.repeat(ends - sizes, sizes)
    numbers = np.array(rows, np.int64)[order]

    def places(at: np.ndarray) -> bytes:
        return packed_places(numbers[document[at]], starts_of[at])

    first, repeats = np.sort(sort[~again]), inside[np.sort(sort[again])]
    part = ((high[first] >> np.uint64(24)) & np.uint64(0xFFFFFFFF)) % np.uint64(parts)
    by_part = np.argsort(part, kind="stable")
    bounds = np.searchsorted(part[by_part], np.arange(parts + 1, dtype=np.uint64))
    own = int(numbers[0]) % parts
    for p, (start, end) in enumerate(zip(bounds, bounds[1:])):
        chosen = first[by_part[start:end]]
        told = repeats if p == own else repeats[:0]
        if len(chosen) or len(told):
            second = (high[chosen] >> np.uint64(56)).astype(np.uint8)
            yield p, low[chosen].tobytes(), second.tobytes(), places(inside[chosen]), places(told)


def later_windows(texts: DataFrame, window: int, parts: int, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(row, starts) of windows whose words also start earlier, from ``texts`` (row, text as binary)."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(rows, held):
            found = list(block_windows(rows, held, window, parts))
            columns = zip(*found) if found else [[]] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, packed_types)], names=packed_names)

        rows, held, size = [], [], 0
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or b""
                rows.append(row)
                held.append(text)
                size += len(text)
                if size >= 6 * block_words:
                    yield packed(rows, held)
                    rows, held, size = [], [], 0
        yield packed(rows, held)

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per window; second hash -1 marks a window that its block knows to be a later one."""
        for batch in batches:
            for _, low, second, places, repeats in zip(*[batch.column(k) for k in range(5)]):
                for place, decided in ((places, False), (repeats, True)):
                    rows, starts = unpacked_places(place.as_py())
                    a = np.zeros(len(rows), np.int64) if decided else np.frombuffer(low.as_py(), np.int64)
                    b = np.full(len(rows), -1, np.int16) if decided else np.frombuffer(second.as_py(), np.uint8).astype(np.int16)
                    for k in range(0, len(rows), 50_000):
                        piece = slice(k, k + 50_000)
                        arrays = [a[piece], b[piece], rows[piece], starts[piece].astype(np.int32)]
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["low", "second", "row", "start"])

    def later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = (0, -2)
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            same = (a == np.r_[last[0], a[:-1]]) & (b == np.r_[last[1], b[:-1]])
            last = (int(a[-1]), int(b[-1]))
            chosen = pa.array(same | (b < 0))
            yield pa.RecordBatch.from_arrays([batch.column(2).filter(chosen), batch.column(3).filter(chosen)], names=["row", "start"])

    packed_names = ["part", "low", "second", "places", "repeats"]
    packed_types = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    blocks = texts.mapInArrow(hashed, "part int, low binary, second binary, places binary, repeats binary")
    dealt = blocks.repartitionById(parts, "part").mapInArrow(unpacked, "low long, second short, row long, start int")
    ordered = dealt.sortWithinPartitions("low", "second", "row", "start")
    return ordered.mapInArrow(later, "row long, start int").groupBy("row").agg(F.collect_list("start").alias("starts"))


def numbered(docs: DataFrame) -> DataFrame:
    """(doc, row): the input as one column, and a number that orders rows by doc_id (NULL first), then as they come.

    A whole-numbered doc_id that neither repeats nor is NULL is that number. Otherwise rows are written,
    sorted by doc_id and counted.
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    if isinstance(docs.schema["doc_id"].dataType, IntegralType):
        counts = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
        found = counts.agg(F.max("n"), F.bool_or(F.col("doc_id").isNull())).first()
        if (found[0] or 0) <= 1 and not found[1]:
            return whole.select("doc", F.col("doc.doc_id").cast("long").alias("row"))
    written = staged(whole.select("doc", F.monotonically_increasing_id().alias("at")), "numbered")
    ids = written.select(F.col("doc.doc_id").alias("id"), "at").orderBy(F.col("id").asc_nulls_first(), "at")
    rows = staged(with_position(ids).select("at", F.col("_position").alias("row")), "numbers")
    return staged(written.join(rows.hint("merge"), "at").select("doc", "row"), "numbered")


def without_windows(docs: DataFrame, window: int = WINDOW, with_text: bool = True, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` (doc_id, text, any others) rid of words in windows that also start earlier; adds ``_words``,
    ``_removed`` and ``_sha256``, the digest of the kept words joined by one space.

    * A window is ``window`` consecutive words of one text, compared as written. Earlier is a smaller doc_id, then an
      earlier row, then an earlier start; windows are judged on the input. Only the first of equal windows stays whole.
    * ``text`` becomes the kept words joined by one space where words went, and is left as it is elsewhere.
      ``with_text=False`` leaves it out of the work and of the result. ``n_chars``, where present, is counted again.
    * NULL text stays NULL and has no words; so have empty and blank ones. Rows that repeat a doc_id are rows of
      their own, so a repeated row loses its words. A NULL doc_id comes first. An empty table gives an empty one.
    * Other columns are kept, whatever their names; only the three added names replace what has them.

    Two windows count as equal when 72 bits of two polynomials and the partition number of up to 14 bits agree.
    Documents that lose nothing are not shuffled: up to ``MARKS`` hashed numbers of touched rows are broadcast.
    """
    rows = numbered(docs)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    texts = rows.select("row", F.col("doc.text").cast("binary").alias("text"))
    gone = staged(later_windows(texts, window, parts_for(size), block_words), "windows")
    mark = F.pmod(F.xxhash64("row"), F.lit(MARKS))
    marks = F.broadcast(gone.select(mark.alias("mark")).distinct())
    marked = rows.withColumn("mark", mark)
    touched = marked.join(marks, "mark", "left_semi").join(gone.hint("merge"), "row", "left")
    whole = marked.join(marks, "mark", "left_anti").withColumn("starts", F.lit(None).cast("array<int>"))
    both = touched.select("doc", "starts").unionByName(whole.select("doc", "starts"))
    if not with_text:
        kept = [f"doc.`{c}`" for c in docs.columns if c not in ("text", "n_chars")]
        both = both.select(F.struct(*kept).alias("doc"), "starts", F.col("doc.text").cast("binary").alias("text"))
    else:
        both = both.select("doc", "starts", F.col("doc.text").cast("binary").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for starts, text in zip(batch.column(1), batch.column(2)):
                words, starts = (text.as_py() or b"").split(), starts.as_py()
                if starts:
                    edges = np.zeros(len(words) + 1, np.int32)
                    np.add.at(edges, starts, 1)
                    np.add.at(edges, np.array(starts) + window, -1)
                    left = [w for w, covered in zip(words, np.cumsum(edges).tolist()) if not covered]
                else:
                    left = words
                joined = b" ".join(left)
                new = joined if with_text and len(left) < len(words) else None
                found.append((new, len(words), len(words) - len(left), hashlib.sha256(joined).hexdigest()))
            columns = zip(*found) if found else [[]] * 4
            arrays = [pa.array(c, t) for c, t in zip(columns, [pa.binary(), pa.int64(), pa.int64(), pa.string()])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc", "text", "words", "removed", "sha256"])

    kind = both.schema["doc"].dataType.simpleString()
    out = both.mapInArrow(cut, f"doc {kind}, text binary, words long, removed long, sha256 string")
    text = F.coalesce(F.col("text").cast("string"), F.col("doc.text")) if with_text else None
    changed = {"text": text, "n_chars": F.length(text).cast("long")} if with_text else {"text": None, "n_chars": None}
    added = {"_words": "words", "_removed": "removed", "_sha256": "sha256"}
    columns = [changed.get(c, F.col(f"doc.`{c}`")) for c in docs.columns if c not in added]
    names = [c for c in docs.columns if c not in added]
    return out.select(
        *[column.alias(name) for column, name in zip(columns, names) if column is not None],
        *[F.col(source).alias(name) for name, source in added.items()],
    )


def op11_repeated_windows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = without_windows(docs, with_text=False)
    return found.select(
        "doc_id", F.col("_words").alias("n_words"), F.col("_removed").alias("n_removed"), F.col("_sha256").alias("kept_sha256")
    )


OP11_SQL = r"""
with texts as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
), places as (
    select doc_id, words, unnest(range(len(words) - 19)) as start from texts where len(words) >= 20
), windows as (
    select doc_id, start, md5(array_to_string(words[start + 1 : start + 20], ' ')) as name from places
), later as (
    select doc_id, start from (
        select doc_id, start, row_number() over (partition by name order by doc_id, start) as nth from windows
    ) where nth > 1
), gone as (
    select distinct doc_id, start + k as place from later, range(20) t(k)
), kept as (
    select w.doc_id, w.word, w.place, g.place is null as stays
    from (select doc_id, unnest(words) as word, unnest(range(len(words))) as place from texts) w
    left join gone g on w.doc_id = g.doc_id and w.place = g.place
), joined as (
    select doc_id, count(*) as n_words, count(*) filter (not stays) as n_removed,
        coalesce(string_agg(word, ' ' order by place) filter (stays), '') as left_over
    from kept group by doc_id
)
select t.doc_id, coalesce(n_words, 0) as n_words, coalesce(n_removed, 0) as n_removed,
    sha256(coalesce(left_over, '')) as kept_sha256
from texts t left join joined j on t.doc_id = j.doc_id
"""

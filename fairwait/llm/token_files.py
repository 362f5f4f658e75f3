"""Token ids of a corpus in files: segments of range-coded, checksummed blocks in order of documents.

The container is Parquet, so that Spark's committer decides which files count when tasks are
repeated. A row is a segment: documents in order, the number of ids of each, and the packed
ids (``range_coder.pack``). Documents do not cross segments; segments are ordered by
``part`` and ``segment``.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from fairwait.llm.common import BATCH_BYTES, batches_of, table
from fairwait.llm.range_coder import BLOCK, LANES, pack, unpack
from fairwait.session import shared_path

SEGMENT_IDS = BLOCK * (LANES - 24)  # fills the lanes, with room for the document that ends a segment
END = 1


SPLIT = {
    "type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True,
}
OTHER, SPACE, LETTER, SIGN = range(4)
AS_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
SMALL_LETTERS = re.compile("[a-zß-öø-ÿ]+")
MOST_PIECES = 1_000_000  # kept by a worker; beyond, they are found again


class Words:
    """Ids of the pieces of texts between spaces and line ends, as little-endian 32-bit numbers, each found once.

    The tokenizer drops white space and no token crosses it, so a text's ids are those of its pieces. Where it also splits
    letters from signs and lower-cases, which is looked up in its JSON, pieces of Latin letters and ASCII signs alone are cut
    further, in runs of small letters and of signs, of which there are far fewer. No normalisation puts these letters together
    or takes them apart. Pieces with an apostrophe, a digit or any other character, or with a sign by which an added
    token can be known, stay whole.
    """

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.model, self.as_bytes = self.tokenizer.model, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.pieces: dict[bytes, bytes] = {}
        made = json.loads(tokenizer_json)
        normal = [x["type"] for x in (made["normalizer"] or {}).get("normalizers") or []]
        cuts = [dict(x) for x in (made["pre_tokenizer"] or {}).get("pretokenizers") or []]
        for cut in cuts:
            cut.pop("trim_offsets", None)
        signs = [next((c for c in x["content"] if 32 < ord(c) < 127 and not c.isalnum()), None) for x in made["added_tokens"]]
        self.apart = normal == ["NFC", "Replace", "Lowercase"] and cuts == [SPLIT, AS_BYTES] and None not in signs
        letters = set(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz\xc3")
        kept = set(b"0123456789'").union(ord(c) for c in signs if c)
        kind = lambda c: SPACE if c in b" \n" else LETTER if c in letters else SIGN if 32 < c < 127 and c not in kept else OTHER
        self.kinds = bytes(map(kind, range(256)))
        self.small = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

    def learn(self, new: list[bytes]) -> None:
        others = []
        for piece in new:
            text = piece.decode()
            if self.apart and SMALL_LETTERS.fullmatch(text):
                # What normalisers and pre-tokenizers make of such a word is known.
                text = text if text.isascii() else self.as_bytes.pre_tokenize_str(text)[0][0]
                ids = [t.id for t in self.model.tokenize(text)]
                self.pieces[piece] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                others.append(piece)
        found = self.tokenizer.encode_batch_fast([p.decode() for p in others], add_special_tokens=False)
        self.pieces.update((p, struct.pack(f"<{len(e.ids)}I", *e.ids)) for p, e in zip(others, found))

    def runs(self, data: np.ndarray, cut: np.ndarray, space: np.ndarray) -> np.ndarray:
        """``data`` in small letters, and more places in ``cut``, where a piece is of letters and signs alone."""
        pieces = cut.copy()
        kind, small = (np.frombuffer(data.tobytes().translate(t), np.uint8) for t in (self.kinds, self.small))
        letter, other = kind == LETTER, kind == OTHER
        high = np.zeros(len(data), bool)  # the second byte of a letter from À to ÿ
        high[1:] = data[:-1] == 0xC3
        if high.any():
            high &= (data != 0x97) & (data != 0xB7)
            letter |= high
            other &= ~high
            small = small + ((high & (data <= 0x9E)).view(np.uint8) << 5)
        cut[1:-1] |= (letter[1:] != letter[:-1]) & ~space[1:] & ~space[:-1]
        if other.any():
            starts = np.flatnonzero(pieces[:-1])
            whole = np.repeat(np.logical_or.reduceat(other, starts), np.diff(np.append(starts, len(data))))
            cut[:-1] &= ~whole | pieces[:-1]
            small = np.where(whole, data, small)
        return small

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``texts``, one after another, and how many each has; NULL has none."""
        texts = pc.fill_null(texts.cast(pa.large_string()).cast(pa.large_binary()), b"")
        _, ends, data = texts.buffers()
        ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        data = np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]]
        ends = ends - ends[0]
        space = (data == 32) | (data == 10)
        cut = np.zeros(len(data) + 1, bool)
        cut[1:] = space
        cut[ends] = True
        if self.apart:
            data = self.runs(data, cut, space)
        # Without white space, a piece ends where the next begins.
        place = np.zeros(len(data) + 1, np.int32)
        np.cumsum(~space, out=place[1:], dtype=np.int32)
        begins = np.zeros(int(place[-1]) + 1, bool)
        begins[place[cut]] = True
        bounds = np.flatnonzero(begins)
        data = data.tobytes().translate(None, b" \n")
        if not data:
            return np.zeros(0, "<u4"), np.zeros(len(texts), np.int64)
        pieces = pa.Array.from_buffers(
            pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)]
        ).dictionary_encode()
        _, limits, distinct = pieces.dictionary.buffers()
        limits = np.frombuffer(limits, np.int64)[: len(pieces.dictionary) + 1].tolist()
        distinct = distinct.to_pybytes()
        distinct = [distinct[start:end] for start, end in zip(limits, limits[1:])]
        if len(self.pieces) > MOST_PIECES:  # bounded memory
            self.pieces.clear()
        held = list(map(self.pieces.get, distinct))
        new = [p for p, found in zip(distinct, held) if found is None]
        if new:
            self.learn(new)
            held = list(map(self.pieces.__getitem__, distinct))
        ids, sizes = np.frombuffer(b"".join(held), "<u4"), np.fromiter(map(len, held), np.int64, len(held)) // 4
        at = pieces.indices.to_numpy()
        each = sizes[at]
        after = np.concatenate([[0], np.cumsum(each)])
        taken = np.repeat((np.cumsum(sizes) - sizes)[at] - after[:-1], each)
        taken += np.arange(len(taken))
        return ids[taken], np.diff(after[np.searchsorted(bounds, place[ends])])


@lru_cache(maxsize=1)
def words_of(tokenizer_json: str) -> Words:
    """What a worker has found stays for its next task."""
    return Words(tokenizer_json)


def write_tokens(docs: DataFrame, tokenizer_json: str, path: str, end: int = END) -> None:
    """Write ids of ``docs`` (doc_id, text, any others) to ``path``, ``end`` after each document.

    * Documents are in ascending doc_id order, NULL first; rows that repeat an id follow by their text.
      NULL and empty text has the end id alone. An empty table writes no segment.
    * Ranges of (doc_id, hash of the text) are dealt to tasks, so repeats of one id can be split. A
      segment ends with the document that brings it to the bound; a task holds one.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    id_type = docs.schema["doc_id"].dataType

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, segment = words_of(tokenizer_json), TaskContext.get().partitionId(), 0
        keys, lengths, ids = [], [], []

        def row():
            data = pack(np.concatenate(ids))
            values = [part, segment, keys, lengths, sum(lengths), data]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=names)

        held = 0
        for batch in batches:
            found, sizes = words.encode(batch.column(1))
            found, sizes = np.insert(found, np.cumsum(sizes), end), sizes + 1
            ends, batch_keys = np.concatenate([[0], np.cumsum(sizes)]), batch.column(0).to_pylist()
            first = 0
            while first < len(sizes):
                stop = int(np.searchsorted(ends, ends[first] + SEGMENT_IDS - held))  # after the document that fills the segment
                stop = min(stop, len(sizes))
                keys.extend(batch_keys[first:stop])
                lengths.extend(sizes[first:stop].tolist())
                ids.append(found[ends[first] : ends[stop]])
                held += len(ids[-1])
                first = stop
                if held >= SEGMENT_IDS:
                    yield row()
                    keys, lengths, ids, held, segment = [], [], [], 0, segment + 1
        if keys:
            yield row()

    fields = [
        ("part", IntegerType()), ("segment", IntegerType()), ("doc_ids", ArrayType(id_type)),
        ("lengths", ArrayType(IntegerType())), ("n_ids", LongType()), ("data", BinaryType()),
    ]
    names, types = [n for n, _ in fields], [to_arrow_type(t) for _, t in fields]
    place = F.xxhash64("text")
    with batches_of(docs.sparkSession, BATCH_BYTES):
        (
            docs.select("doc_id", "text")
            .repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), place)
            .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), place, "text")
            .mapInArrow(code, StructType([StructField(n, t) for n, t in fields]))
            .write.parquet(path)
        )


def read_tokens(spark: SparkSession, path: str, each=None, schema: str = "ids array<int>") -> DataFrame:
    """A row per document of ``path``: doc_id, start (ids before it), and what ``each`` makes of
    its ids; by default ``ids`` themselves. A damaged block is an error.

    Starts are running sums of the numbers in the segments' rows: over the segments of
    a part, and over the parts, of which there are as many as tasks wrote.
    """
    each = each or (lambda ids: (ids.astype(np.int32),))
    segments = spark.read.parquet(path)
    id_type = segments.schema["doc_ids"].dataType.elementType
    extra = StructType.fromDDL(schema)
    fields = [
        StructField("part", IntegerType()), StructField("segment", IntegerType()),
        StructField("doc_id", id_type), StructField("offset", LongType()), *extra.fields,
    ]
    names, types = [f.name for f in fields], [to_arrow_type(f.dataType) for f in fields]

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, segment, keys, lengths, data in zip(*batch.columns):
                ids, ends = unpack(data.as_py()), np.cumsum(np.array(lengths.as_py()))
                parts = np.split(ids, ends[:-1])
                made = list(zip(*[each(p) for p in parts]))
                values = [
                    [part.as_py()] * len(parts), [segment.as_py()] * len(parts), keys.as_py(),
                    [0, *ends[:-1].tolist()], *made,
                ]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names=names)

    sizes = segments.select("part", "segment", "n_ids")
    before = lambda window: F.coalesce(
        F.sum("n_ids").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    of_parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    of_parts = of_parts.select("part", before(Window.orderBy("part")).alias("part_start"))
    starts = (
        sizes.withColumn("in_part", before(Window.partitionBy("part").orderBy("segment")))
        .join(of_parts, "part")
        .select("part", "segment", (F.col("part_start") + F.col("in_part")).alias("segment_start"))
    )
    return (
        segments.select("part", "segment", "doc_ids", "lengths", "data")
        .mapInArrow(documents, StructType(fields))
        .join(starts, ["part", "segment"])
        .select("doc_id", (F.col("segment_start") + F.col("offset")).cast("long").alias("start"), *extra.names)
    )


def op2_token_files(spark, sf_dir):
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        tokenizer = file.read()
    path = shared_path(spark, "token-files")
    write_tokens(table(spark, sf_dir, "documents"), tokenizer, path)
    return read_tokens(
        spark,
        path,
        lambda ids: (len(ids), zlib.crc32(ids.astype("<u4").tobytes())),
        "n_tokens long, ids_crc32 long",
    )

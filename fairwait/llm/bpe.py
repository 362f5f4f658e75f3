"""Byte-level BPE over a corpus: every distinct word is encoded once, wherever it occurs.

Documents are cut into words and gathered in blocks of bounded size. A block keeps the place of
each word as a number, and hands its distinct words, dealt by their checksum, to the tasks
that encode: equal words of all blocks meet in one task. What comes back to a block is the ids of
its own words, from which its documents are put together by position. So the large shuffle
of words carries each word once per block and not once per occurrence; the blocks themselves
stay where they were written, bucketed by number.
"""

from __future__ import annotations

import base64
import json
import re
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, IntegerType, LongType, StructField, StructType,
)

from fairwait.llm.common import BATCH_BYTES, batches_of, table
from fairwait.session import shared_path

BLOCK_CHARS = 10_000_000  # a task holds the words of a block several times over
DECODED_IDS = 1_000_000  # ids that are turned into bytes at once


class Vocabulary:
    """Ranks of a file in the usual text form (token in base64, rank), and the pattern of words.

    The driver reads the file; its content, a few hundred KB, travels with the tasks.
    """

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            self.lines = file.read()
        self.pattern = pattern

    def ranks(self) -> dict[bytes, int]:
        pairs = map(bytes.split, self.lines.splitlines())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}

    def encoder(self):
        import tiktoken

        return tiktoken.Encoding(
            "words", pat_str=self.pattern, mergeable_ranks=self.ranks(), special_tokens={}
        ).encode_ordinary


# A space followed by neither a sign nor a letter belongs to the white space before it.
NO_START = re.compile(r"\x20(?:\s|$)")


def pieces(text: str) -> list[str]:
    """``text`` cut before every space that something other than white space follows; that
    space is left out of all pieces but the first.

    The pattern of the vocabulary takes such a space as the first character of a match
    and never otherwise, and white space at the end of a piece matches as it does before the space.
    So the matches of a text are those of its pieces.
    """
    found = text.split(" ")
    if NO_START.search(text):
        whole = [found[0]]
        for piece in found[1:]:
            if piece and not piece[0].isspace():
                whole.append(piece)
            else:
                whole[-1] += " " + piece
        return whole
    return found


def planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers as four runs of bytes, lowest first, which compress well apart."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def squeezed(data: bytes) -> bytes:
    return pa.Codec("zstd", compression_level=9).compress(data, asbytes=True)


def unsqueezed(data: bytes) -> bytes:
    with pa.CompressedInputStream(pa.BufferReader(data), "zstd") as stream:
        return stream.read()


def packed(words: list[str]) -> bytes:
    return squeezed(json.dumps(words).encode())


def numbered() -> defaultdict[str, int]:
    index: defaultdict[str, int] = defaultdict()
    index.default_factory = index.__len__
    return index


class Block:
    """Documents of one task, up to a bound of text."""

    def __init__(self):
        self.index = numbered()  # pieces that a space goes before
        self.heads = numbered()  # first pieces
        self.places: list[np.ndarray] = []
        self.first: list[int] = []
        self.keys: list[pa.StructArray] = []
        self.chars = 0

    def add(self, key: pa.StructArray, text: str) -> None:
        head, *rest = pieces(text)
        self.first.append(self.heads[head])
        self.places.append(np.fromiter(map(self.index.__getitem__, rest), np.uint32, len(rest)))
        self.keys.append(key)
        self.chars += len(text)

    def rows(self, number: int, parts: int) -> dict[str, pa.Array]:
        """The block's own row, part -1, then a row of distinct words for each part.

        Words are numbered by frequency, so that most places are small numbers. The block
        remembers to which part each went; a part holds them in the order of their numbers.
        """
        # A factory that refers to its dictionary would keep the words of blocks that are done.
        self.index.default_factory = self.heads.default_factory = None
        words = [" " + w for w in self.index] + list(self.heads)
        places = np.concatenate(
            [x for head, rest in zip(self.first, self.places) for x in ([len(self.index) + head], rest)]
        ).astype(np.uint32)
        by_count = np.argsort(-np.bincount(places, minlength=len(words)), kind="stable")
        rank = np.empty(len(words), np.uint32)
        rank[by_count] = np.arange(len(words))
        part = np.fromiter((zlib.crc32(words[i].encode()) % parts for i in by_count), np.int64, len(words))
        order = np.argsort(part, kind="stable")
        present, starts = np.unique(part[order], return_index=True)
        ends = [*starts[1:], len(words)]
        keys = pa.concat_arrays(self.keys)
        n = len(present)
        return {
            "block": pa.array([number] * (n + 1), pa.int64()),
            "part": pa.array([-1, *present.tolist()], pa.int32()),
            "keys": pa.ListArray.from_arrays(pa.array([0, len(keys)] + [len(keys)] * n, pa.int32()), keys),
            "lengths": pa.array([[len(p) + 1 for p in self.places], *[None] * n], pa.list_(pa.int32())),
            "places": pa.array([planes(rank[places]), *[None] * n], pa.binary()),
            "dealt": pa.array([planes(part), *[None] * n], pa.binary()),
            "words": pa.array(
                [None, *[packed([words[i] for i in by_count[order[a:b]]]) for a, b in zip(starts, ends)]], pa.binary()
            ),
        }


def blocks_of(docs: DataFrame, keep: Sequence[str], parts: int) -> DataFrame:
    """Blocks and their distinct words, written once to the shared folder, bucketed by block."""
    from pyspark import TaskContext

    limit = BLOCK_CHARS

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        block = Block()
        for batch in batches:
            keys = pa.StructArray.from_arrays(
                [batch.column(k) for k in range(len(keep))], fields=[batch.schema.field(k) for k in range(len(keep))]
            )
            texts = batch.column(len(keep))
            for i in range(batch.num_rows):
                block.add(keys.slice(i, 1), texts[i].as_py() or "")
                if block.chars >= limit:
                    yield pa.RecordBatch.from_pydict(block.rows(number, parts))
                    block, number = Block(), number + 1
        if block.keys:
            yield pa.RecordBatch.from_pydict(block.rows(number, parts))

    fields = [docs.schema[c] for c in keep]
    schema = StructType(
        [
            StructField("block", LongType()),
            StructField("part", IntegerType()),
            StructField("keys", ArrayType(StructType(fields))),
            StructField("lengths", ArrayType(IntegerType())),
            StructField("places", BinaryType()),
            StructField("dealt", BinaryType()),
            StructField("words", BinaryType()),
        ]
    )
    spark = docs.sparkSession
    name = f"bpe_blocks_{uuid.uuid4().hex}"
    with batches_of(spark, BATCH_BYTES):
        (
            docs.select(*[F.col(f"`{c}`") for c in keep], "text")
            .mapInArrow(cut, schema)
            .write.bucketBy(parts, "block")
            .option("path", shared_path(spark, name))
            .option("compression", "zstd")
            .saveAsTable(name)
        )
    return spark.table(name)


def encoded_words(blocks: DataFrame, vocabulary: Vocabulary, parts: int) -> DataFrame:
    """(block, part, sizes, ids): the ids of each block's distinct words, part by part.

    A word is dealt by its checksum, so one task sees all its blocks and encodes it once. The
    task remembers the words of its share, one part in ``parts`` of all distinct words.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocabulary.encoder()
        known: dict[str, list[int]] = {}
        for batch in batches:
            sizes, ids = [], []
            for words in batch.column(2):
                found = []
                for word in json.loads(unsqueezed(words.as_py())):
                    tokens = known.get(word)
                    if tokens is None:
                        tokens = known[word] = encoder(word)
                    found.append(tokens)
                sizes.append(squeezed(planes(np.fromiter(map(len, found), np.int64, len(found)))))
                ids.append(squeezed(planes(np.array(list(chain.from_iterable(found)), np.int64))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.binary()), pa.array(ids, pa.binary())],
                names=["block", "part", "sizes", "ids"],
            )

    words = blocks.where("part >= 0").select("block", "part", "words")
    return words.repartition(parts, "part").mapInArrow(
        encode, "block long, part int, sizes binary, ids binary"
    )


def put_together(keys: pa.Array, lengths, places: np.ndarray, size, start, ids) -> Iterator[pa.Table]:
    """Documents of one block from the ids of its words, some at a time."""
    ends = np.cumsum(lengths)
    first = 0
    while first < len(lengths):
        base = int(ends[first] - lengths[first])
        last = max(first + 1, int(np.searchsorted(ends, base + 500_000, side="right")))
        own = places[base : int(ends[last - 1])]
        taken = size[own]
        upto = np.concatenate([[0], np.cumsum(taken)])
        flat = ids[np.repeat(start[own] - upto[:-1], taken) + np.arange(upto[-1])]
        offsets = upto[np.concatenate([[0], ends[first:last] - base])]
        column = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
        part = keys.slice(first, last - first)
        yield pa.table([*part.flatten(), column], names=[*[f.name for f in part.type], "ids"])
        first = last


def encode(docs: DataFrame, vocabulary: Vocabulary, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of every row of ``docs``, and ``ids``, the ids of its ``text``.

    NULL and empty text has no ids. Rows are told apart by place and not by id, so repeated rows
    and NULL ids are kept row by row. An empty table gives an empty one. ``ids`` is reserved.
    A very long text is a block of its own.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = blocks_of(docs, keep, parts)
    whole = blocks.where("part = -1").select("block", "keys", "lengths", "places", "dealt")
    fields = [docs.schema[c] for c in keep]
    schema = StructType([*fields, StructField("ids", ArrayType(IntegerType()))])

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        def column(name):
            by_part = sorted(zip(right.column("part").to_pylist(), right.column(name)), key=lambda x: x[0])
            return np.concatenate([from_planes(unsqueezed(x.as_py())) for _, x in by_part])

        sizes, ids = column("sizes"), column("ids").astype(np.int32)
        tables = []
        for k in range(left.num_rows):  # one row: a block is written once
            order = np.argsort(from_planes(left.column("dealt")[k].as_py()), kind="stable")
            size, start = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
            size[order] = sizes
            start[order] = np.cumsum(sizes, dtype=np.int64) - sizes
            own = left.column("keys")[k].values
            lengths = np.array(left.column("lengths")[k].values)
            places = from_planes(left.column("places")[k].as_py())
            tables += put_together(own, lengths, places, size, start, ids)
        return pa.concat_tables(tables)

    words = encoded_words(blocks, vocabulary, parts)
    return whole.groupBy("block").cogroup(words.groupBy("block")).applyInArrow(join, schema)


def slices(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """``batch`` by rows, ``DECODED_IDS`` numbers of its list column ``at`` or a single row at a time."""
    sizes = np.nan_to_num(pc.list_value_length(batch.column(at)).to_numpy(zero_copy_only=False)).astype(np.int64)
    ends, first = np.cumsum(sizes), 0
    while first < len(sizes):
        before = int(ends[first] - sizes[first])
        last = max(first + 1, int(np.searchsorted(ends, before + DECODED_IDS, side="right")))
        yield batch.slice(first, last - first)
        first = last


def decode(tokens: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``tokens`` with ``data``, the bytes of its ``ids`` by the table of tokens.

    The table has as many rows as the vocabulary, a fixed number, and is joined in the tasks by
    place. NULL ids have NULL data; an id outside the table is an error.
    """
    columns = tokens.columns
    at = columns.index("ids")

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = vocabulary.ranks()
        by_rank = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            by_rank[rank] = token
        for whole in batches:
            for batch in slices(whole, at):
                data = [
                    None if not ids.is_valid else b"".join(map(by_rank.__getitem__, ids.values.to_numpy().tolist()))
                    for ids in batch.column(at)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(data, pa.binary())], names=[*columns, "data"]
                )

    schema = StructType([*tokens.schema.fields, StructField("data", BinaryType())])
    return tokens.mapInArrow(look_up, schema)


def default_vocabulary() -> Vocabulary:
    import public_tokenizers

    return Vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = default_vocabulary()
    tokens = decode(encode(table(spark, sf_dir, "documents"), vocabulary), vocabulary)
    return tokens.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )

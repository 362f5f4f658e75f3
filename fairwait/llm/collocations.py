"""Phrase mining over sorted count streams, in the layout of external language-model estimation.

Every word starts one gram: itself and up to two words after it in its piece. Grams are counted in
blocks, then dealt by ranges and sorted, which is the prefix order: all grams that begin with the same
words are neighbours. One pass over that stream in lockstep on its first one, two and three words counts
words, pairs and triples at once. What reaches the threshold is kept in prefix order and, with its words
turned, in suffix order; sorted streams are then merged for the counts of left parts, right parts
and longer phrases. No table of counts is held in memory, in tasks or in the driver.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairwait.llm.common import parts_for, staged, table

LEAST = 10
TOP = 2000
INSIDE_PERCENT = 50
SCALE = 1_000_000
BLOCK_WORDS = 1_000_000  # words whose grams a task counts before it hands them on
SAMPLE_BYTES = 8 << 20  # text from which the ranges are taken

# Fixed by the contract: what ends a piece.
ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
TO_LINES = bytes.maketrans(ENDS, b"\n" * len(ENDS))
# No byte of UTF-8: after the lang, and where a piece ends; a space within the lang.
MARK, SPACE_IN_LANG = b"\xff", b"\xfe"


def spaced(text: bytes) -> tuple[bytes, int]:
    """The words of a text, each with a space after it, and two more spaces, two empty words, wherever a piece ends; and
    how many words and marks there are."""
    tokens = text.lower().translate(TO_LINES).replace(b"\n", b" " + MARK + b" ").split()
    return b" ".join(tokens).replace(MARK, b" ") + b"   ", len(tokens)


def grams_of(data: bytes) -> pa.StructArray:
    """(values, counts) of the grams in ``data``: from each word on, three words with the space after each. Words
    beyond the end of a piece are empty ones."""
    text = np.frombuffer(data, np.uint8)
    spaces = np.flatnonzero(text == 32)
    starts = np.r_[0, spaces[:-1] + 1]
    words = np.flatnonzero(spaces > starts)  # the last ones are empty, so each word has two after it
    begin, end = starts[words], spaces[words + 2] + 1
    offsets = np.zeros(len(words) + 1, np.int32)
    np.cumsum(end - begin, out=offsets[1:])
    at = np.arange(offsets[-1], dtype=np.int32) + np.repeat((begin - offsets[:-1]).astype(np.int32), end - begin)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(text[at])]
    return pc.value_counts(pa.Array.from_buffers(pa.binary(), len(words), buffers))


def gram_blocks(docs: DataFrame, bounds: Sequence[bytes] = (), block_words: int = BLOCK_WORDS) -> DataFrame:
    """(part, key, n) from ``docs`` (lang, text): grams counted per block, with the range of ``bounds`` they are in."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def handed_on() -> Iterator[pa.RecordBatch]:
            for lang, texts in held.items():
                counted = grams_of(b"".join(texts))
                # Sorted runs are half of the sort that follows.
                counted = counted.take(pc.array_sort_indices(counted.field("values")))
                lead, none = pa.scalar(lang + MARK, pa.binary()), pa.scalar(b"", pa.binary())
                keys = pc.binary_join_element_wise(lead, counted.field("values"), none)
                cuts = [bisect_left(range(len(keys)), cut, key=lambda k: keys[k].as_py()) for cut in bounds]  # noqa: B023
                parts = np.repeat(np.arange(len(bounds) + 1, dtype=np.int32), np.diff([0, *cuts, len(keys)]))
                whole = pa.RecordBatch.from_arrays([pa.array(parts), keys, counted.field("counts")], names=["part", "key", "n"])
                for k in range(0, len(keys), 50_000):
                    yield whole.slice(k, 50_000)
            held.clear()

        held: dict[bytes, list[bytes]] = {}
        words = 0
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                data, n = spaced(text.as_py() or b"")
                held.setdefault(lang.as_py().replace(b" ", SPACE_IN_LANG), []).append(data)
                words += n
                if words >= block_words:
                    yield from handed_on()
                    words = 0
        yield from handed_on()

    lang = F.coalesce("lang", F.lit("und")).cast("binary").alias("lang")
    texts = docs.select(lang, F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(count, "part int, key binary, n long")


def ranges(docs: DataFrame, parts: int, size: int | None) -> list[bytes]:
    """At most ``parts`` - 1 keys between which there are about as many grams each, from a sample of texts by their hash.

    They only say which task a gram goes to. The driver gets these keys alone.
    """
    if parts == 1:
        return []
    share = max(1, (size or 0) // SAMPLE_BYTES)
    sample = docs.where(F.pmod(F.xxhash64("text"), F.lit(share)) == 0)
    grams = gram_blocks(sample).select("key").sample(min(1.0, 200 * parts * share / max(size, 1)), seed=1)
    tile = F.ntile(parts).over(Window.orderBy("key"))
    firsts = grams.withColumn("tile", tile).groupBy("tile").agg(F.min("key").alias("key"))
    return sorted({bytes(row["key"]) for row in firsts.where("tile > 1").collect()})


def prefix_counts(sorted_grams: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, words, n) of prefixes from sorted (key, n), as binary; ``words`` 0 stands for all words of the lang.

    A partition may begin or end within a prefix, so prefixes at its two ends are handed on whatever their
    count, to be added up; of the others only those with ``least`` or more are.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter = Counter()
        opened: list[tuple[bytes, int, bool] | None] = [None] * 3  # prefix, count, whether the partition began with it
        first = True
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, n = batch.num_rows, batch.column(1).to_numpy()
            fields = pc.split_pattern(batch.column(0), pattern=b" ").flatten()
            words = [fields.take(pa.array(np.arange(k, 4 * rows, 4))) for k in range(3)]  # the first one with its lang
            out: list[tuple[bytes, int, int]] = []
            begins = np.zeros(rows, bool)
            begins[0] = True
            for depth, word in enumerate(words):
                if rows > 1:
                    begins[1:] |= pc.not_equal(word[1:], word[:-1]).to_numpy(zero_copy_only=False)
                starts = np.flatnonzero(begins)
                sums = np.add.reduceat(n, starts)

                def prefix(at: int, depth: int = depth) -> bytes:
                    return b" ".join(w[at].as_py() for w in words[: depth + 1])

                # The first run may go on with the one that was open, and the last one stays open.
                head, found = prefix(0), opened[depth]
                at_start = first
                count = int(sums[0])
                if found is not None:
                    if found[0] == head:
                        count, at_start = count + found[1], found[2]
                    elif found[1] >= least or found[2]:
                        out.append((found[0], depth + 1, found[1]))
                if len(starts) == 1:
                    opened[depth] = (head, count, at_start)
                else:
                    if count >= least or at_start:
                        out.append((head, depth + 1, count))
                    for k in np.flatnonzero(sums[1:-1] >= least) + 1:
                        out.append((prefix(int(starts[k])), depth + 1, int(sums[k])))
                    opened[depth] = (prefix(int(starts[-1])), int(sums[-1]), False)
                if depth == 0:
                    langs = [words[0][int(at)].as_py().partition(MARK)[0] for at in (starts[0], starts[-1])]
                    if langs[0] == langs[1]:
                        totals[langs[0]] += int(n.sum())
                    else:
                        for at, s in zip(starts, sums):
                            totals[words[0][int(at)].as_py().partition(MARK)[0]] += int(s)
            first = False
            yield written(out)
        ends = [(found[0], depth + 1, found[1]) for depth, found in enumerate(opened) if found is not None]
        yield written(ends + [(lang + MARK, 0, n) for lang, n in totals.items()])

    def written(rows: list[tuple[bytes, int, int]]) -> pa.RecordBatch:
        # A prefix that ends in a space has an empty word: its piece ended before.
        split = [
            (*prefix.replace(SPACE_IN_LANG, b" ").split(MARK), words, n) for prefix, words, n in rows if not prefix.endswith(b" ")
        ]
        columns = zip(*split) if split else [[]] * 4
        arrays = [pa.array(c, t) for c, t in zip(columns, [pa.binary(), pa.binary(), pa.int32(), pa.int64()])]
        return pa.RecordBatch.from_arrays(arrays, names=["lang", "phrase", "words", "n"])

    return sorted_grams.select("key", "n").mapInArrow(merge, "lang binary, phrase binary, words int, n long")


def counts(docs: DataFrame, least: int = LEAST, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(lang, phrase, words, n): words, pairs and triples that occur ``least`` times or more, as binary, and
    per lang one row with no words that counts all."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    bounds = ranges(docs, parts_for(size), size)
    grams = gram_blocks(docs, bounds, block_words)
    prefix_order = grams.repartitionById(len(bounds) + 1, "part").sortWithinPartitions("key")
    partial_counts = staged(prefix_counts(prefix_order, least), "prefixes")
    whole = partial_counts.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))
    return whole.where((F.col("n") >= least) | (F.col("words") == 0))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, inside_percent: int = INSIDE_PERCENT, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per lang the ``top`` phrases of two or three words of ``docs`` (lang, text): lang, rank, phrase, a, l, r, n, score.

    * A to Z are lower-cased; pieces end at ``ENDS`` and line ends, words at space and tab. ``a`` counts a phrase within pieces,
      overlaps included; candidates have ``least`` or more. ``n`` is the number of all words of the lang.
    * A cut after k words has l and r, the counts of its parts, and the score floor(10^6 * a * a / (l * r)) in decimals of 38
      digits; the lowest score counts, ties to the smaller k.
    * A candidate inside a longer one that has ``inside_percent`` of its count or more is dropped, be the longer dropped or not.
    * Ties in rank go to the greater a, then to the phrase in byte order.
    * NULL, empty and blank texts have no words; a NULL lang counts as ``und``. Repeated rows count as often as they
      occur. A lang without candidates has no row, nor has an empty table. Other columns are not read, whatever their names.
    """
    found = staged(counts(docs, least, block_words).withColumn("phrase", F.col("phrase").cast("string")), "counts")
    of = lambda k: found.where(F.col("words") == k)
    word = lambda k: F.split_part("phrase", F.lit(" "), F.lit(k))
    # Prefix order: by lang, first words, last word. Suffix order: by lang, last words, first word.
    pairs = of(2).select("lang", word(1).alias("w1"), word(2).alias("w2"), F.col("n").alias("a"))
    triples = of(3).select(
        "lang", F.concat_ws(" ", word(1), word(2)).alias("head"), F.concat_ws(" ", word(2), word(3)).alias("tail"),
        word(1).alias("w1"), word(3).alias("w3"), F.col("n").alias("a"),
    )
    words = of(1).select("lang", "phrase", "n")
    two = of(2).select("lang", "phrase", "n")

    def merged(left: DataFrame, right: DataFrame, on: str, name: str) -> DataFrame:
        """Both sides sorted by lang and phrase and merged; every part of a candidate has a count."""
        stream = right.select("lang", F.col("phrase").alias(on), F.col("n").alias(name))
        return left.join(stream.hint("merge"), ["lang", on])

    split_pairs = merged(merged(pairs, words, "w1", "l1"), words, "w2", "r1")
    split_triples = triples
    for right, on, name in ((words, "w1", "l1"), (two, "head", "l2"), (words, "w3", "r2"), (two, "tail", "r1")):
        split_triples = merged(split_triples, right, on, name)
    split_triples = staged(split_triples, "triples")
    # The longer phrases of a pair: those it begins, and those it ends.
    longer = split_triples.select("lang", F.col("head").alias("phrase"), "a").unionByName(
        split_triples.select("lang", F.col("tail").alias("phrase"), "a")
    )
    longest = longer.groupBy("lang", "phrase").agg(F.max("a").alias("in_longer"))
    score = lambda l, r: _score(F.col("a"), F.col(l), F.col(r))
    first = F.struct(score("l1", "r1").alias("score"), F.lit(1).alias("k"), F.col("l1").alias("l"), F.col("r1").alias("r"))
    second = F.struct(score("l2", "r2").alias("score"), F.lit(2).alias("k"), F.col("l2").alias("l"), F.col("r2").alias("r"))
    of_two = split_pairs.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", first.alias("cut"))
    kept = of_two.join(longest.hint("merge"), ["lang", "phrase"], "left").where(
        F.col("in_longer").isNull() | (100 * F.col("in_longer") < inside_percent * F.col("a"))
    )
    of_three = split_triples.select(
        "lang", F.concat_ws(" ", "head", "w3").alias("phrase"), "a", F.least(first, second).alias("cut")
    )
    every = kept.drop("in_longer").unionByName(of_three)
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = of(0).select("lang", F.col("n").alias("total"))
    return ranked.join(totals.hint("merge"), "lang").select(
        F.col("lang").cast("string").alias("lang"), F.col("rank").cast("long").alias("rank"), "phrase", "a",
        F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("total").alias("n"), F.col("cut.score").alias("score"),
    )


def _score(a: Column, left: Column, right: Column) -> Column:
    exact = lambda c: c.cast("decimal(19,0)")
    above = (exact(a) * exact(a)).cast("decimal(31,0)") * F.lit(SCALE).cast("decimal(7,0)")
    return F.call_function("div", above, exact(left) * exact(right)).cast("long")


def op13_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


OP13_SQL = r"""
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) as piece
    from documents
), worded as (
    select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), grams as (
    select lang, k, unnest([array_to_string(w[i : i + k - 1], ' ') for i in range(1, len(w) - k + 2)]) as phrase
    from worded, range(1, 4) t(k)
), f as (
    select lang, k, phrase, string_split(phrase, ' ') as w, count(*) as n from grams group by lang, k, phrase
), candidates as (
    select lang, k, phrase, w, n as a from f where k > 1 and n >= 10
), cuts as (
    select lang, phrase, k as size, a, 1 as cut, w[1] as head, array_to_string(w[2 : k], ' ') as tail from candidates
    union all
    select lang, phrase, k, a, 2, w[1] || ' ' || w[2], w[3] from candidates where k = 3
), parts as (
    select c.lang, c.phrase, c.size, c.a, c.cut, l.n as l, r.n as r,
        ((1000000::hugeint * c.a * c.a) // (l.n::hugeint * r.n))::bigint as score
    from cuts c
    join f l on l.lang = c.lang and l.phrase = c.head
    join f r on r.lang = c.lang and r.phrase = c.tail
), lowest as (
    select * from (
        select *, row_number() over (partition by lang, phrase order by score, cut) as nth from parts
    ) where nth = 1
), inner_ones as (
    select lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) as phrase, a as b from candidates where k = 3
), dropped as (
    select distinct p.lang, p.phrase from lowest p
    join inner_ones i on p.lang = i.lang and p.phrase = i.phrase and p.size = 2 and 100 * i.b >= 50 * p.a
), ranked as (
    select p.*, row_number() over (partition by p.lang order by score desc, a desc, p.phrase) as rank
    from lowest p left join dropped d on p.lang = d.lang and p.phrase = d.phrase
    where d.phrase is null
)
select p.lang, p.rank, p.phrase, p.a, p.l, p.r, t.n, p.score
from ranked p
join (select lang, sum(n)::bigint as n from f where k = 1 group by lang) t on p.lang = t.lang
where p.rank <= 2000
"""

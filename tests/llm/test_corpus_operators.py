"""Operators over a whole corpus: against brute force, exact round trips and DuckDB."""

import base64
import gc
import hashlib
import random
import weakref
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fairwait.llm import bpe, common, jaccard, line_runs, mixing, near_vectors, queries, range_coder, token_files
from fairwait.llm.common import components
from helpers import WORD, awkward, documents, empty, shingles, smallest_reachable

public_tokenizers = pytest.importorskip("public_tokenizers")


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 260)]
    edges = [*chain, *star, (1, 1), (3, 2), (2, 3), *star[:5]]
    found = components(spark.createDataFrame(edges, "src long, dst long"))
    want = smallest_reachable({n for e in edges for n in e}, edges)
    want.pop(1)  # a loop alone links nothing
    assert dict(map(tuple, found.collect())) == want
    assert components(spark.createDataFrame([], "src long, dst long")).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


@pytest.mark.parametrize("bucket_rows", [2_048, 16])
def test_vectors_link_as_by_all_pairs(spark, bucket_rows):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((30, 32))
    noise = lambda s: rng.standard_normal(32) * s
    rows = [centres[i % 30] + noise(0.1 if i % 3 else 0.4) for i in range(300)]
    rows += [centres[0] * 3] * 40 + [rng.standard_normal(32) for _ in range(60)]
    rows = [list(map(float, np.float32(r))) for r in rows]
    bad = [None, [], [0.0] * 32, [float("nan")] * 32, [float("inf")] + [1.0] * 31, [None] + [1.0] * 31]
    table = [(i, r, 0) for i, r in enumerate(rows)] + [(1000 + i, b, 1) for i, b in enumerate(bad)]
    unit = np.array(rows) / np.linalg.norm(rows, axis=1, keepdims=True)
    near = unit @ unit.T >= near_vectors.LEAST_COSINE
    want = smallest_reachable(range(len(rows)), zip(*np.nonzero(np.triu(near, 1))))
    found = near_vectors.linked(vectors(spark, table), bucket_rows=bucket_rows).collect()
    assert len(found) == len(table)
    for row in found:
        if row.vec_id < 1000:
            assert (row.n_links, row.component_id) == (near[row.vec_id].sum() - 1, want[row.vec_id])
        else:
            assert (row.n_links, row.component_id) == (0, row.vec_id)


def test_no_vectors_and_a_null_id(spark):
    assert near_vectors.linked(vectors(spark, []).where("true")).count() == 0
    found = near_vectors.linked(vectors(spark, [(None, [1.0], 0), (3, [1.0], 0), (2, [2.0], 0)]))
    assert sorted(map(str, map(tuple, found.collect()))) == ["(2, 1, 2)", "(3, 1, 2)", "(None, 0, None)"]


def near_texts(rng, groups=40):
    texts = []
    for g in range(groups):
        words = [f"g{g}w{rng.randint(0, 400)}" for _ in range(rng.choice([1, 3, 5, 8, 40, 70, 200, 300]))]
        for _ in range(rng.randint(1, 8)):
            copy = words[:]
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = f"new{rng.randint(0, 10**9)}"
            texts.append((" ".join(copy)).title() if rng.random() < 0.3 else " ".join(copy))
    return texts


@pytest.mark.parametrize("cell_rows", [2_048, 3])
def test_documents_link_as_by_all_pairs(spark, cell_rows):
    shared = " ".join(f"licence{i}" for i in range(60))
    texts = near_texts(random.Random(2))
    texts += [f"{shared} {' '.join(f'own{i}x{k}' for k in range(i))}" for i in range(0, 60, 2)]
    sets = [shingles(t) for t in texts]
    links = [
        (a, b)
        for a in range(len(sets))
        for b in range(a)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    want = smallest_reachable(range(len(texts)), links)
    found = jaccard.grouped(documents(spark, texts), cell_rows=cell_rows).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == {
        i: (len(sets[i]), want[i]) for i in range(len(texts))
    }


def test_many_exact_copies_are_one_group(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "MANY_COPIES", 10)
    texts = ["a b c d e f g h"] * 50 + ["quite another text of many words"] * 3
    found = {r.doc_id: r.component_id for r in jaccard.grouped(documents(spark, texts)).collect()}
    assert set(found.values()) == {0, 50}


def test_jaccard_works_on_batches_of_bounded_size(spark, monkeypatch):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, seen, stage = spark.conf.get(key), {}, jaccard.staged
    monkeypatch.setattr(
        jaccard, "staged", lambda df, label: seen.setdefault(label, set()).add(spark.conf.get(key)) or stage(df, label)
    )
    assert jaccard.grouped(documents(spark, ["a b c d e f g", "a b c d e f g", None])).count() == 3
    assert {"shingles", "cells", "bounded", "links", "across"} <= set(seen)
    assert set().union(*seen.values()) == {str(common.BATCH_BYTES)} and spark.conf.get(key) == before


def test_jaccard_on_awkward_rows(spark):
    found = sorted(map(tuple, jaccard.grouped(awkward(spark)).where("doc_id is not null").collect()))
    assert [f for f in found if f[0] in (1, 2, 3)] == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]
    assert [f for f in found if f[0] in (6, 7)] == [(6, 1, 6), (7, 1, 6)]
    assert jaccard.grouped(empty(spark)).count() == 0


def test_the_bound_never_loses_a_pair():
    rng = np.random.default_rng(3)
    for _ in range(300):
        base = rng.integers(0, 2**63, int(rng.integers(1, 400)), dtype=np.uint64)
        drop = rng.random(len(base)) < 0.1
        a, b = np.unique(base), np.unique(np.append(base[~drop], rng.integers(0, 2**63, 3, dtype=np.uint64)))
        shared = len(np.intersect1d(a, b))
        assert jaccard.overlap(jaccard.point(a), jaccard.point(b)) >= shared
        if jaccard.similar(a, b):
            assert set(jaccard.listed(a)) & set(jaccard.listed(b))


def plain_runs(rows, least):
    """Longest earlier match at every line, by comparing with all earlier lines."""
    seen, out = [], []
    for text in rows:
        lines = [(k, x.strip(" \t\n\v\f\r"), len(WORD.findall(x))) for k, x in enumerate((text or "").split("\n"))]
        lines = [x for x in lines if x[2]]
        gone = set()
        for i in range(len(lines)):
            for other, j in [(o, j) for o in seen for j in range(len(o))] + [(lines, j) for j in range(i)]:
                n = 0
                while i + n < len(lines) and j + n < len(other) and lines[i + n][1] == other[j + n][1]:
                    n += 1
                if n and sum(x[2] for x in lines[i : i + n]) >= least:
                    gone.update(x[0] for x in lines[i : i + n])
        seen.append(lines)
        out.append(None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone))
    return out


def test_runs_go_as_by_comparing_all_lines(spark):
    rng = random.Random(4)
    pool = ["a b", "c", " d e f", "one line of very many words that counts on its own", "", "g h i", "  ", "j"]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randint(0, 14))) for _ in range(60)] + [None]
    found = {r.doc_id: r.text for r in line_runs.without_repeats(documents(spark, texts)).collect()}
    assert [found[i] for i in range(len(texts))] == plain_runs(texts, line_runs.LEAST_WORDS)


def test_a_short_line_goes_wherever_it_occurs_again(spark):
    short = "The nine words of a line that documents share."
    texts = [f"Own {i} one.\n  {short}\nOwn {i} two.\nYes.\n{short}" for i in range(20)]
    found = {r.doc_id: (r.text, r._lines, r._deleted) for r in line_runs.without_repeats(documents(spark, texts)).collect()}
    assert found[0] == (f"Own 0 one.\n  {short}\nOwn 0 two.\nYes.", 5, 1)
    assert all(found[i] == (f"Own {i} one.\nOwn {i} two.", 5, 3) for i in range(1, 20))


@pytest.mark.parametrize("least", [4, 10])
def test_longer_runs_go_as_by_comparing_all_lines(spark, least):
    rng = random.Random(8)
    pool = ["a b", "c", " d e f", "one line of very many words that counts on its own", "", "g h i", "  ", "j"]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randint(0, 14))) for _ in range(60)] + [None]
    found = {r.doc_id: r.text for r in line_runs.without_repeats(documents(spark, texts), least).collect()}
    assert [found[i] for i in range(len(texts))] == plain_runs(texts, least)


def test_line_runs_on_awkward_rows(spark):
    rows = line_runs.without_repeats(awkward(spark)).collect()
    assert len(rows) == 11 and next(r.text for r in rows if r.doc_id == 1) is None
    assert line_runs.without_repeats(empty(spark)).count() == 0


def test_suffixes_are_ranked_by_doubling_and_long_runs_found_whole(spark, monkeypatch):
    """Each round orders the suffixes that share twice as many lines; a copy of 13 lines takes four of them."""
    rng, levels, ranked = random.Random(9), [], line_runs.ranked
    monkeypatch.setattr(line_runs, "ranked", lambda *given: levels.append(ranked(*given)) or levels[-1])
    passage = [rng.choice("abc") * 3 + f" {k}" for k in range(13)]
    texts = ["\n".join(x) for x in (["x", *passage, "y"], ["z", *passage], ["abc 1", "q"], passage[3:5], ["same"] * 6)]
    docs = documents(spark, texts).withColumn("_row", F.col("doc_id") + 10)
    runs = {tuple(r) for r in line_runs.repeated_runs(docs).collect()}
    assert {(11, 1, 8), (11, 6, 13), (13, 0, 1), (14, 1, 4), (14, 2, 5)} <= runs
    assert not [r for r in runs if r[0] in (10, 12)]
    found = {r["_row"]: r["_runs"] for r in line_runs.repeated(docs).collect()}
    assert found == {11: [(1, 13)], 13: [(0, 1)], 14: [(1, 5)]}
    lines = {k + 10: [line_runs.digest(x.encode()) for x in t.split("\n")] for k, t in enumerate(texts)}
    want = [(row, at) for row, own in lines.items() for at in range(len(own))]
    levels = levels[:5]  # those of the first call
    for k, level in enumerate(levels):
        own = {(r["_row"], r["at"]): r["rank"] for r in level.collect()}
        prefix = {(r, a): tuple(lines[r][a : a + 2**k]) for r, a in want if a + 2**k <= len(lines[r])}
        shared = Counter(prefix.values())
        order = sorted(x for x, n in shared.items() if n > 1)
        assert own == {place: order.index(x) for place, x in prefix.items() if shared[x] > 1}
    assert [level.isEmpty() for level in levels] == [False] * 4 + [True]


def test_mix_matches_sql(spark, tmp_path):
    rng = random.Random(5)
    sources = [rng.choice(["a", "b", "é", None, "big", "big", "big"]) for _ in range(400)]
    texts = [" ".join("w" * rng.randint(0, 60)) if rng.random() < 0.95 else None for _ in sources]
    documents(spark, texts, sources=sources).write.parquet(str(tmp_path / "documents.parquet"))
    found = sorted(map(tuple, mixing.op4_mix_sources(spark, str(tmp_path)).collect()))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert found == sorted(con.sql(queries.ORACLE["op4_mix_sources"]).fetchall())
    assert all(taken <= 2 * size for _, size, _, _, taken in found)


def test_mix_takes_rows_and_survives_empty_sources(spark):
    docs = documents(spark, ["a b c"] * 30 + [None, ""], sources=["x"] * 30 + ["none", None])
    taken = mixing.take(docs)
    assert taken.columns == docs.columns
    assert sorted(r.doc_id for r in taken.collect()) == sorted(r.doc_id for r in mixing.take(docs).collect())
    assert mixing.take(empty(spark)).count() == 0
    assert mixing.mix(awkward(spark)).count() == 11


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


PARTS = ["a", " ", "  ", "\n", "\t", ".", "'s", "é", "1", "\xa0", "word", " \n", "!", "漢", "\r\n", "　", "\x1c"]


def test_encoding_equals_the_library_and_decodes(spark, tiktoken_encoding, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 400)
    rng = random.Random(6)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(300)] + [None]
    vocabulary = bpe.default_vocabulary()
    tokens = bpe.decode(bpe.encode(documents(spark, texts), vocabulary), vocabulary).collect()
    assert len(tokens) == len(texts)
    for row in tokens:
        text = texts[row.doc_id] or ""
        assert row.ids == tiktoken_encoding.encode_ordinary(text)
        assert bytes(row.data).decode() == text


def test_a_block_that_is_done_leaves_nothing_behind():
    class Word(str):
        """A word that can be watched."""

    keys = pa.StructArray.from_arrays([pa.array([1])], names=["doc_id"])
    block, word, head = bpe.Block(), Word("own"), Word("first")
    block.add(keys, "some words of a text")
    block.index[word], block.heads[head]  # a look-up numbers them
    gone = [weakref.ref(word), weakref.ref(head)]
    block.places.append(np.array([block.index["own"]], np.uint32))
    block.first.append(block.heads["first"])
    block.keys.append(keys)
    gc.disable()
    try:
        assert len(block.rows(0, 4)["block"]) > 1
        del block, word, head
        assert [x() for x in gone] == [None, None]
    finally:
        gc.enable()


def test_encoding_works_on_batches_of_bounded_size(spark, monkeypatch):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, seen, add = spark.conf.get(key), [], bpe.shared_path
    monkeypatch.setattr(bpe, "shared_path", lambda *given: seen.append(spark.conf.get(key)) or add(*given))
    texts = [f"word {k} " * (k % 7) for k in range(50)] + [None]
    found = bpe.encode(documents(spark, texts), bpe.default_vocabulary()).collect()
    assert len(found) == 51 and seen == [str(common.BATCH_BYTES)] and spark.conf.get(key) == before
    ids = pa.array([[1, 2, 3], None, [], [4] * 9, [5]], pa.list_(pa.int32()))
    monkeypatch.setattr(bpe, "DECODED_IDS", 4)
    batch = pa.RecordBatch.from_arrays([ids], names=["ids"])
    slices = [x.column(0).to_pylist() for x in bpe.slices(batch, 0)]
    assert slices == [[[1, 2, 3], None, []], [[4] * 9], [[5]]]
    assert list(bpe.slices(batch.slice(0, 0), 0)) == []


def test_encoding_of_awkward_rows(spark, tiktoken_encoding):
    docs = awkward(spark)
    found = bpe.encode(docs, bpe.default_vocabulary(), keep=("doc_id", "id"))
    want = sorted((str(r.doc_id), len(tiktoken_encoding.encode_ordinary(r.text or ""))) for r in docs.collect())
    assert sorted((str(r.doc_id), len(r.ids)) for r in found.collect()) == want
    assert bpe.encode(empty(spark), bpe.default_vocabulary()).count() == 0


@pytest.mark.parametrize("n", [0, 1, 4095, 4096, 4097, 9000])
def test_segments_come_back(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 1 << 16, n), rng.zipf(1.3, n) % 50_000, np.full(n, 7)):
        assert (range_coder.unpack(range_coder.pack(ids)) == ids).all()


def test_a_damaged_block_is_an_error_and_predictable_ids_are_short():
    data = bytearray(range_coder.pack(np.tile(np.arange(200), 60)))
    assert len(data) < 12_000 / 4
    data[-30] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        range_coder.unpack(bytes(data))


def test_a_full_segment_fills_the_lanes():
    """A step of the coder costs nearly the same for few blocks as for many."""
    blocks = -(-token_files.SEGMENT_IDS // range_coder.BLOCK)
    assert 0.9 * range_coder.LANES <= blocks <= range_coder.LANES


@pytest.mark.parametrize("n", [1, 1025, 5000])
def test_large_ids_come_back(n):
    ids = np.random.default_rng(n).choice([5, 6, 65_535, 65_536, 2**32 - 1, *range(100_000, 100_400)], n)
    assert (range_coder.unpack(range_coder.pack(ids)) == ids).all()
    with pytest.raises(ValueError, match="below"):
        range_coder.pack(np.array([1 << 32]))


def test_a_known_id_is_one_step_of_the_coder(monkeypatch):
    """A block of ids takes a step an id, and two more for each that the counts do not hold."""
    calls, narrow = [], range_coder.Lanes.narrow
    monkeypatch.setattr(range_coder.Lanes, "narrow", lambda *given: calls.append(1) or narrow(*given))
    ids = np.tile(np.arange(8), range_coder.BLOCK // 8 * 3)
    data = range_coder.pack(ids)
    assert len(calls) == range_coder.BLOCK + 2 * 8
    assert (range_coder.unpack(data) == ids).all() and len(calls) == 2 * (range_coder.BLOCK + 2 * 8)


def test_ids_that_come_late_in_their_blocks_are_learned():
    """Every id is counted before the next one is predicted, up to the end of its block."""
    block = np.concatenate([np.tile(np.arange(8), 16), np.tile(np.arange(1_000, 1_007), range_coder.BLOCK // 7)])
    ids = np.tile(block[: range_coder.BLOCK], 8)
    data = range_coder.pack(ids)
    assert (range_coder.unpack(data) == ids).all()
    assert len(data) < len(ids) / 4


def test_all_ids_and_what_follows_them_are_learned():
    """Each of more ids than a table of the most frequent ones would hold is told by the one before."""
    ids = np.tile(np.random.default_rng(4).permutation(6_000) * 11 + 70_000, 40)
    data = range_coder.pack(ids)
    assert (range_coder.unpack(data) == ids).all()
    assert len(data) < len(ids) / 2


def test_words_are_found_once_whatever_their_case_and_signs():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as file:
        content = file.read()
    tokenizer, words, rng = Tokenizer.from_file(path), token_files.words_of(content), random.Random(3)
    assert token_files.words_of(content) is words and words.apart
    words.pieces.clear()
    texts = ["Thane thane, THANE!! (thane)\nthane", "", None, " \n  ", "a"]
    ids, sizes = words.encode(pa.array(texts, pa.string()))
    assert set(words.pieces) == {b"thane", b",", b"!!", b"(", b")", b"a"}
    parts = [
        "Été", "ÀÖØ×Þß÷ÿ", "École!!", "don't", "'s", "a'T", "4.0,", "a1b", "<|endoftext|>", "x<|ENDOFTEXT|>.", "<a|b>", "İ", "Σ", "ﬁ", "e\u0301",
        "e", "\u0301", "\t", "\x1c", "a\u00a0b", ".,!&&&", "|", "漢字a", "\u00b5", "\u00aa", "the", "ing", "##", " ", "\n",
    ]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(300)]
    array = pa.array(["cut off", *texts, "too"], pa.string()).slice(1, len(texts))
    ids, sizes = words.encode(array)
    found = np.split(ids, np.cumsum(sizes)[:-1])
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [f.tolist() for f in found] == want
    other = content.replace(r"[\\p{L}]+|", r"[\\p{L}.]+|")  # a tokenizer that does not split letters from signs
    whole = token_files.Words(other)
    assert other != content and not whole.apart
    ids, sizes = whole.encode(array)
    tokenizer = Tokenizer.from_str(other)
    assert ids.tolist() == [i for t in texts for i in tokenizer.encode(t or "", add_special_tokens=False).ids]


def test_token_files_hold_ids_in_order(spark, monkeypatch, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as file:
        content = file.read()
    tokenizer, rng = Tokenizer.from_file(path), random.Random(7)
    parts = [*PARTS, "É", "Σ", "<|endoftext|>", "́"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(120)] + [None, ""]
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 500)
    token_files.write_tokens(documents(spark, texts).orderBy(F.rand(1)), content, str(tmp_path / "t"))
    rows = sorted(token_files.read_tokens(spark, str(tmp_path / "t")).collect(), key=lambda r: r.doc_id)
    start = 0
    for row, text in zip(rows, texts, strict=True):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        assert (row.start, row.ids) == (start, ids)
        start += len(ids)
    token_files.write_tokens(awkward(spark), content, str(tmp_path / "a"))
    assert token_files.read_tokens(spark, str(tmp_path / "a")).count() == 11
    token_files.write_tokens(empty(spark), content, str(tmp_path / "e"))
    assert token_files.read_tokens(spark, str(tmp_path / "e")).count() == 0


SMALL = "/root/testdata/sf0.001"


def test_registered_queries_read_whole_tables(spark):
    count = lambda name: spark.read.parquet(f"{SMALL}/{name}.parquet").count()
    tables = {"op1": "embeddings", "op7": "pages"}
    for name, query in queries.REGISTRY.items():
        if name.startswith("op13"):  # a row per phrase
            continue
        assert query(spark, SMALL).count() == count(tables.get(name.split("_")[0], "documents")), name


def test_pipeline_matches_its_stages_in_plain_python(spark, tiktoken_encoding):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = [(r.doc_id, r.text, r.source) for r in corpus_pipeline.quality_rules(spark, docs, SMALL).collect()]
    kept.sort()
    texts = plain_runs([t for _, t, _ in kept], line_runs.LEAST_WORDS)
    kept = [(i, t, s) for (i, old, s), t in zip(kept, texts) if WORD.search(t) or not WORD.search(old)]
    sets = {i: shingles(t) for i, t, _ in kept}
    similar = lambda a, b: a and b and 100 * len(a & b) >= 80 * len(a | b)
    links = [(a, b) for a in sets for b in sets if b < a and similar(sets[a], sets[b])]
    roots = smallest_reachable(sets, links)
    kept = [x for x in kept if roots[x[0]] == x[0]]
    rows = documents(spark, [t for _, t, _ in kept], sources=[s for *_, s in kept])
    ids = spark.createDataFrame([(k, i) for k, (i, *_) in enumerate(kept)], "doc_id long, real long")
    rows = rows.join(ids, "doc_id").withColumn("doc_id", F.col("real")).drop("real")
    mixed = mixing.take(rows).collect()
    digest = lambda ids: zlib.crc32(hashlib.md5(str(ids).encode()).digest())
    want = sorted((r.doc_id, r.source, digest(tiktoken_encoding.encode_ordinary(r.text))) for r in mixed)
    found = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted((r.doc_id, r.source, digest(r.ids)) for r in found) == want
    assert all(r.n_tokens == len(r.ids) for r in found)


def test_rows_with_one_id_or_none_stay_or_go_by_their_own_text(spark):
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(40)) for x in "abcd")
    rows = [(1, a), (2, f"{a} more"), (2, b), (None, c), (None, c), (3, c), (None, d), (4, None), (4, None), (5, b)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "x", 1) for i, t in rows], empty(spark).schema)
    found = corpus_pipeline.near_duplicates(spark, docs, SMALL)
    assert found.columns == docs.columns
    want = [(1, a), (2, b), (None, c), (None, d), (4, None), (4, None)]
    assert sorted(map(str, found.select("doc_id", "text").collect())) == sorted(
        map(str, spark.createDataFrame(want, "doc_id long, text string").collect())
    )
    assert corpus_pipeline.near_duplicates(spark, empty(spark), SMALL).count() == 0


def test_ids_of_the_pipeline_are_decoded_and_compared(spark, monkeypatch):
    texts = ["Plain words,  and\tmore\n", "é　漢 \x1c x", "", None]
    found = corpus_pipeline.token_ids(spark, documents(spark, texts), SMALL).collect()
    digest = lambda text: hashlib.sha256((text or "").encode()).hexdigest()
    assert {r.doc_id: r.decoded_sha256 for r in found} == {i: digest(t) for i, t in enumerate(texts)}

    def wrong(docs, vocabulary, keep):
        return bpe.encode(docs.withColumn("text", F.concat("text", F.lit("!"))), vocabulary, keep)

    monkeypatch.setattr(corpus_pipeline, "encode", wrong)
    with pytest.raises(Exception, match="ids do not decode to the text"):
        corpus_pipeline.token_ids(spark, documents(spark, texts), SMALL).collect()

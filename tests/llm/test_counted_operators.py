"""Repeated windows, importance resampling and collocations: against brute force and DuckDB."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import compare
from fairwait.llm import collocations, queries, repeated_windows, resampling
from helpers import LOWER, WORD, awkward, documents, empty

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


# --- repeated windows --------------------------------------------------------------


def plain_windows(rows, size):
    """(n_words, n_removed, digest) per row of (doc_id, text), in the order of the rows."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    words = [WORD.findall(text or "") for _, text in rows]
    seen, gone = set(), defaultdict(set)
    for i in order:
        for start in range(len(words[i]) - size + 1):
            window = tuple(words[i][start : start + size])
            if window in seen:
                gone[i].update(range(start, start + size))
            seen.add(window)
    found = []
    for i, w in enumerate(words):
        kept = " ".join(x for k, x in enumerate(w) if k not in gone[i])
        found.append((len(w), len(gone[i]), hashlib.sha256(kept.encode()).hexdigest()))
    return found


def repetitive(seed, n=60):
    pick = random.Random(seed)
    words = [f"w{k}" for k in range(30)] + ["é", "漢", "a\x1cb"]
    passages = [[pick.choice(words) for _ in range(pick.randrange(5, 40))] for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = [pick.choice(passages) if pick.random() < 0.5 else pick.choices(words, k=pick.randrange(12)) for _ in range(4)]
        texts.append(pick.choice([" ", "\n", "\t\v "]).join(" ".join(p) for p in parts))
    return [*texts, None, "", " \n ", texts[0], "x " * 50, "x " * 50]


@pytest.mark.parametrize("block_words", [1, 60, 10_000])
@pytest.mark.parametrize("size", [1, 5, 20])
def test_windows_go_as_by_brute_force(spark, size, block_words):
    texts = repetitive(size)
    docs = documents(spark, texts).withColumn("row", F.lit("mine")).repartition(3)
    found = repeated_windows.without_windows(docs, size, block_words=block_words).orderBy("doc_id").collect()
    want = plain_windows(list(enumerate(texts)), size)
    assert [(r["_words"], r["_removed"], r["_sha256"]) for r in found] == want
    assert {r["row"] for r in found} == {"mine"} and found[0].asDict().keys() >= set(docs.columns)
    for row, text, (n, gone, digest) in zip(found, texts, want):
        assert row.n_chars == (None if text is None else len(row.text))
        assert row.text == text if not gone else hashlib.sha256(row.text.encode()).hexdigest() == digest


def test_windows_of_awkward_rows(spark):
    """Repeated ids are rows of their own, NULL comes first."""
    rows = awkward(spark).coalesce(1)
    found = repeated_windows.without_windows(rows, 3)
    plain = plain_windows([(r.doc_id, r.text) for r in rows.collect()], 3)
    assert Counter((r["_words"], r["_removed"], r["_sha256"]) for r in found.collect()) == Counter(plain)
    assert found.where("doc_id is null").first()["_removed"] == 0
    assert found.where("doc_id = 5 and _removed = 6").count() == 2
    assert repeated_windows.without_windows(empty(spark)).count() == 0


def test_ids_of_text_are_numbered(spark):
    rows = [("b", "x y z"), ("a", "x y z"), (None, "q")]
    found = repeated_windows.without_windows(spark.createDataFrame(rows, "doc_id string, text string"), 3)
    assert {r.doc_id: r["_removed"] for r in found.collect()} == {"b": 3, "a": 0, None: 0}


def test_places_survive_packing():
    rng = np.random.default_rng(3)
    rows = np.sort(rng.integers(-5, 5, 500))
    starts = np.concatenate([np.sort(rng.choice(1 << 25, n, replace=False)) for n in np.unique(rows, return_counts=True)[1]])
    for got, want in zip(repeated_windows.unpacked_places(repeated_windows.packed_places(rows, starts)), (rows, starts)):
        assert np.array_equal(got, want)
    none = repeated_windows.packed_places(rows[:0], starts[:0])
    assert [len(x) for x in repeated_windows.unpacked_places(none)] == [0, 0]


def test_rolling_is_the_polynomial():
    values = np.random.default_rng(4).integers(0, 1 << 63, 50).astype(np.uint64)
    for family in (0, 1):
        m = repeated_windows.MULTIPLIERS[family]
        want = [sum(int(values[i + j]) * pow(m, j) for j in range(7)) % (1 << 64) for i in range(44)]
        assert repeated_windows.rolling(values, family, 7).tolist() == want


# --- importance resampling ---------------------------------------------------------


def plain_resampling(docs, target, percent=5, least_words=20):
    def found(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        runs = [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]
        return len(words), [zlib.crc32(r.encode()) % 10_000 for r in runs]

    s, t = (Counter(b for text in side for b in found(text)[1]) for side in ([x for _, x in docs], target))
    all_s, all_t = s.total() + 10_000, t.total() + 10_000
    gain = [math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in range(10_000)]
    rows = []
    for doc_id, text in docs:
        n, buckets = found(text)
        h = int(hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in buckets)
        rows.append((doc_id, n, len(buckets), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= least_words), key=lambda r: (-r[4], r[0]))
    ranks = {r[0]: k for k, r in enumerate(able[: percent * len(able) // 100], 1)}
    return {r[0]: (r[2], r[3], r[4], ranks.get(r[0])) for r in rows}


def test_the_registered_query_ranks_as_by_brute_force(spark):
    read = lambda name, columns: duckdb.sql(f"select {columns} from '{SF_DIR}/{name}.parquet'").fetchall()
    want = plain_resampling(read("documents", "doc_id, text"), [x for (x,) in read("benchmark", "text")])
    found = queries.REGISTRY["op12_importance_resampling"](spark, SF_DIR)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {kind for _, kind in found.dtypes} == {"bigint"}
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == want


def test_features_of_hostile_texts():
    n, buckets = resampling.features("A-b\x00É".encode() * 3 + b"\xff@")
    words = ["a", "b", "Éa", "b", "Éa", "b"]
    assert n == 7 and len(buckets) == 7 + 6 + 5
    assert buckets[:6].tolist() == [zlib.crc32(w.encode()) % 10_000 for w in words]
    assert resampling.features(b"")[0] == 0 and len(resampling.features(b"")[1]) == 0
    assert resampling.features(b"a" * 5_000_000)[0] == 1
    assert resampling.features(b"- " * 1_000_000)[0] == 0


@pytest.mark.parametrize("bits, block", [(1, 4), (3, 7), (11, 1 << 18)])
def test_radix_ranks_sort_stably(spark, bits, block):
    pick = random.Random(bits)
    extremes = [-(1 << 63), (1 << 63) - 1, 0, -1] if bits == 11 else [0, 3]
    rows = [(at << 20, pick.choice([5, 6, 9]), pick.choice(extremes)) for at in pick.sample(range(90), 90)]
    table = spark.createDataFrame(rows, "at long, a long, b long")
    found = resampling.radix_ranks(table, ["a", "b"], bits, block)
    want = [at for at, _, _ in sorted(rows, key=lambda r: (r[1], r[2], r[0]))]
    assert [r["at"] for r in found.orderBy("position").collect()] == want
    assert [r["position"] for r in found.orderBy("position").collect()] == list(range(90))


def test_one_key_of_all_rows_and_none(spark):
    table = spark.range(50).select(F.col("id").alias("at"), F.lit(7).cast("long").alias("a"))
    found = resampling.radix_ranks(table, ["a"], 4, 8)
    assert found.where("at <> position").count() == 0 and found.count() == 50
    assert resampling.radix_ranks(table.where("false"), ["a"]).count() == 0


def test_resampling_of_awkward_rows(spark):
    target = spark.createDataFrame([("w1 w2 w3",), (None,), ("",)], "text string")
    docs = awkward(spark).withColumn("score", F.lit("mine")).withColumn("at", F.lit(1))
    found = resampling.resampled(docs, target, percent=100, least_words=1)
    rows = found.collect()
    assert len(rows) == docs.count() and set(found.columns) >= {"doc_id", "n_features", "weight", "score", "rank"}
    ranked = sorted((r for r in rows if r["rank"]), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, sum(r.n_words > 0 for r in rows) + 1))
    keys = [(-r.score, r.doc_id is not None, r.doc_id or 0) for r in ranked]
    assert keys == sorted(keys)
    assert all(r.weight == 0 and r.n_features == 0 and r["rank"] is None for r in rows if not r.n_words)
    assert resampling.resampled(empty(spark), target).count() == 0
    assert resampling.resampled(docs, target.where("false")).count() == len(rows)


# --- collocations ------------------------------------------------------------------


def plain_collocations(rows, least, top=2000, percent=50):
    f = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\n\v\f\r]", (text or "").translate(LOWER)):
            words = re.findall(r"[^ \t]+", piece)
            for k in (1, 2, 3):
                f["und" if lang is None else lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    found = set()
    for lang, counts in f.items():
        n = sum(c for w, c in counts.items() if len(w) == 1)
        kept = []
        for w, a in counts.items():
            if len(w) == 1 or a < least:
                continue
            longer = [b for v, b in counts.items() if len(v) > len(w) and b >= least and w in (v[:2], v[1:])]
            if any(100 * b >= percent * a for b in longer):
                continue
            cuts = [(counts[w[:k]], counts[w[k:]], k) for k in range(1, len(w))]
            score, _, left, right = min((math.floor(Fraction(10**6 * a * a, x * y)), k, x, y) for x, y, k in cuts)
            kept.append((-score, -a, " ".join(w).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            found.add((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return found


def chatter(seed, n=80):
    pick = random.Random(seed)
    words = ["a", "b", "B", "c\x01", "c", "é", "漢", "new", "york", "city", "x\x1cy"]
    texts = []
    for _ in range(n):
        parts = [pick.choice(["new york city", "New York", "a b", pick.choice(words), pick.choice(words)]) for _ in range(12)]
        texts.append("".join(p + pick.choice([" ", " ", "\t", "  ", ".", "!\n", "\v"]) for p in parts))
    return [(pick.choice(["en", "en", "de", None, "und", "e\nn", "en\n", "e n", ""]), t) for t in texts] + [("en", None), (None, ""), ("fr", " . ")]


@pytest.mark.parametrize("least, top, block", [(10, 2000, 400_000), (2, 7, 5), (1, 2000, 40)])
def test_collocations_as_by_brute_force(spark, least, top, block):
    rows = chatter(least)
    docs = spark.createDataFrame(rows, "lang string, text string").withColumn("n", F.lit("mine")).repartition(3)
    found = collocations.collocations(docs, least, top, block_words=block)
    assert {tuple(r) for r in found.collect()} == plain_collocations(rows, least, top)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_prefixes_that_partitions_cut(spark):
    """One word begins nearly all grams, and its grams lie in many partitions."""
    text = " ".join(f"the k{i % 50} the" for i in range(600))
    docs = spark.createDataFrame([("en", text)] * 3, "lang string, text string")
    cuts = [b"en\xffthe k1 ", b"en\xffthe k2 the ", b"en\xffthe k3 ", b"en\xffthe k30"]
    grams = collocations.gram_blocks(docs, cuts).repartitionById(5, "part").sortWithinPartitions("key")
    found = collocations.prefix_counts(grams, 10).groupBy("phrase", "words").agg(F.sum("n").alias("n"))
    counts = {(bytes(r.phrase), r.words): r.n for r in found.collect()}
    assert counts[(b"the", 1)] == 3600 and counts[(b"", 0)] == 5400 and counts[(b"the the", 2)] == 3 * 599


def test_scores_beyond_64_bits(spark):
    row = spark.range(1).select(F.lit(3 * 10**15).alias("a"), F.lit(3 * 10**15).alias("l"), F.lit(3 * 10**15 + 1).alias("r"))
    assert row.select(collocations._score(F.col("a"), F.col("l"), F.col("r"))).first()[0] == 999_999


def test_no_documents_no_collocations(spark):
    assert collocations.collocations(empty(spark)).count() == 0
    assert collocations.collocations(awkward(spark), least=1).where("lang = 'en'").count() > 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_registered_query_and_sql(spark, name):
    with compare.connect(SF_DIR) as con:
        assert compare.differences(queries.REGISTRY[name](spark, SF_DIR), con, queries.ORACLE[name]) == []

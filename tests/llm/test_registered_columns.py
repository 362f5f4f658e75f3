"""The columns of registered queries against the libraries and expressions that define them, over a whole table."""

import base64
import hashlib
import os
import re
import zlib

import duckdb
import numpy as np
import pytest

from fairwait.llm import queries

public_tokenizers = pytest.importorskip("public_tokenizers")
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def texts():
    return duckdb.sql(f"select doc_id, coalesce(text, '') from '{SF_DIR}/documents.parquet' order by doc_id").fetchall()


def rows(spark, name):
    return {r["doc_id"]: r for r in queries.REGISTRY[name](spark, SF_DIR).collect()}


def test_token_files_hold_the_ids_of_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    tokenizer = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found, start = rows(spark, "op2_token_files"), 0
    for doc_id, text in texts():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
        r = found.pop(doc_id)
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not found


def test_byte_bpe_has_the_ids_of_the_library(spark):
    tiktoken = pytest.importorskip("tiktoken")
    lines = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found, sha = rows(spark, "op3_byte_bpe"), lambda data: hashlib.sha256(data).hexdigest()
    for doc_id, text in texts():
        ids, r = encoding.encode_ordinary(text), found.pop(doc_id)
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), sha(" ".join(map(str, ids)).encode()))
        assert r["decoded_sha256"] == sha(text.encode())
    assert not found


def luhn(digits):
    doubled = [int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


ONLY_DIGITS = lambda s: re.sub("[^0-9]", "", s)
ASSIGN = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
SECRETS = {
    "assign": (ASSIGN, lambda m: len(m[2]) >= 12),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 16),
}
PERSONAL = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(ONLY_DIGITS(m[0])) <= 19 and luhn(ONLY_DIGITS(m[0]))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(ONLY_DIGITS(m[0])) <= 15),
}


@pytest.mark.parametrize("name, kinds", [("op8_scan_secrets", SECRETS), ("op9_find_personal_data", PERSONAL)])
def test_base_spans_of_whole_texts(spark, name, kinds):
    found, order = rows(spark, name), list(kinds)
    for doc_id, text in texts():
        spans = [(m.start(), k, m.end()) for k, (p, holds) in kinds.items() for m in re.finditer(p, text) if holds(m)]
        spans.sort(key=lambda s: (s[0], order.index(s[1])))
        listed = ",".join(f"{k}:{start}:{end}" for start, k, end in spans)
        r = found.pop(doc_id)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in order] == [sum(s[1] == k for s in spans) for k in order]
        assert set(filter(None, listed.split(","))) <= set(r["spans"].split(","))
    assert not found

"""Personal data: fixed patterns, and a skip-chain conditional random field that adds to them.

A document's candidate tokens, those with a digit or an at sign, are the nodes of a field. Each
has a label: none or one of the four kinds. Neighbours in the text are linked as a chain, and
each token is linked by skip edges to the next one with the same letters and digits and to the next similar one: of
the same email domain, or with the same last four digits. Potentials
of nodes, chain and skip edges are trained by pseudo-likelihood on a bounded sample of tokens
that the patterns label. Loopy message passing then settles the labels of tokens that no
pattern covers, with those that one covers held fixed.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairwait.llm.common import table
from fairwait.llm.spans import SPAN_ARROW, SPAN_TYPE, span_columns

KINDS = ("email", "ip", "card", "phone")
ADDED = tuple(f"likely_{kind}" for kind in KINDS)  # spans of the field carry these names
LABELS = ("none", *KINDS)
SAMPLE_DOCS = 4_000  # about so many documents are looked at for training
SAMPLE_TOKENS = 20_000  # and at most so many of their tokens
ROUNDS = 12
SURE = 0.9

# Fixed by the contract.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Runs of digits are taken whole and from their start, so that a long one is read once.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

SIGN = re.compile(r"[0-9@]")
TOKEN_END = re.compile(r"[\x20\x09-\x0D]")
SPACES = frozenset(" \t\n\v\f\r")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def in_byte(digits: str) -> bool:
    """Whether a number is 255 at most; a run of digits may be too long for ``int``."""
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Every start in the run before an at sign meets the same sign, so the first one decides."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            done = match.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns by start, then kind."""
    found = [("email", *span) for span in emails(text)]
    found += [
        ("ip", *m.span()) for m in IP.finditer(text) if all(map(in_byte, m[0].split(".")))
    ]
    for m in CARD.finditer(text):
        digits = digits_of(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 10 <= len(digits_of(m[0])) <= 15:
            found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def tokens_of(text: str) -> list[tuple[int, int]]:
    """Words that hold a digit or an at sign."""
    found, done = [], 0
    for m in SIGN.finditer(text):
        if m.start() >= done:
            start = m.start()
            while start > done and text[start - 1] not in SPACES:
                start -= 1
            end = TOKEN_END.search(text, m.end())
            done = end.start() if end else len(text)
            found.append((start, done))
    return found


def shape(word: str) -> list[int]:
    """Numbers of the features that hold for a token, below ``SHAPES``."""
    bare = word.strip(".,;:!?()[]\"'")
    digits = digits_of(bare)
    n = len(digits)
    letters = sum(c.isalpha() for c in bare)
    parts = bare.split(".")
    quad = len(parts) == 4 and all(p.isdecimal() and p.isascii() for p in parts)
    holds = (
        True,
        "@" in bare,
        "@" in bare and "." in bare.rpartition("@")[2],
        bare.startswith("+"),
        word.startswith("("),
        "-" in bare,
        quad,
        quad and all(len(p) < 4 and int(p) <= 255 for p in parts),
        14 <= n <= 19,
        14 <= n <= 19 and luhn(digits),
        10 <= n <= 15,
        not letters,
        0 < letters < n,
        letters >= n,
        "=" in bare or ":" in bare,
    )
    width = sum(n >= k for k in (1, 2, 3, 4, 5, 7, 9, 12, 14, 20))
    return [k for k, on in enumerate(holds) if on] + [len(holds) + width]


SHAPES = 15 + 11


def alike(word: str) -> str:
    """What similar tokens share: the domain of an email, else the last four digits; '' without either."""
    bare = word.strip(".,;:!?()[]\"'")
    domain = bare.rpartition("@")[2].lower()
    if "@" in bare and "." in domain:
        return f"@{domain}"
    digits = digits_of(bare)
    return digits[-4:] if len(digits) >= 4 else ""


def field_of(text: str):
    """Spans of the patterns, tokens, shapes, fixed labels (-1: open), chain and skip edges."""
    spans, tokens = base_spans(text), tokens_of(text)
    labels, k = [], 0
    for start, end in tokens:
        while k < len(spans) and spans[k][2] <= start:
            k += 1
        covering = next((s for s in spans[k : k + 4] if s[1] < end and s[2] > start), None)
        labels.append(LABELS.index(covering[0]) if covering else -1)
    chain = [(i, i + 1) for i in range(len(tokens) - 1) if tokens[i + 1][0] - tokens[i][1] <= 2]
    last, skip = {}, []
    for i, (start, end) in enumerate(tokens):
        key = "".join(c for c in text[start:end].lower() if c.isalnum())
        near = alike(text[start:end])
        keys = [("same", key)] * (len(key) > 3) + [("alike", near)] * bool(near)
        skip += sorted({(last[k], i) for k in keys if k in last})
        last.update(dict.fromkeys(keys, i))
    return spans, tokens, [shape(text[a:b]) for a, b in tokens], labels, chain, skip


def training_rows(doc_key: str, text: str) -> Iterator[dict]:
    """A row per token: shapes, label, and the labels of its neighbours by kind of edge."""
    _, tokens, shapes, labels, chain, skip = field_of(text)
    near: list[list[int]] = [[] for _ in tokens]
    for offset, edges in ((0, chain), (2, skip)):
        for a, b in edges:
            near[b].append(SHAPES + offset * 5 + max(labels[a], 0))
            near[a].append(SHAPES + (offset + 1) * 5 + max(labels[b], 0))
    for (start, _), on, label, more in zip(tokens, shapes, labels, near):
        yield {
            "order": zlib.crc32(f"{doc_key}:{start}".encode()),
            "features": on + more,
            "label": max(label, 0),
        }


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_tokens: int = SAMPLE_TOKENS) -> np.ndarray:
    """Weights (features, labels); features are shapes, then the label of the neighbour before
    and after in the chain, then over skip edges.

    Documents of the sample are chosen by a hash of their id, tokens by a hash of id and place,
    so reruns agree. The driver receives at most ``sample_tokens`` short rows.
    """
    every = max(1, docs.count() // sample_docs)
    chosen = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                row
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for row in training_rows(str(key), text or "")
            ]
            yield pa.RecordBatch.from_pylist(out, TRAINING)

    sample = (
        chosen.select("doc_id", "text")
        .mapInArrow(rows, "order long, features array<int>, label int")
        .orderBy("order", "features", "label")
        .limit(sample_tokens)
        .collect()
    )
    width = SHAPES + 4 * len(LABELS)
    x = np.zeros((len(sample), width))
    y = np.zeros((len(sample), len(LABELS)))
    for i, row in enumerate(sample):
        np.add.at(x[i], row.features, 1.0)
        y[i, row.label] = 1.0
    weights = np.zeros((width, len(LABELS)))
    for _ in range(300 if len(sample) else 0):
        scores = x @ weights
        p = np.exp(scores - scores.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        weights += 0.5 * (x.T @ (y - p) / len(sample) - 1e-4 * weights)
    return weights


TRAINING = pa.schema([("order", pa.int64()), ("features", pa.list_(pa.int32())), ("label", pa.int32())])


def beliefs(weights, shapes, labels, chain, skip) -> np.ndarray:
    """Marginals (token, label) by loopy message passing over all edges at once."""
    n, size = len(shapes), len(LABELS)
    node = np.array([weights[on].sum(axis=0) for on in shapes])
    for i, label in enumerate(labels):
        if label >= 0:
            node[i] = np.where(np.arange(size) == label, 0.0, -50.0)
    tables = weights[SHAPES:].reshape(4, size, size)
    # The weight of a pair is learned once from each end; its potential is their mean.
    pair = [(tables[0] + tables[1].T) / 2, (tables[2] + tables[3].T) / 2]
    edges = np.array(chain + skip, dtype=int).reshape(-1, 2)
    potential = np.array([pair[0]] * len(chain) + [pair[1]] * len(skip)).reshape(-1, size, size)
    source = np.concatenate([edges[:, 0], edges[:, 1]])
    target = np.concatenate([edges[:, 1], edges[:, 0]])
    potential = np.concatenate([potential, potential.transpose(0, 2, 1)])
    back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    message = np.zeros((len(source), size))
    for _ in range(ROUNDS):
        total = node.copy()
        np.add.at(total, target, message)
        sent = (total[source] - message[back])[:, :, None] + potential
        top = sent.max(axis=1, keepdims=True)
        new = (np.log(np.exp(sent - top).sum(axis=1)) + top[:, 0]).reshape(-1, size)
        new -= new.max(axis=1, keepdims=True)
        message = 0.5 * message + 0.5 * new
    total = node.copy()
    np.add.at(total, target, message)
    p = np.exp(total - total.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def spans_with(weights: np.ndarray, text: str) -> list[tuple[str, int, int]]:
    """Spans of the patterns and those that the field adds, by start, then kind."""
    if not SIGN.search(text):
        return []
    spans, tokens, shapes, labels, chain, skip = field_of(text)
    open_tokens = [i for i, label in enumerate(labels) if label < 0]
    if open_tokens and len(weights):
        p = beliefs(weights, shapes, labels, chain, skip)
        for i in open_tokens:
            label = int(p[i, 1:].argmax()) + 1
            if p[i, label] >= SURE:
                start, end = tokens[i]
                word = text[start:end]
                start += len(word) - len(word.lstrip("([\"'"))
                end -= len(word) - len(word.rstrip(".,;:!?)]\"'"))
                if start < end:
                    spans.append((ADDED[label - 1], start, end))
    return sorted(spans, key=lambda s: (s[1], (KINDS + ADDED).index(s[0])))


def find_personal_data(docs: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """(doc_id, spans) for every row of ``docs`` (doc_id, text, any others).

    Spans are in code points, end exclusive, by start and then kind. NULL, empty and digit-free
    text has none; NULL and repeated ids are kept row by row; an empty table gives an empty one
    and trains nothing. The field of a document lies in its own row, so nothing is shuffled
    but the bounded training sample. Edges link a token to the next of its kinds only, so there
    are at most three a token however often one repeats.
    """
    fitted = train(docs) if weights is None else weights

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [
                [{"kind": k, "start": s, "end": e} for k, s, e in spans_with(fitted, text or "")]
                for text in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, SPAN_ARROW)], names=["doc_id", "spans"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(find, f"doc_id {kind}, spans {SPAN_TYPE}")


def op9_find_personal_data(spark, sf_dir):
    """Counts and digest are of the fixed patterns alone; ``spans`` holds the added ones too."""
    found = find_personal_data(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *span_columns(F.col("spans"), KINDS))

"""Secret scans: all rules as one minimised automaton, one pass over the bytes of a text."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairwait.llm.automaton import Scanner
from fairwait.llm.common import table
from fairwait.llm.spans import SPAN_ARROW, SPAN_TYPE, span_columns, to_code_points


class Rule(NamedTuple):
    kind: str
    pattern: str
    least: int = 0  # bytes of the match
    least_value: int = 0  # bytes after the assignment sign


def either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


KEYS = "|".join([*map(either_case, ("password", "passwd", "secret", "token")), either_case("api") + "_?" + either_case("key")])

# Fixed by the contract. A run of 16 or more hexadecimal digits is the same as a run that is
# dropped when shorter, and is found without stopping at every short run.
BASE = (
    Rule("assign", rf"({KEYS})[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=\-]+", least_value=12),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]{16,}"),
)
# Formats of public services and files; they add spans. Each rule that ends in a run of letters and
# digits can be open beside the others, which multiplies the states: add them sparingly.
MORE = (
    Rule("private_key", r"-----BEGIN\x20([A-Z0-9]+\x20)*PRIVATE\x20KEY-----"),
    Rule("git_token", r"gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9\-]+", least=20),
)
BASE_KINDS = tuple(r.kind for r in BASE)


def value_length(match: bytes) -> int:
    """Bytes after the sign, spaces and opening quote of an assignment."""
    sign = min(k for k in (match.find(b":"), match.find(b"=")) if k >= 0)
    value = match[sign + 1 :].lstrip(b" ")
    return len(value) - (value[:1] in (b'"', b"'"))


def spans_of(text: str | None, scanner: Scanner, rules) -> list[tuple[str, int, int]]:
    data = (text or "").encode("utf-8", "surrogatepass")
    kept = [
        (k, start, end)
        for k, start, end in scanner.scan(data)
        if end - start >= rules[k].least
        and (not rules[k].least_value or value_length(data[start:end]) >= rules[k].least_value)
    ]
    kept.sort(key=lambda s: (s[1], s[0]))
    return [(rules[k].kind, start, end) for k, start, end in to_code_points(data, kept)]


@lru_cache
def scanner_of(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner([r.pattern for r in rules])


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """(doc_id, spans) for every row of ``docs`` (doc_id, text, any others).

    Spans are in code points, end exclusive, by start and then in the order of ``rules``. NULL and
    empty text has none; NULL and repeated ids are kept row by row; an empty table gives an empty
    one. A row is scanned whole where it is read, without a shuffle; the compiled tables
    (some hundred KB) travel with the task.
    """
    scanner = scanner_of(rules)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [
                [{"kind": k, "start": s, "end": e} for k, s, e in spans_of(text, scanner, rules)]
                for text in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, SPAN_ARROW)], names=["doc_id", "spans"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {kind}, spans {SPAN_TYPE}")


def op8_scan_secrets(spark, sf_dir):
    found = scan_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *span_columns(F.col("spans"), BASE_KINDS))

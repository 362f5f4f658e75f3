"""Small tables with the awkward cases of every operator, and brute-force versions of words and shingles."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, n long"


def documents(spark, texts, **columns):
    """Rows with columns whose names clash with those that operators use inside."""
    rows = [
        (i, t, "en", columns.get("sources", ["s"] * len(texts))[i], len(t or ""), "x", 1)
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def awkward(spark):
    """NULL, empty, blank and very long texts, ties, repeated rows and ids, a NULL id."""
    long = " ".join(f"w{i % 9973}" for i in range(60_000))
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, long), (5, "a b c d e f"), (5, "a b c d e f"),
        (5, "another text of one id"), (None, "a b c d e f"), (6, "one"), (7, "one"), (8, "é　漢 \x1c x"),
    ]
    return spark.createDataFrame([(i, t, "en", None, None, "x", 1) for i, t in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def smallest_reachable(nodes, links):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}

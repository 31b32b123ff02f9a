"""Plain versions of what the operators compute, and odd rows that every operator has to take."""

from __future__ import annotations

import re
from collections import Counter

import xxhash

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Null and blank texts, nulls in any column, repeated rows, one long text, signs outside the basic plane.
ODD = [
    (1, None, "en", "a", None),
    (2, "", None, None, 0),
    (3, " \n\t ", "fr", None, 4),
    (None, "no id here", "en", "b", 10),
    (4, "twice the same row", "en", "a", 18),
    (4, "twice the same row", "en", "a", 18),
    (5, "word " * 50_000, "en", "a", 250_000),
    (6, "x" * 200_000, "de", "a", 200_000),
    (7, "é \U0001f600 \U0001f600 ünïcode\x00 text", "de", "c", 20),
    (-8, "12 34 56", None, "c", 8),
]


def odd_documents(spark, extra: tuple[str, ...] = ()):
    """The odd rows, with extra columns of the given names."""
    df = spark.createDataFrame(ODD, DOCS)
    return df.selectExpr("*", *(f"'kept' AS `{name}`" for name in extra))


def no_documents(spark):
    return spark.createDataFrame([], DOCS)


def fingerprint(text: str | None, words: int = 3) -> int:
    parts = (text or "").encode().lower().split()
    runs = [b" ".join(parts[i : i + words]) for i in range(len(parts) - words + 1)] or ([b" ".join(parts)] if parts else [])
    ones = Counter(b for r in runs for b in range(64) if xxhash.xxh64_intdigest(r, seed=42) >> b & 1)
    return sum(1 << b for b, n in ones.items() if 2 * n > len(runs))


def union(nodes, links) -> dict:
    """The least node that each one is linked to."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def luhn(digits: str) -> bool:
    doubled = [int(c) * (2 if k % 2 else 1) for k, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The contract's patterns, as they are written there."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out

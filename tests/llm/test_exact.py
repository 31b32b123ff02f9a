"""Exact dedup by a minimal perfect hash over history."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from noticeworks.llm import exact
from noticeworks.llm.queries import QUERIES
from tests.llm.helpers import DOCS, ODD, SF, no_documents, odd_documents


def digest(text: str | None) -> bytes:
    return sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).digest()


def plain(rows: list[tuple]) -> Counter:
    """(id, keep_id, group_size, kept) of (id, text) rows; null ids last."""
    of = defaultdict(list)
    for id_, text in rows:
        of[digest(text)].append(id_)
    out = []
    for text_digest, ids in of.items():
        ids.sort(key=lambda i: (i is None, i or 0))
        out += [(i, ids[0], len(ids), k == 0, text_digest) for k, i in enumerate(ids)]
    return Counter(out)


def decided(df) -> Counter:
    return Counter((r["id"], r["keep_id"], r["group_size"], r["kept"], bytes(r["digest"])) for r in df.collect())


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 20_000])
def test_hash_is_minimal_and_every_byte_is_checked(n):
    digests = np.random.default_rng(n).integers(0, 256, (n, exact.WIDTH), dtype=np.uint8)
    hashed, order = exact.PerfectHash.of(digests)
    assert sorted(order) == list(range(n))
    assert (order[hashed.slots(digests, digests[order])] == np.arange(n)).all()
    for byte in range(exact.WIDTH):
        other = digests.copy()
        other[:, byte] ^= 1
        assert (hashed.slots(other, digests[order]) == -1).all()


def test_what_no_level_takes_is_listed(monkeypatch):
    monkeypatch.setattr(exact, "LEVELS", 1)
    digests = np.random.default_rng(1).integers(0, 256, (500, exact.WIDTH), dtype=np.uint8)
    hashed, order = exact.PerfectHash.of(digests)
    assert len(hashed.rest) > 50
    assert (order[hashed.slots(digests, digests[order])] == np.arange(500)).all()


@pytest.mark.parametrize("upto", [-100, 3, 4, 100])
def test_odd_rows(spark, upto):
    docs = odd_documents(spark, ("digest", "row", "id", "kept", "n"))
    extra = [(8, "twice  the\tsame row", None, None, 0), (None, "", None, None, 0), (9, " ", None, None, 0)]
    docs = docs.select(docs.columns[:5]).union(spark.createDataFrame(extra, DOCS))
    assert decided(exact.dedup_exact(docs, upto=upto)) == plain([r[:2] for r in ODD + extra])
    assert exact.dedup_exact(no_documents(spark)).count() == 0


def test_clashing_names(spark):
    docs = odd_documents(spark, ("digest", "row", "id", "kept", "n", "member", "bucket", "part"))
    assert decided(exact.dedup_exact(docs)) == plain([r[:2] for r in ODD])
    names = exact.new_documents(docs, exact.build_index(exact.digests(no_documents(spark)))).columns
    assert names == docs.columns


def test_hot_groups_and_small_buckets(spark, monkeypatch):
    """A third of all rows alike, many buckets, verdicts of large groups by broadcast: the same decisions."""
    monkeypatch.setattr(exact, "BUCKET", 50)
    monkeypatch.setattr(exact, "LEAST_HOT", 3)
    rows = [(i, f"text {i % 700}" if i % 3 else "hot") for i in range(3000)]
    docs = spark.createDataFrame([(*r, None, None, 0) for r in rows], DOCS).repartition(7)
    assert decided(exact.dedup_exact(docs)) == plain(rows)


def test_more_comes_in_than_history_has(spark, monkeypatch):
    monkeypatch.setattr(exact, "BUCKET", 20)
    history = spark.createDataFrame([(i, f"old {i}", None, None, 0) for i in range(30)], DOCS)
    index = exact.build_index(exact.digests(history))
    texts = [f"old {i % 40}" if i % 2 else f"new {i % 300}" for i in range(1200)]
    batch = spark.createDataFrame([(1000 + i, t, "x", None, i) for i, t in enumerate(texts)], DOCS)
    kept = exact.new_documents(batch, index)
    old, first = {f"old {i}" for i in range(30)}, {}
    for i, t in enumerate(texts):
        first.setdefault(t, 1000 + i)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for t, i in first.items() if t not in old)
    rows = exact.decide(exact.digests(batch), index, counted=False)
    seen = Counter(texts)
    for r in rows.join(batch, F.col("id") == F.col("doc_id")).collect():
        assert r["group_size"] == seen[r["text"]] + (r["text"] in old)
        assert r["member"] == (r["text"] in old)
        assert r["keep_id"] == (int(r["text"].split()[1]) if r["text"] in old else first[r["text"]])


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = QUERIES["op12_exact_dedup"](spark, SF).collect()
    got = Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], bytes.fromhex(r["text_sha256"])) for r in rows)
    assert got == plain([tuple(d) for d in docs])

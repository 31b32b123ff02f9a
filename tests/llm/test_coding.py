"""Byte-level BPE and sharding."""

from __future__ import annotations

import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from noticeworks.llm import bpe, sharding
from noticeworks.llm.queries import PATTERN, QUERIES, RANKS
from tests.llm.helpers import ODD, SF, no_documents, odd_documents


@pytest.fixture(scope="module")
def reference():
    ranks = {t: i for i, t in enumerate(bpe.read_ranks(RANKS))}
    return tiktoken.Encoding("reference", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(reference, text: str) -> bytes:
    return np.array(reference.encode_ordinary(text), "<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t.'a1"), st.characters(exclude_categories=["Cs"])), max_size=40), max_size=4))
def test_ids_are_those_of_the_rank_library(texts):
    coder = bpe.coder(RANKS, PATTERN)
    ranks = {t: i for i, t in enumerate(coder.tokens)}
    plain = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = coder.encode(texts)
    assert got == [ids_of(plain, t) for t in texts]
    assert [coder.decode(x).decode() for x in got] == texts


@pytest.mark.parametrize("text", ["a" * 3000, " " * 500 + "x", "é" * 999, " a", "a ", "a  b", "a \nb", "it's we'll", "\x00\x01 \x02"])
def test_runs_and_blanks(reference, text):
    assert bpe.coder(RANKS, PATTERN).encode([text]) == [ids_of(reference, text)]


def test_full_memory_changes_nothing(reference, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_BYTES", 700)
    coder = bpe.Coder(tuple(bpe.read_ranks(RANKS)), PATTERN)
    texts = ["one two three four", "two three " + "long" * 40, "one two"] * 2
    assert [coder.encode([t])[0] for t in texts] == [ids_of(reference, t) for t in texts]


def test_ranks_need_no_gaps(tmp_path):
    (tmp_path / "gap").write_text("YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError):
        bpe.read_ranks(str(tmp_path / "gap"))


def test_frame_round_trip(spark, reference):
    ids = bpe.encode(odd_documents(spark, ("ids", "n_tokens")), RANKS, PATTERN)
    out = bpe.decode(ids, RANKS, PATTERN, into="n_tokens")
    assert set(out.columns) == {"doc_id", "lang", "source", "n_chars", "n_tokens"}
    assert Counter(bytes(r["n_tokens"]) for r in out.collect()) == Counter((r[1] or "").encode() for r in ODD)
    assert bpe.encode(no_documents(spark), RANKS, PATTERN).count() == 0


def test_query_counts(spark, reference):
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op10_byte_bpe"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        raw, text = ids_of(reference, texts[r["doc_id"]]), texts[r["doc_id"]].encode()
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(raw) // 4, sha256(raw).hexdigest(), sha256(text).hexdigest())


def test_one_pass_gives_what_two_passes_give(spark):
    docs = odd_documents(spark, ("ids", "decoded"))
    one = bpe.round_trip(docs, RANKS, PATTERN)
    two = bpe.decode(bpe.encode(docs, RANKS, PATTERN).withColumn("again", F.col("ids")), RANKS, PATTERN, ids="again")
    assert sorted(one.columns) == sorted(two.columns)
    assert Counter(one.select(sorted(one.columns)).collect()) == Counter(two.select(sorted(one.columns)).collect())
    assert bpe.round_trip(no_documents(spark), RANKS, PATTERN).count() == 0


def test_matrix_has_its_margins():
    counts = [0, 7, 1000, 3, 0, 250, 41]
    drawn = np.array(sharding.matrix(counts, 6, 1))
    assert drawn.sum(axis=1).tolist() == counts
    assert drawn.sum(axis=0).max() - drawn.sum(axis=0).min() <= 1


def test_matrix_follows_the_hypergeometric_law():
    first = np.array([sharding.matrix([30, 70], 2, seed)[0][0] for seed in range(4000)])
    assert abs(first.mean() - 15) < 0.15
    assert abs(first.var() - 30 * 0.5 * 0.5 * 70 / 99) < 0.4


def test_large_populations_agree_with_the_small_sampler(monkeypatch):
    rng = np.random.default_rng(3)
    small = np.array([sharding.hypergeometric(rng, 400, 600, 200) for _ in range(4000)])
    monkeypatch.setattr(sharding, "NUMPY_LIMIT", 0)
    large = np.array([sharding.hypergeometric(rng, 400, 600, 200) for _ in range(4000)])
    assert abs(small.mean() - large.mean()) < 0.5 and abs(small.std() - large.std()) < 0.4
    monkeypatch.undo()
    assert abs(sharding.hypergeometric(rng, 10**10, 3 * 10**10, 10**6) - 250_000) < 5000


def test_every_row_gets_a_place(spark):
    docs = odd_documents(spark, ("shard", "slot")).union(odd_documents(spark, ("shard", "slot")))
    out = sharding.shuffle_shards(docs, 6, block_rows=2).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(r[0] for r in ODD + ODD)
    sizes = Counter(r["shard"] for r in out)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(n))
    assert sharding.shuffle_shards(no_documents(spark), 6).count() == 0


def test_order_is_random(spark):
    out = sharding.shuffle_shards(spark.range(20_000), 4).orderBy("shard", "slot")
    ids = np.array([r["id"] for r in out.collect()])
    assert abs(np.corrcoef(ids, np.arange(len(ids)))[0, 1]) < 0.03
    assert abs(np.corrcoef(ids[1:], ids[:-1])[0, 1]) < 0.03
    assert all(abs(ids[k : k + 5000].mean() - 10_000) < 500 for k in range(0, 20_000, 5000))


def test_sharding_query(spark):
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    for r in QUERIES["op9_sharding"](spark, SF).collect():
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 8, zlib.crc32(raw), "rows", None)

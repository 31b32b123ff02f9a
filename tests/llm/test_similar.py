"""The pipeline's near copies against all pairs of texts."""

from __future__ import annotations

import random
from itertools import combinations

import corpus_pipeline
from noticeworks.llm import similar
from tests.llm.helpers import SF, union
from tests.llm.test_copies import words


def jaccard(a: str, b: str) -> float:
    x, y = ({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for w in (a.lower().split(), b.lower().split()))
    return len(x & y) / len(x | y)


def edited_copies(rng: random.Random) -> dict[int, str]:
    """Texts, and copies of which one to six words are changed, some of them copies of copies."""
    texts = {i: words(rng, rng.randint(60, 250)) for i in range(30)}
    for i in range(30, 110):
        w = list(texts[rng.choice([*texts])])
        for k in rng.sample(range(len(w)), rng.randint(1, 6)):
            w[k] = "changed" + str(i)
        texts[i] = w
    return {i: " ".join(w) for i, w in texts.items()}


def left_by_all_pairs(texts: dict[int, str]) -> set[int]:
    return set(union(texts, [(a, b) for a, b in combinations(texts, 2) if jaccard(texts[a], texts[b]) >= 0.8]).values())


def test_near_copies_are_those_of_all_pairs(spark):
    texts = edited_copies(random.Random(21))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = left_by_all_pairs(texts)
    assert 20 < len(want) < 90
    got = [r["doc_id"] for r in corpus_pipeline.near_copies_out(spark, df, "").collect()]
    assert sorted(got) == sorted(want)


def test_near_copies_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"] for r in corpus_pipeline.near_copies_out(spark, docs, SF).select("doc_id").collect()}
    assert got == left_by_all_pairs(dict(docs.select("doc_id", "text").collect()))


def simhash_by_hand(text: str) -> int:
    (shingles,) = similar.shingle_sets([text.encode()])
    return sum(1 << i for i in range(64) if 2 * sum(int(h) >> i & 1 for h in shingles) > len(shingles))


def test_grid_alone_finds_all_within_its_radius(spark, monkeypatch):
    rng = random.Random(23)
    texts = {i: words(rng, 300) for i in range(12)}
    for i in range(12, 60):
        w = list(texts[i % 12])
        w[rng.choice([0, -1, 150])] = f"changed{i}"
        texts[i] = w
    texts = {i: " ".join(w) for i, w in texts.items()}
    fps = {i: simhash_by_hand(t) for i, t in texts.items()}
    near = [(a, b) for a, b in combinations(texts, 2) if (fps[a] ^ fps[b]).bit_count() <= similar.RADIUS and jaccard(texts[a], texts[b]) >= 0.8]
    want = set(union(texts, near).values())
    assert 12 <= len(want) < 40
    monkeypatch.setattr(similar, "_links", lambda shared, sets, tried, found: found)  # without the bands
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = [r["doc_id"] for r in corpus_pipeline.near_copies_out(spark, df, "").collect()]
    assert sorted(got) == sorted(want)


def test_grid_pairs_are_verified(spark):
    nodes = spark.createDataFrame([(1, 9, 0), (2, 9, 0), (3, 9, 7), (4, 9, 15), (5, 0, 0), (6, 9, -1), (7, 9, -8)], "node long, size long, fp long")
    got = {tuple(r) for r in similar.grid_pairs(nodes).collect()}
    assert (1, 2) in got and (6, 7) in got  # one fingerprint; three bits
    assert union(range(1, 8), got) == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 6, 7: 6}  # no node of a blank text
    a, b = "one two three four five six".split(), "seven eight nine ten eleven twelve".split()
    rows = spark.createDataFrame([(1, " ".join(a)), (2, " ".join(b))], "node long, text string")
    pairs = spark.createDataFrame([(1, 2)], "a long, b long")
    assert similar._verified(pairs, similar._sets(rows, "text")).count() == 0


def test_bands_of_similar_sets_meet():
    rng = random.Random(22)
    for _ in range(300):
        both = [rng.getrandbits(64) for _ in range(80)]
        a, b = (similar.np.array(sorted(both + [rng.getrandbits(64) for _ in range(10)]), "u8") for _ in range(2))
        assert similar.alike(a, b) and set(similar.bands(a).tolist()) & set(similar.bands(b).tolist())

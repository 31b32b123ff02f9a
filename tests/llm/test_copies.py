"""SimHash groups, components, line dedup and decontamination against plain versions."""

from __future__ import annotations

import random
import string
import time
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from noticeworks.llm import components as stars
from noticeworks.llm import decontaminate, lines, simhash
from noticeworks.llm.components import components
from noticeworks.llm.queries import QUERIES
from noticeworks.llm.tokens import Words, runs, shingles
from tests.llm.helpers import ODD, SF, fingerprint, no_documents, odd_documents, union


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randint(2, 8))) for _ in range(n)]


def prints_of(spark, values: list[int], ids=None):
    rows = [(i, v - (1 << 64) if v >> 63 else v) for i, v in zip(ids or range(len(values)), values, strict=True)]
    return spark.createDataFrame(rows, "doc_id long, fp long")


# --- words ------------------------------------------------------------------------------------------


def test_words_and_hashes_do_not_depend_on_neighbours():
    texts = [b"One two\tthree", b"", b" \n ", b"TWO three four\x0bone", "é two".encode()]
    all_words = Words(texts)
    assert np.diff(all_words.first).tolist() == [3, 0, 0, 4, 2]
    hashes = all_words.hashes()
    for i, t in enumerate(texts):
        assert hashes[all_words.first[i] : all_words.first[i + 1]].tolist() == Words([t]).hashes().tolist()
    assert len({*hashes.tolist()}) == 5
    assert runs(hashes, np.array([1]), np.array([3])).tolist() == shingles(hashes, 2)[3:4].tolist()


# --- SimHash ----------------------------------------------------------------------------------------


@pytest.mark.parametrize("text", [None, "", " ", "a", "A b", "a b c", "Ä ß\x0bc d", "x " * 70_000])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode() if text is not None else None) == fingerprint(text)


def test_manhattan_distance_is_a_lower_bound(spark):
    rng = random.Random(1)
    values = [rng.getrandbits(64) for _ in range(50)] + [0, (1 << 64) - 1]
    df = prints_of(spark, values)
    got = [r[0] % (1 << 64) for r in df.orderBy("doc_id").select(simhash.popcounts(df.fp)).collect()]
    assert got == [sum((v >> i & 3).bit_count() << i for i in range(0, 64, 2)) for v in values]


@pytest.mark.parametrize("cell", [4096, 3])
def test_groups_are_those_of_all_pairs(spark, cell):
    """Also where every crowded cell goes through the fine grid."""
    rng = random.Random(2)
    values = [rng.getrandbits(64) for _ in range(60)] + [0, (1 << 64) - 1]
    for v in values[:25]:
        for _ in range(rng.randint(0, 6)):
            for b in rng.sample(range(64), rng.randint(0, 3)):
                v ^= 1 << b
            values.append(v)
    centre = rng.getrandbits(64)
    values += [centre ^ (1 << b) for b in range(40)] + [centre] * 30
    want = union(range(len(values)), [(a, b) for a, b in combinations(range(len(values)), 2) if (values[a] ^ values[b]).bit_count() <= 2])
    got = dict(simhash.near_copies(prints_of(spark, values), cell=cell).select("doc_id", "component_id").collect())
    assert got == want


def test_rows_without_ids_never_name_a_group(spark):
    got = simhash.near_copies(prints_of(spark, [5, 4, 1 << 60 | 0xFFF], [None, 9, None])).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in got) == [(0, 0), (0, 9), (9, 9)]


def test_components(spark):
    rng = random.Random(3)
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    nodes = {n for link in links if link[0] != link[1] for n in link}
    df = spark.createDataFrame([*links, (7, 7), (None, 3)], "a long, b long")
    assert dict(components(df).collect()) == union(nodes, links)
    assert components(df.limit(0)).count() == 0


def test_simhash_query(spark):
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    want = {i: fingerprint(t) for i, t in texts.items()}
    groups = union(want, [(a, b) for a, b in combinations(sorted(want), 2) if (want[a] ^ want[b]).bit_count() <= 2])
    rows = QUERIES["op5_simhash"](spark, SF).collect()
    assert {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in rows} == {i: (want[i], groups[i]) for i in want}
    assert all(len(r["fingerprint"]) == 16 for r in rows)


def test_simhash_of_odd_rows(spark):
    out = simhash.with_fingerprints(odd_documents(spark, ("fp", "component_id")))
    assert sorted(r["fp"] % (1 << 64) for r in out.collect()) == sorted(fingerprint(r[1]) for r in ODD)
    assert simhash.near_copies(simhash.with_fingerprints(no_documents(spark)).select("doc_id", "fp")).count() == 0


# --- lines ------------------------------------------------------------------------------------------


def longest_common(texts: dict[int, str], n: int = 50) -> set[int]:
    """Documents with a run of ``n`` words that one of lesser id has as well."""
    seen, out = {}, set()
    for i in sorted(texts):
        w = texts[i].split()
        for k in range(len(w) - n + 1):
            if seen.setdefault(tuple(w[k : k + n]), i) != i:
                out.add(i)
    return out


def test_patience_finds_the_longest_run():
    rng = random.Random(4)
    for _ in range(50):
        held = rng.sample(range(12), 7)
        best = max(len(c) for n in range(1, 8) for c in combinations(held, n) if list(c) == sorted(c))
        got = lines.patience(list(enumerate(held)))
        assert len(got) == best and [h for _, h in got] == sorted(h for _, h in got)


def test_blocks():
    run = [(k, k + 10, 6) for k in range(4)]  # four lines of six words in a row
    assert lines.align(run) == [(0, 4)]
    assert lines.align(run[:3]) == []  # 18 words
    moved = [(0, 20, 25), (1, 10, 25)]  # two blocks in another order: one is found after the other
    assert lines.align(moved) == [(0, 1), (1, 2)]
    twice = [(0, 5, 25), (3, 5, 25)]  # a line that stands twice in the later document
    assert lines.align(twice) == [(0, 1), (3, 4)]


def test_blocks_come_from_aligned_pairs_only():
    block = [(k, "x", k + 5, 10) for k in range(3)]
    near = [(3, "y", 0, 4), (4, "z", 7, 4)]  # short lines beside it that others hold
    assert lines.blocks_of([*block, *near]) == [(0, 3)]
    assert lines.blocks_of([(k, k, 0, 8) for k in range(4)]) == []
    assert lines.blocks_of([(k, k, 0, 8) for k in range(4)], further=[(0, 3, "w", 20), (1, 4, "w", 21)]) == [(0, 4)]


@pytest.mark.parametrize("seed", range(30))
def test_alignment_finds_every_common_block(seed):
    """Lines that repeat in both texts: all places in a row in both, 20 words or more, are found, and nothing else."""
    rng = random.Random(seed)
    a, b = ([rng.randrange(9) for _ in range(30)] for _ in range(2))
    pairs = {(p, h, 6) for p in range(30) for h in range(30) if a[p] == b[h]}
    want = {p + i for p in range(27) for h in range(27) if a[p : p + 4] == b[h : h + 4] for i in range(4)}
    got = {x for p, q in lines.align(pairs) for x in range(p, q)}
    assert want >= got
    for p, q in lines.align(pairs):
        assert any(a[p:q] == b[h : h + q - p] for h in range(30))
    alone = {x for x in want if sum(1 for p, _, _ in pairs if p == x) == 1}
    assert alone <= got


def test_many_equal_lines_take_seconds():
    start = time.monotonic()
    assert lines.blocks_of([(k, 1, 0, 25) for k in range(100_000)]) == [(0, 100_000)]
    back = [(k, 1, 100_000 - 2 * k, 25) for k in range(50_000)]  # every block in another order
    assert lines.blocks_of(back) == [(0, 50_000)]
    assert time.monotonic() - start < 20


def planted(rng: random.Random) -> dict[int, str]:
    passage, other = " ".join(words(rng, 60)), "\n".join(" ".join(words(rng, 9)) for _ in range(8))
    docs = {i: "\n".join(" ".join(words(rng, rng.randint(3, 60))) for _ in range(6)) for i in range(40)}
    for i in range(5, 25):
        own = docs[i].split(" ")
        at = rng.randint(1, len(own) - 1)
        docs[i] = " ".join([*own[:at], passage, *own[at:]])  # glued into other words
    for i in range(20, 35, 3):
        docs[i] = docs[i] + "\n" + other
    docs[38] = docs[3]
    return docs


def test_repeated_passages_go_and_the_rest_stays(spark):
    docs = planted(random.Random(5))
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    out = {r["doc_id"]: r for r in lines.dedup_lines(df).collect()}
    assert not longest_common({i: r["text"] for i, r in out.items()}, 40)
    clean = set(docs) - longest_common(docs, 40)
    assert len(clean) > 15 and all(out[i]["text"] == docs[i] and out[i]["words_removed"] == 0 for i in clean)
    assert out[38]["text"] == ""
    for i, r in out.items():  # only words go, in order
        left = iter(docs[i].split())
        assert all(w in left for w in r["text"].split())
        assert len(docs[i].split()) - len(r["text"].split()) == r["words_removed"]


def test_common_short_lines_stay(spark):
    rng = random.Random(6)
    rows = [(i, "Licensed under terms that many use\n" + " ".join(words(rng, 40))) for i in range(30)]
    out = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert out.filter("words_removed > 0").count() == 0


def test_a_block_whose_lines_were_first_seen_apart(spark):
    """Each line has another first holder; the third document has the block of the second whole."""
    rng = random.Random(24)
    parts = [" ".join(words(rng, 18)) for _ in range(3)]
    rows = [(i, f"{' '.join(words(rng, 30))}\n{p}\n{' '.join(words(rng, 30))}") for i, p in enumerate(parts)]
    block = "\n".join(parts)
    rows += [(i, f"{' '.join(words(rng, 30))}\n{block}\n{' '.join(words(rng, 30))}") for i in (10, 11)]
    out = {r["doc_id"]: r for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [out[i]["words_removed"] for i in (0, 1, 2, 10)] == [0] * 4
    assert out[11]["words_removed"] >= 54 and not longest_common({i: r["text"] for i, r in out.items()}, 20)


@pytest.mark.parametrize("unit", ["twelve", "of", "of the", "a b c", "p q r s", "one two three four five six seven"])
def test_blocks_with_repeated_words_go(spark, unit):
    """A line four times in a row, and runs of few words that repeat."""
    rng = random.Random(25)
    passage = "\n".join([" ".join(words(rng, 12))] * 4) if unit == "twelve" else " ".join((unit.split() * 70)[:70])
    glue = "\n" if unit == "twelve" else " "
    rows = [(i, " ".join(words(rng, 40 + i)) + glue + passage + glue + " ".join(words(rng, 40))) for i in range(3)]
    out = {r["doc_id"]: r for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[0]["words_removed"] == 0
    assert not longest_common({i: r["text"] for i, r in out.items()}, 40)
    for i in (1, 2):
        assert set(rows[i][1].split()) - set(out[i]["text"].split()) <= set(passage.split())


@pytest.mark.parametrize("seed", range(40))
def test_least_runs_cover_every_block(seed):
    rng = random.Random(seed)
    n = np.array([rng.randint(1, 24) for _ in range(12)])
    runs_ = [(int(a), int(b)) for a, b in zip(*lines.least_runs(np.zeros(12, int), n), strict=True)]
    assert all(n[a:b].sum() >= lines.BLOCK for a, b in runs_)
    for a, b in combinations(range(13), 2):
        if n[a:b].sum() >= lines.BLOCK:
            inside = [set(range(x, y)) for x, y in runs_ if a <= x and y <= b]
            assert set().union(*inside) == set(range(a, b))


def test_lines_of_odd_rows(spark):
    block = " ".join(words(random.Random(7), 40))
    df = odd_documents(spark, ("words_removed", "spans", "id"))
    more = spark.createDataFrame([(None, block), (50, block), (50, block + " x"), (51, block), (51, block)], "doc_id long, text string")
    out = lines.dedup_lines(df.unionByName(more, allowMissingColumns=True))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "spans", "id", "words_removed"]
    rows = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert Counter(rows) == Counter([(r[0], r[1]) for r in ODD] + [(None, ""), (50, block), (50, block + " x"), (51, ""), (51, "")])
    assert lines.dedup_lines(no_documents(spark)).count() == 0


def test_line_query_keeps_rows(spark):
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op1_line_dedup"](spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    assert all(r["text"] == texts[r["doc_id"]] for r in rows if not r["words_removed"])
    before, after = longest_common(texts), longest_common({r["doc_id"]: r["text"] for r in rows})
    assert len(after) <= 0.1 * len(before)


# --- decontamination --------------------------------------------------------------------------------


def plain_matches(docs: list[tuple], items: list[tuple], least: float = 0.8) -> set[tuple]:
    """Every window of every item's length, by shingle counts alone."""
    table = str.maketrans(string.punctuation, " " * len(string.punctuation))

    def cut(w):
        k = min(5, len(w))
        return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))

    out = set()
    for d, text in docs:
        w = (text or "").translate(table).lower().split()
        for i, item in items:
            v = (item or "").translate(table).lower().split()
            for k in range(len(w) - len(v) + 1 if v else 0):
                a, b = cut(w[k : k + len(v)]), cut(v)
                if (a & b).total() / (a | b).total() >= least:
                    out.add((d, i))
                    break
    return out


def test_matches_are_those_of_all_windows(spark):
    rng = random.Random(8)
    items = [(i, " ".join(words(rng, n))) for i, n in enumerate([1, 3, 5, 8, 15, 15, 30, 45, 59, 59])]
    docs = []
    for d in range(120):
        w = words(rng, rng.randint(0, 80))
        for i, item in rng.sample(items, 2):
            v = item.split()
            if d % 3 == 0 and len(v) > 20:
                v[rng.randrange(len(v))] = "changed"
            if d % 3 == 1 and len(v) > 20:
                v = v[rng.randint(0, 6) :]
            if d % 4 != 3:
                at = rng.randint(0, len(w))
                w = [*w[:at], *v, *w[at:]]
        docs.append((d, " ".join(w).replace("a", "A") + ("!" if d % 2 else "")))
    want = plain_matches(docs, items)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.matches(df, bench).collect()
    pairs = {(r["doc_id"], r["item_id"]) for r in got}
    assert len(got) == len(pairs) and pairs <= want and len(pairs) >= 0.98 * len(want) and len(want) > 100
    left = decontaminate.without_matches(df, bench)
    assert {r["doc_id"] for r in left.collect()} == {d for d, _ in docs} - {d for d, _ in pairs}


def test_blocks_of_items_change_nothing(spark, monkeypatch):
    rng = random.Random(9)
    items = [(i, " ".join(words(rng, 20))) for i in range(12)]
    docs = [(i, "x y " + t + " z") for i, t in items]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 60)
    monkeypatch.setattr(decontaminate.blocks_of, "__defaults__", (60,))
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(df, bench).collect()} == {(i, i) for i, _ in items}
    assert decontaminate.without_matches(df, bench).count() == 0


def test_every_fingerprint_within_the_radius_is_a_candidate():
    rng = np.random.default_rng(10)
    index = decontaminate.Index([(0, b"a b c d e f")])
    values = rng.integers(0, 1 << 63, 50).astype(np.uint64)
    blocks = []
    for shift, mask in index.cuts:
        own = values >> shift & mask
        order = np.argsort(own, kind="stable")
        blocks.append((own[order], order))
    for k, v in enumerate(values):
        for _ in range(20):
            w = int(v)
            for b in rng.choice(64, decontaminate.RADIUS, replace=False):
                w ^= 1 << int(b)
            assert (0, k) in index._candidates(np.array([w], np.uint64), blocks)


def test_decontamination_of_odd_rows(spark):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "twice the same row"), (3, "no id here")], "item_id long, text string")
    df = odd_documents(spark, ("item_id", "similarity"))
    got = decontaminate.matches(df, bench).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"]) for r in got) == [(0, 3), (4, 3), (4, 3)]
    left = decontaminate.without_matches(df, bench)
    assert left.columns == df.columns
    assert Counter((r["doc_id"], r["text"]) for r in left.collect()) == Counter((r[0], r[1]) for r in ODD if r[0] not in (4, None))
    assert decontaminate.matches(no_documents(spark), bench).count() == 0
    assert decontaminate.without_matches(df, bench.limit(0)).count() == len(ODD)


def test_decontamination_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    table = str.maketrans(string.punctuation, " " * len(string.punctuation))

    def plain(t):
        return " " + " ".join(t.translate(table).lower().split()) + " "

    whole = {(d, i) for d, t in docs for i, x in items if plain(x) in plain(t)}
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op8_decontaminate"](spark, SF).collect()}
    assert whole and whole <= got


# --- hot keys ---------------------------------------------------------------------------------------


def test_joins_on_hot_keys_are_split(spark, monkeypatch):
    """The hub of a star round, with small thresholds: its join says skew."""
    plans = []
    keep = stars.written

    def watched(df, name):
        table = keep(df, name)
        df.collect()
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return table

    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        links = spark.range(1, 20_000, 1, 8).select((F.col("id") % 5000 + 10).alias("a"), F.when(F.col("id") < 15_000, 1).otherwise(F.col("id") % 7 + 2).alias("b"))
        monkeypatch.setattr(stars, "written", watched)
        roots = components(links).select("root").distinct().collect()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert [r[0] for r in roots] == [1]
    assert any("skew=true" in plan for name, plan in plans if name == "large-star")

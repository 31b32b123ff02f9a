"""Line dedup by pairwise alignment: shared rare lines pair documents, patience diff aligns each pair.

A line is a physical line; inside long ones, a line also ends where the words themselves say so (before a
word whose hash is the least among its neighbours, and every few words where the same words repeat), so that a passage glued into other text is cut alike
in every document. Each line of several documents has a holder, the document of least id that has it.
A document is paired with every holder of enough of its words: one pair for each document and holder, however
many documents share the line. A pair whose lines add up to less than a block is left out, so it is the rare
lines that make pairs; no count of documents or holders is limited.

Shared lines of a document may have several holders though another document has them all in a row. So every shortest run of
neighbouring shared lines that makes a block, from its first line on or back from its last, is looked up as well, by the hash of
its lines: the first document that has it has it whole and becomes a further partner, whose pair is aligned like any other. Such
runs cover all blocks of whole lines that an earlier document has, whatever lines are repeated in them and whoever holds each line.

In a pair, the shared lines that occur once in both are aligned by patience (longest increasing run of positions)
and grown into blocks of neighbours; what is left is aligned again until no block is found, and repeated lines in one pass at
the end, so that a text of many equal lines takes no longer than another. Blocks of ``BLOCK`` words and more are deleted from the
later document; nothing is that no pair has aligned.

Defined results: rows of one id are never compared with each other; a row without an id is later than all others and never a
holder; fully equal rows get equal results; null and empty texts stay as they are; an empty table gives an
empty one; extra columns pass through.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.common import OWN, delete_written, freed, slices, written
from noticeworks.llm.tokens import Words, mix, runs

#: Fewest words of a block that is deleted, and how many words on each side a cut looks at.
BLOCK, REACH = 20, 4
#: How often what is left of a pair is aligned again before its blocks are taken by their neighbours alone.
ROUNDS = 16


def cut(words: Words, hashes: np.ndarray) -> np.ndarray:
    """Index of the first word of every line, over all texts."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.int64)
    line = np.searchsorted(np.flatnonzero(words.buffer == 10), words.starts)
    begins = np.concatenate(([True], line[1:] != line[:-1]))
    before = np.where(begins, np.uint64(0), np.concatenate((hashes[:1], hashes[:-1])))
    key = mix(hashes ^ (before * np.uint64(3)))
    least = np.ones(n, bool)
    for d in range(1, REACH + 1):
        inside = line[d:] == line[:-d]
        least[d:] &= inside & (key[d:] < key[:-d])
        least[:d] = False
        least[:-d] &= inside & (key[:-d] <= key[d:])
        least[-d:] = False
    return np.flatnonzero(begins | least | _repeated(key, line))


def _repeated(key: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Further cuts where words repeat every 1 to ``REACH`` words, so that no key is less than all near it.

    Keys that are least, with equals, and follow an equal one at the same distance are counted from the first on, and
    of distance d every (8 / d)th begins a line.
    """
    low = np.ones(len(key), bool)
    for d in range(1, REACH + 1):
        inside = line[d:] == line[:-d]
        low[d:] &= ~inside | (key[d:] <= key[:-d])
        low[:-d] &= ~inside | (key[:-d] <= key[d:])
    at = np.flatnonzero(low)
    out = np.zeros(len(key), bool)
    if len(at) < 2:
        return out
    gap = np.diff(at, prepend=at[0] - REACH - 1)
    equal = np.concatenate(([False], key[at][1:] == key[at][:-1])) & (gap <= REACH) & np.concatenate(([False], line[at][1:] == line[at][:-1]))
    goes_on = equal & np.concatenate(([False], (gap[1:] == gap[:-1]) | ~equal[:-1]))
    starts = np.flatnonzero(~goes_on)
    number = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
    out[at[goes_on & (number % (2 * REACH // np.clip(gap, 1, REACH)) == 0)]] = True
    return out


def lines_of(texts: list[bytes]) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, first and end word of each line, line hashes, and the first line of each text."""
    words = Words(texts, lower=False)
    hashes = words.hashes()
    first = cut(words, hashes)
    end = np.append(first[1:], len(hashes)) if len(first) else first
    return words, first, end, runs(hashes, first, end), np.searchsorted(first, words.first)


def patience(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of (place, held place) pairs that increases in both, from pairs sorted by place."""
    tops: list[int] = []
    top_of: list[int] = []
    before = [-1] * len(pairs)
    for i, (_, held) in enumerate(pairs):
        k = bisect_left(tops, held)
        before[i] = top_of[k - 1] if k else -1
        tops[k : k + 1] = [held]
        top_of[k : k + 1] = [i]
    out, i = [], top_of[-1] if top_of else -1
    while i >= 0:
        out.append(pairs[i])
        i = before[i]
    return out[::-1]


def align(shared: Iterable[tuple[int, int, int]], least: int = BLOCK) -> list[tuple[int, int]]:
    """Blocks (first line, end line) of a document from its lines (place, place in the holder, words).

    A line may have several places in the holder. Anchors are the lines left that stand once in both; the longest
    run of them that increases in both is grown, each anchor by the neighbours that follow it in both. What is left is
    aligned again, ``ROUNDS`` times at most; lines that never stand alone, and blocks in yet another order, are then taken
    by their neighbours alone, all in one pass.
    """
    pairs = sorted(set(shared), key=lambda x: (x[1] - x[0], x[0]))
    runs_: list[list[tuple[int, int, int]]] = []  # lines in a row in both
    before = None
    for pair in pairs:
        if before != (pair[0] - 1, pair[1] - 1):
            runs_.append([])
        runs_[-1].append(pair)
        before = pair[:2]
    runs_ = [r for r in runs_ if sum(n for *_, n in r) >= least]
    blocks: list[list[tuple[int, int, int]]] = []
    for _ in range(ROUNDS):
        if len(runs_) < 2:  # a block alone is aligned with itself
            break
        here = Counter(p for r in runs_ for p, _, _ in r)
        there = Counter(h for r in runs_ for _, h, _ in r)
        once = sorted((p, h, k) for k, r in enumerate(runs_) for p, h, _ in r if here[p] == 1 == there[h])
        of = {p: k for p, _, k in once}
        found = {of[p] for p, _ in patience([(p, h) for p, h, _ in once])}
        if not found:
            break
        blocks += [runs_[k] for k in found]
        gone = {p for k in found for p, _, _ in runs_[k]}
        runs_ = [r for k, r in enumerate(runs_) if k not in found and any(p not in gone for p, _, _ in r)]
    return sorted({(r[0][0], r[-1][0] + 1) for r in (*blocks, *runs_)})


def least_runs(stretch: np.ndarray, n: np.ndarray, least: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Where the shortest runs of ``least`` words begin and end (exclusive), in lines of ``n`` words that neighbour within a stretch."""
    total = np.concatenate(([0], np.cumsum(n)))
    every = np.arange(len(n))
    ends = np.searchsorted(total, total[:-1] + least)  # from each line on
    starts = np.searchsorted(total, total[1:] - least, "right") - 1  # back from each line
    a, b = np.concatenate((every, starts)), np.concatenate((ends, every + 1))
    inside = (a >= 0) & (b <= len(n))
    a, b = a[inside], b[inside]
    inside = stretch[a] == stretch[b - 1]
    both = np.unique(np.stack((a[inside], b[inside])), axis=1)
    return both[0], both[1]


def _runs(shared: DataFrame, least: int) -> DataFrame:
    """(id, th, a, b, w) of the shortest runs of shared lines that make a block; w is the hash of their lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freed(batches):
            items = batch.column(2).flatten()
            doc = np.repeat(np.arange(len(batch)), batch.column(2).value_lengths().to_numpy(zero_copy_only=False))
            line, u, n = (items.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            order = np.lexsort((line, doc))
            doc, line, u, n = doc[order], line[order].astype(np.int64), u[order].view(np.uint64), n[order].astype(np.int64)
            new = (doc[1:] != doc[:-1]) | (line[1:] != line[:-1] + 1)
            a, b = least_runs(np.concatenate(([0], np.cumsum(new))), n, least)
            of = pa.array(doc[a])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(of),
                    batch.column(1).take(of),
                    pa.array(line[a].astype(np.int32)),
                    pa.array((line[b - 1] + 1).astype(np.int32)),
                    pa.array(runs(u, a, b).view(np.int64)),
                ],
                ["id", "th", "a", "b", "w"],
            )

    rows = shared.groupBy("id", "th").agg(F.collect_set(F.struct("line", "u", "n")).alias("lines"), F.sum("n").alias("words"))
    rows = rows.filter(F.col("words") >= least).select("id", "th", "lines")
    kind = shared.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, th long, a int, b int, w long")


def _runs_of_earlier(shared: DataFrame, least: int) -> DataFrame:
    """(rid, rth, runs) of the texts with runs that a document of lesser id has as well: from line a to b, which that
    holder (wid, wth) has from its line ``at`` on."""
    every = written(_runs(shared, least), "runs")
    own = F.struct(F.col("id").alias("wid"), F.col("th").alias("wth"), F.col("a").alias("at"))
    first = every.groupBy("w").agg(F.min(F.when(F.col("id").isNotNull(), own)).alias("h"), F.count("*").alias("times"))
    # Written, as a join in the stage of its aggregate is never split where one run is hot.
    first = written(first.filter("times > 1 AND h IS NOT NULL").select("w", "h"), "first-runs").hint("shuffle_hash")  # a row a run: even
    later = every.join(first, "w").filter("id IS NULL OR id > h.wid")
    found = F.collect_set(F.struct("a", "b", "h.wid", "h.wth", "h.at"))
    return later.groupBy(F.col("id").alias("rid"), F.col("th").alias("rth")).agg(found.alias("runs"))


def _lines(docs: DataFrame) -> DataFrame:
    """(id, th, line, u, n) of every line; th tells texts of one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freed(batches):
            for part in slices(batch, "text"):
                texts = [t or b"" for t in part.column(2).to_pylist()]
                _, first, end, hashes, of = lines_of(texts)
                counts = np.diff(of)
                at = pa.array(np.repeat(np.arange(len(texts)), counts))
                place = np.arange(len(first)) - np.repeat(of[:-1], counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(at),
                        part.column(1).take(at),
                        pa.array(place.astype(np.int32)),
                        pa.array(hashes.view(np.int64)),
                        pa.array((end - first).astype(np.int32)),
                    ],
                    ["id", "th", "line", "u", "n"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, th long, line int, u long, n int")


def blocks_of(
    shared: list[tuple[int, object, int, int]], least: int = BLOCK, further: Iterable[tuple[int, int, object, int]] = ()
) -> list[tuple[int, int]]:
    """Blocks of a document from its lines (place, holder, place in the holder, words), each holder aligned by itself.

    ``further`` are runs (first line, end line, holder, its first line there), which name further partners and further places.
    """
    words = {place: n for place, _, _, n in shared}
    pairs: dict[object, set[tuple[int, int, int]]] = {}
    for place, holder, held, n in shared:
        pairs.setdefault(holder, set()).add((place, held, n))
    done: dict[tuple[object, int], int] = {}  # runs that overlap go on where the one before ended
    for a, b, holder, at in sorted(further, key=lambda x: x[:2]):
        start = max(a, done.get((holder, at - a), a))
        done[holder, at - a] = max(b, start)
        if start < b:
            pairs.setdefault(holder, set()).update((p, at + p - a, words[p]) for p in range(start, b))
    found = [b for pair in pairs.values() if sum(n for *_, n in pair) >= least for b in align(pair, least)]
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _items(column: pa.ListArray) -> Iterator[list[tuple]]:
    """The structs of each list as tuples; a null list is empty."""
    flat = column.flatten()
    every = list(zip(*(flat.field(k).to_pylist() for k in range(flat.type.num_fields)), strict=True))
    at = 0
    for n in column.value_lengths().to_pylist():
        yield every[at : at + (n or 0)]
        at += n or 0


def _aligned(docs: DataFrame, least: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freed(batches):
            blocks = []
            for shared, runs_ in zip(_items(batch.column(2)), _items(batch.column(3)), strict=True):
                lines = [(line, (hid, hth), held, n) for line, hid, hth, held, n in shared]
                further = [(a, b, (wid, wth), at) for a, b, wid, wth, at in runs_]
                blocks.append(blocks_of(lines, least, further))
            spans = pa.array([[{"a": a, "b": b} for a, b in x] for x in blocks], pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), spans], ["id", "th", "spans"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "th", "shared", "runs").mapInArrow(run, f"id {kind}, th long, spans array<struct<a:int,b:int>>")


def common_blocks(docs: DataFrame, least: int = BLOCK) -> DataFrame:
    """(id, th, spans) of the texts that share blocks with earlier ones; spans count lines, end exclusive.

    ``docs`` has id, th and text (binary).
    """
    lines = written(_lines(docs), "lines")
    holder = lines.groupBy("u").agg(F.min("id").alias("hid"), F.count("*").alias("times"))
    # Written, as are other aggregates before a join: in the stage of its aggregate a join's hot key is never split.
    holder = written(holder.filter("times > 1 AND hid IS NOT NULL").drop("times"), "holders").hint("shuffle_hash")  # a row a line: even
    shared = written(lines.join(holder, "u"), "shared-lines")
    delete_written(lines)
    held = shared.filter("id = hid").groupBy("u").agg(F.min(F.struct("th", "line")).alias("h"))
    held = written(held.select("u", F.col("h.th").alias("hth"), F.col("h.line").alias("held")), "held-lines").hint("shuffle_hash")  # a row a line: even
    later = shared.filter("id IS NULL OR id > hid").join(held, "u")
    item = F.struct("line", "hid", "hth", "held", "n")
    docs = later.groupBy("id", "th").agg(F.collect_set(item).alias("shared"), F.sum("n").alias("words"))
    further = _runs_of_earlier(shared, least).hint("shuffle_hash")  # a row a document: even
    docs = docs.filter(F.col("words") >= least).join(further, F.expr("id <=> rid AND th = rth"), "left")
    return _aligned(docs, least).filter(F.size("spans") > 0)


def _without(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    words, first, end, _, _ = lines_of([text])
    gone = np.zeros(len(words.starts), bool)
    for a, b in spans:
        gone[first[a] : end[b - 1]] = True
    out, at = [], 0
    edges = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).view(np.int8)))
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        left = text[at : words.starts[a]]
        at = int(words.starts[b]) if b < len(words.starts) else len(text)
        gap = text[int(words.ends[b - 1]) : at]
        if b"\n" in gap and left.strip() and not left.endswith(b"\n"):
            left = left.rstrip(b" \t") + b"\n"
        out.append(left)
    out.append(text[at:])
    return b"".join(out).rstrip() if len(edges) and gone[-1] else b"".join(out), int(gone.sum())


def dedup_lines(df: DataFrame, id_: str = "doc_id", text: str = "text", removed: str = "words_removed", least: int = BLOCK) -> DataFrame:
    """``df`` with common blocks cut out of ``text``, and how many words that took in ``removed`` (long)."""
    names = [c for c in df.columns if c != removed]
    kind = df.schema[text].dataType
    th = F.xxhash64(text)
    docs = df.select(F.col(id_).alias("id"), th.alias("th"), F.col(text).cast("binary").alias("text"))
    spans = written(common_blocks(docs, least), "blocks").select(F.col("id").alias(OWN + "id"), F.col("th").alias(OWN + "th"), "spans")
    spans = spans.withColumnRenamed("spans", OWN + "spans").hint("shuffle_hash")  # a row a document: even
    rows = df.select(*(F.col(c).cast("binary").alias(c) if c == text else c for c in names), th.alias(OWN + "own"))
    joined = rows.join(spans, F.col(id_).eqNullSafe(F.col(OWN + "id")) & (F.col(OWN + "own") == F.col(OWN + "th")), "left")
    joined = joined.select(*names, OWN + "spans")
    k = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freed(batches):
            texts, gone = batch.column(k).to_pylist(), []
            for i, s in enumerate(batch.column(len(names)).to_pylist()):
                n = 0
                if s:
                    texts[i], n = _without(texts[i], [(x["a"], x["b"]) for x in s])
                gone.append(n)
            columns = [pa.array(texts, pa.binary()) if i == k else c for i, c in enumerate(batch.columns[: len(names)])]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(gone, pa.int64())], [*names, removed])

    schema = rows.select(*names).schema.add(removed, "long")
    return joined.mapInArrow(run, schema).withColumn(text, F.col(text).cast(kind))

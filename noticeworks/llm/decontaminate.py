"""Benchmark passages in documents: SimHash of item-sized windows, multi-index Hamming blocks, exact check.

Words are lower-cased (A-Z), ASCII punctuation counts as white space. For every length that benchmark items
have, each window of that many words is a candidate if it can still reach the wanted similarity, that
is, if enough of its five-word shingles belong to any item. Its fingerprint (majority vote over word hashes)
is looked up among the items of its length: fingerprints are cut into one block more than the radius has
bits, so two within the radius agree on a block at least. What is found is verified by the generalised
Jaccard similarity of the shingles with their counts.

Benchmark items are a query set: they are read in blocks of bounded size, each sent to all tasks, and
every document meets every block. Documents are never shuffled.

Defined results: items and documents without words match nothing; items or windows of fewer words than a shingle
count as one shingle; equal items are reported each; rows without an id are reported with a null id.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from noticeworks.llm.common import OWN, freed, slices
from noticeworks.llm.tokens import Words, runs

SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 12
#: Words of benchmark text that a task holds at once.
BLOCK_WORDS = 500_000
#: Window starts that are voted on at once.
STARTS = 4096
TO_BLANK = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))


def words_of(texts: list[bytes]) -> Words:
    return Words([t.translate(TO_BLANK) for t in texts])


def votes(hashes: np.ndarray) -> np.ndarray:
    """Running sums of the words' hash bits: row i counts those of the first i words."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.concatenate((np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)))


def prints(sums: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Fingerprints of the windows of ``length`` words: bits set in over half of the word hashes."""
    ones = (sums[starts + length] - sums[starts]) * 2 > length
    return np.packbits(ones, axis=1, bitorder="little").view("<u8").ravel()


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Generalised Jaccard similarity of two lists of shingles, counts as weights."""
    keys, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = np.bincount(at[: len(a)], minlength=len(keys)), np.bincount(at[len(a) :], minlength=len(keys))
    return float(np.minimum(x, y).sum() / np.maximum(x, y).sum())


class Index:
    """The items of one block, ready to be searched for."""

    def __init__(self, items: list[tuple[object, bytes]], least: float = SIMILARITY, radius: int = RADIUS):
        self.least, self.radius = least, radius
        edges = [64 * k // (radius + 1) for k in range(radius + 2)]
        self.cuts = [(np.uint64(a), np.uint64((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:], strict=False)]
        words = words_of([t for _, t in items])
        hashes = words.hashes()
        by_length: dict[int, list] = {}
        for (item, _), a, b in zip(items, words.first, words.first[1:], strict=False):
            if b > a:
                by_length.setdefault(int(b - a), []).append((item, hashes[a:b]))
        self.lengths = {}
        for length, own in sorted(by_length.items()):
            fp = np.concatenate([prints(votes(h), np.zeros(1, np.int64), length) for _, h in own])
            blocks = []
            for shift, mask in self.cuts:
                values = fp >> shift & mask
                order = np.argsort(values, kind="stable")
                blocks.append((values[order], order))
            width = min(SHINGLE, length)
            self.lengths[length] = ([i for i, _ in own], fp, blocks, [_shingles(h, width) for _, h in own])
        every = {w: [s for n, x in self.lengths.items() if min(SHINGLE, n) == w for s in x[3]] for w in range(1, SHINGLE + 1)}
        self.known = {w: np.unique(np.concatenate(s)) for w, s in every.items() if s}
        self.maybe = {w: _bitmap(k) for w, k in self.known.items()}

    def _hits(self, hashes: np.ndarray, width: int) -> np.ndarray:
        """Where a shingle that any item has begins."""
        shingles = _shingles(hashes, width)
        at = np.flatnonzero(self.maybe[width][(shingles & np.uint64(BITMAP - 1)).astype(np.int64)])
        found = shingles[at]
        known = self.known[width]
        return at[known[np.minimum(np.searchsorted(known, found), len(known) - 1)] == found]

    def search(self, texts: list[bytes]) -> Iterator[tuple[int, object, int, int, float]]:
        """(text, item, first word, words, similarity) of the best window of each text and item."""
        words = words_of(texts)
        hashes = words.hashes()
        hits = {w: self._hits(hashes, w) for w in self.known}
        spots = np.unique(np.concatenate([*hits.values(), np.zeros(0, np.int64)])).astype(np.int64)
        for t in np.unique(np.searchsorted(words.first, spots, side="right") - 1).tolist():
            a, b = int(words.first[t]), int(words.first[t + 1])
            best: dict[tuple[int, int], tuple[float, int]] = {}
            for length in self.lengths:
                width = min(SHINGLE, length)
                of = hits[width]
                of = of[np.searchsorted(of, a) : np.searchsorted(of, b - width, side="right")] - a
                for k, item, s in self._windows(hashes[a:b], of, length, width):
                    if (length, item) not in best or s > best[length, item][0]:
                        best[length, item] = (s, k)
            for (length, item), (s, k) in best.items():
                yield t, self.lengths[length][0][item], k, length, s

    def _windows(self, hashes: np.ndarray, hits: np.ndarray, length: int, width: int) -> Iterator[tuple[int, int, float]]:
        n = length - width + 1  # shingles of a window
        needed = max(1, math.ceil(2 * self.least * n / (1 + self.least) - 1e-9))
        if len(hits) < needed or len(hashes) < length:
            return
        first, last = hits[: len(hits) - needed + 1], hits[needed - 1 :]
        fits = last - first < n
        low = np.maximum(0, last[fits] - n + 1)
        high = np.minimum(len(hashes) - length, first[fits])
        starts = np.unique(np.concatenate([np.arange(x, y + 1) for x, y in zip(low, high, strict=True)] or [np.zeros(0, np.int64)]))
        _, prints_of, blocks, shingles_of = self.lengths[length]
        for k in range(0, len(starts), STARTS):
            for part in _near(starts[k : k + STARTS], length):
                base = part[0]
                fp = prints(votes(hashes[base : part[-1] + length]), part - base, length)
                for w, item in self._candidates(fp, blocks):
                    if (int(fp[w]) ^ int(prints_of[item])).bit_count() <= self.radius:
                        s = similarity(_shingles(hashes[part[w] : part[w] + length], width), shingles_of[item])
                        if s >= self.least:
                            yield int(part[w]), item, s

    def _candidates(self, fp: np.ndarray, blocks: list) -> set[tuple[int, int]]:
        found = set()
        for (shift, mask), (values, order) in zip(self.cuts, blocks, strict=True):
            own = fp >> shift & mask
            low, high = np.searchsorted(values, own), np.searchsorted(values, own, side="right")
            for w in np.flatnonzero(high > low).tolist():
                found.update((w, i) for i in order[low[w] : high[w]].tolist())
        return found


BITMAP = 1 << 22


def _bitmap(keys: np.ndarray) -> np.ndarray:
    out = np.zeros(BITMAP, bool)
    out[(keys & np.uint64(BITMAP - 1)).astype(np.int64)] = True
    return out


def _shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    starts = np.arange(max(0, len(hashes) - width + 1))
    return runs(hashes, starts, starts + width)


def _near(starts: np.ndarray, length: int) -> list[np.ndarray]:
    """Cut where windows do not overlap, so that words between far windows are not voted on."""
    return np.split(starts, np.flatnonzero(np.diff(starts) > length) + 1) if len(starts) else []


def blocks_of(items: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[object, bytes]]]:
    """The items (id, text) in blocks of about ``block_words`` words, dealt by hash."""
    id_, text = items.columns
    total = items.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = max(1, math.ceil(total / 6 / block_words))
    for k in range(n):
        own = items.filter(F.pmod(F.xxhash64(id_, text), F.lit(n)) == k) if n > 1 else items
        yield [(r[0], (r[1] or "").encode()) for r in own.collect()]


def matches(df: DataFrame, items: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document and item that match: id, item_id, first_word, n_words, similarity."""
    out = None
    item_type = items.schema[0].dataType
    schema = StructType(
        [
            df.schema[id_],
            StructField("item_id", item_type),
            StructField("first_word", LongType()),
            StructField("n_words", IntegerType()),
            StructField("similarity", DoubleType()),
        ]
    )
    rows = df.select(id_, F.col(text).cast("binary").alias(OWN + "text"))
    for block in blocks_of(items):

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            index = Index(block)
            for batch in freed(batches):
                for part in slices(batch, OWN + "text"):
                    ids, texts = (c.to_pylist() for c in part.columns)
                    found = [(ids[t], *rest) for t, *rest in index.search([x or b"" for x in texts])]
                    arrays = list(zip(*found, strict=True)) or [[]] * 5
                    kinds = [part.schema.field(0).type, None, pa.int64(), pa.int32(), pa.float64()]
                    kinds[1] = pa.int64() if item_type.typeName() == "long" else pa.string() if item_type.typeName() == "string" else pa.int32()
                    yield pa.RecordBatch.from_arrays([pa.array(a, k) for a, k in zip(arrays, kinds, strict=True)], schema.names)

        found = rows.mapInArrow(run, schema)
        out = found if out is None else out.union(found)
    return out


def without_matches(df: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``df`` in which no item is found, with all their columns."""
    names, k = df.columns, df.columns.index(text)
    plain = F.col(text).cast("binary")
    for block in blocks_of(items):

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            index = Index(block)
            for batch in freed(batches):
                for part in slices(batch, text):
                    texts = [x or b"" for x in part.column(k).to_pylist()]
                    keep = np.ones(len(texts), bool)
                    keep[[t for t, *_ in index.search(texts)]] = False
                    yield part.filter(pa.array(keep))

        kind = df.schema[text].dataType
        raw = df.select(*(plain.alias(c) if c == text else c for c in names))
        df = raw.mapInArrow(run, raw.schema).withColumn(text, F.col(text).cast(kind)).select(*names)
    return df

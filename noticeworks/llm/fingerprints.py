"""Document fingerprints by consistent weighted sampling.

A text is a set of words with their counts as weights. For each of ``SAMPLES`` samples every word k draws
r, c ~ Gamma(2, 1) and b ~ Uniform(0, 1) from a hash of the word and the sample's number; with weight S,
t = floor(ln S / r + b) and a = c / exp(r (t - b + 1)). The word of the least a, together with its t, is the sample. Two
texts draw the same sample with a probability equal to the generalised Jaccard similarity of their weights,
so the share of equal samples estimates it, with a standard error of at most 0.5 / sqrt(SAMPLES).

The least a itself stands for (word, t), because it depends on nothing else; 16 bits of its hash are kept.

Defined results: null, empty and blank texts have the fingerprint of no words (every sample FFFF), which is like
itself only; equal texts have equal fingerprints, whatever stands around them.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.common import OWN, freed, slices
from noticeworks.llm.tokens import Words, mix

SAMPLES = 128
#: Rows of a table of words by samples that are worked on at once.
ROWS = 2048
#: Rows of one range of neighbours, about, and most ranges.
RANGE_ROWS, RANGES = 4000, 8192

_SEEDS = mix(np.arange(1, SAMPLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[None]


def _uniform(h: np.ndarray, shift: int, bits: int) -> np.ndarray:
    """Numbers between 0 and 1 from ``bits`` bits of ``h``."""
    part = ((h >> np.uint64(shift)) & np.uint64((1 << bits) - 1)).astype(np.float32)
    return (part + np.float32(0.5)) * np.float32(2.0**-bits)


def logs(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """ln a of every sample (columns) for words (hashes) of the given counts (rows)."""
    x = mix(words[:, None] ^ _SEEDS)
    y = x * np.uint64(0xD6E8FEB86659FD93)
    y ^= y >> np.uint64(32)
    r = -np.log(_uniform(x, 0, 32) * _uniform(x, 32, 32))  # Gamma(2, 1) is a sum of two exponentials
    c = -np.log(_uniform(y, 0, 21) * _uniform(y, 21, 21))
    b = _uniform(y, 42, 22)
    t = np.floor(np.log(counts.astype(np.float32))[:, None] / r + b)
    return np.log(c) - r * (t - b + np.float32(1))


def signatures(texts: list[bytes]) -> np.ndarray:
    """A row of 16-bit samples for each text."""
    words = Words(texts)
    hashes = words.hashes()
    doc = np.repeat(np.arange(len(texts)), np.diff(words.first))
    out = np.full((len(texts), SAMPLES), 0xFFFF, np.uint16)
    if not len(hashes):
        return out
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    new = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (d[1:] != d[:-1]))))
    h, d, n = h[new], d[new], np.diff(np.append(new, len(h)))
    # Words of one count are drawn for once, whichever texts have them.
    pair = np.lexsort((n, h))
    first = np.concatenate(([True], (h[pair][1:] != h[pair][:-1]) | (n[pair][1:] != n[pair][:-1])))
    at = np.empty(len(h), np.int64)
    at[pair] = np.cumsum(first) - 1
    h, n = h[pair][first], n[pair][first]
    table = np.empty((len(h), SAMPLES), np.float32)
    for k in range(0, len(h), ROWS):
        table[k : k + ROWS] = logs(h[k : k + ROWS], n[k : k + ROWS])
    own, starts = np.unique(d, return_index=True)
    ends = np.append(starts[1:], len(d))
    k = 0
    while k < len(own):
        stop = max(k + 1, bisect.bisect_right(ends, starts[k] + 8 * ROWS))
        a, b = starts[k], ends[stop - 1]
        if b - a > 8 * ROWS:  # one long text
            least = np.min([table[at[i : min(b, i + 8 * ROWS)]].min(axis=0) for i in range(a, b, 8 * ROWS)], axis=0)[None]
        else:
            least = np.minimum.reduceat(table[at[a:b]], starts[k:stop] - a)
        out[own[k:stop]] = (mix(least.view(np.uint32).astype(np.uint64)) & np.uint64(0xFFFF)).astype(np.uint16)
        k = stop
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by the beginning of ``following``, as long if that is long enough."""
    k = len(text) // 2
    return text[: len(text) - k] + following[:k]


def with_successors(df: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (range, id, text, guest) dealt by ranges of ids and sorted, each range ending with a guest.

    The guest is a copy of the row that comes next after the range (after the last row, the first). Equal ids
    are ordered by a hash of the text, and null ids come last.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_).alias("id"), F.col(text).cast("string").alias("text"))
    total = rows.count()
    n = max(1, min(RANGES, total // RANGE_ROWS))
    bounds = sorted(set(rows.approxQuantile("id", [k / n for k in range(1, n)], 1 / (4 * n)))) if n > 1 else []
    below = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < F.col("id"))) if bounds else F.lit(0)
    place = F.when(F.col("id").isNull(), len(bounds) + 1).otherwise(below).cast("int")
    rows = rows.select(place.alias("range"), F.col("id").isNull().alias("last"), "id", F.coalesce(F.xxhash64("text"), F.lit(0)).alias("th"), "text")
    heads = rows.groupBy("range").agg(F.min(F.struct("last", "id", "th")).alias("h")).orderBy("range").collect()
    if not heads:
        return rows.select("range", "id", "text", F.lit(False).alias("guest"))
    to = [(heads[k - 1]["range"], h["h"]["id"], h["h"]["th"]) for k, h in enumerate(heads)]  # the first goes to the last
    kind = rows.schema["id"].dataType.simpleString()
    to = spark.createDataFrame(to, f"{OWN}to int, {OWN}id {kind}, {OWN}th long")
    same = F.col("id").eqNullSafe(F.col(OWN + "id")) & (F.col("th") == F.col(OWN + "th"))
    guests = rows.join(F.broadcast(to), same)  # a row for each range: bounded by RANGES
    guests = guests.select(F.col(OWN + "to").alias("range"), F.lit(True).alias("guest"), "last", "id", "th", "text")
    guests = guests.dropDuplicates(["range"])
    every = rows.select("range", F.lit(False).alias("guest"), "last", "id", "th", "text").union(guests)
    every = every.repartition("range").sortWithinPartitions("range", "guest", "last", "id", "th")
    return every.select("range", "id", "text", "guest")


def with_fingerprints(df: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, n_chars, edited text, both fingerprints (hex) and their likenesses to each other and the next row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row whose successor has not come yet
        for batch in freed(batches):
            for part in slices(batch, "text"):
                texts = [t or "" for t in part.column(2).to_pylist()]
                ids, guests = part.column(1).to_pylist(), part.column(3).to_pylist()
                before = [held[1:] if held else (None, None, True), *zip(ids, texts, guests, strict=True)]
                pairs = [k for k in range(len(texts)) if not before[k][2]]  # a row and its successor, number k here
                changed = [edited(before[k][1], texts[k]) for k in pairs]
                prints = signatures([t.encode() for t in (*texts, *changed)])  # words in both are drawn for once
                of = [held[0] if held else None, *prints[: len(texts)]]
                others = prints[len(texts) :]
                held = (of[-1], *before[-1])
                if not pairs:
                    continue
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([before[k][0] for k in pairs], part.schema.field(1).type),
                        pa.array([len(before[k][1]) for k in pairs], pa.int64()),
                        pa.array(changed, pa.string()),
                        pa.array([_hex(of[k]) for k in pairs], pa.string()),
                        pa.array([_hex(e) for e in others], pa.string()),
                        pa.array([likeness(of[k], e) for k, e in zip(pairs, others, strict=True)], pa.float64()),
                        pa.array([likeness(of[k], of[k + 1]) for k in pairs], pa.float64()),
                    ],
                    [id_, "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                )

    kind = df.schema[id_].dataType.simpleString()
    schema = f"{id_} {kind}, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_successors(df, id_, text).mapInArrow(run, schema)


def _hex(row: np.ndarray) -> str:
    return row.astype(">u2").tobytes().hex()

"""Near copies by SimHash: a grid over segment popcounts, Manhattan distance as bound, exact verification.

A 64-bit fingerprint is mapped to the vector of the popcounts of its segments. Two fingerprints that
differ in d bits have vectors at a Manhattan distance of at most d. So with the segments in groups, all but d
groups of close vectors are equal: the grid's cells are the equal parts, and every pair within the radius
meets in a cell. In a cell the Manhattan distance is tested first and the fingerprints' own distance then.

Equal fingerprints are one node, however many documents have them. A cell is worked off inside one task up to
``CELL`` nodes, giving a spanning forest of its links, never its pairs. The nodes of larger cells go through a second
grid with segments of one bit, whose cells leave 8 bits open (at the radius of 2) and so cannot hold more than 256.

Defined results: null and blank texts have fingerprint zero and are linked like any other; rows without an id
get a component but never name one; equal ids stay separate rows; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from noticeworks.llm.common import OWN, delete_written, freed, written
from noticeworks.llm.components import components

BITS, SEED = 64, 42
#: Most nodes of a cell that one task compares.
CELL = 4096
EVEN_BITS = 0x5555555555555555
#: Shingles whose bits are counted at once.
RUN = 1 << 16


def fingerprint(text: bytes | None, words: int = 3) -> int:
    """Bit i is set if it is in over half of the XXH64 hashes of the text's word shingles."""
    parts = (text or b"").lower().split()  # of bytes: A-Z only, and blanks 0x20, 0x09-0x0D
    if not parts:
        return 0
    joined = b" ".join(parts)
    n = max(1, len(parts) - words + 1)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    ends = ends[min(words, len(parts)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for k in range(0, n, RUN):
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[k : k + RUN], ends[k : k + RUN], strict=True)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def with_fingerprints(df: DataFrame, text: str = "text", name: str = "fp", words: int = 3) -> DataFrame:
    """``df`` without ``text`` and with the fingerprint, as a signed long, in ``name``."""
    rest = [c for c in df.columns if c not in (text, name)]
    schema = StructType([*(df.schema[c] for c in rest), StructField(name, LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freed(batches):
            values = [fingerprint(t.as_py(), words) for t in batch.column(len(rest))]
            column = pa.array(np.array(values, np.uint64).astype(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], column], [*rest, name])

    return df.select(*rest, F.col(text).cast("binary").alias(OWN + "text")).mapInArrow(run, schema)


def popcounts(fp: Column) -> Column:
    """Popcounts of the 32 two-bit segments, each in the two bits of its segment."""
    low, high = fp.bitwiseAND(F.lit(EVEN_BITS)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(EVEN_BITS))
    return low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def _signed(n: int) -> int:
    return n - (1 << BITS) if n >> (BITS - 1) else n


def _masks(groups: int, radius: int) -> list[int]:
    """Bits of all but ``radius`` of ``groups`` equal groups, for every choice."""
    edges = [BITS * g // groups for g in range(groups + 1)]
    spans = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [_signed(sum(spans[g] for g in left)) for left in combinations(range(groups), groups - radius)]


def _cells(nodes: DataFrame, vector: Column, masks: list[int]) -> DataFrame:
    keys = F.array(*(F.struct(F.lit(i).alias("grid"), vector.bitwiseAND(F.lit(m)).alias("at")) for i, m in enumerate(masks)))
    return nodes.select("fp", F.explode(keys).alias("cell"))


def _distances(values: np.ndarray, others: np.ndarray, radius: int) -> np.ndarray:
    """Which of ``others`` differ from each of ``values`` in 1 to ``radius`` bits."""
    even = np.uint64(EVEN_BITS)
    counts = lambda x: x - ((x >> np.uint64(1)) & even)
    a, b = counts(values)[:, None], counts(others)[None, :]
    # |x - y| of two-bit numbers up to 2 is at least 1 where they differ: a cheap lower bound of the distance.
    differ = a ^ b
    bound = np.bitwise_count((differ | (differ >> np.uint64(1))) & even)
    near = bound <= radius
    rows, cols = np.nonzero(near)
    exact = np.bitwise_count(values[rows] ^ others[cols]) <= radius
    near[rows[~exact], cols[~exact]] = False
    return near


def forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the graph that joins values within ``radius``."""
    if len(values) == 2:
        return [(0, 1)] if int(values[0] ^ values[1]).bit_count() <= radius else []
    root = list(range(len(values)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = []
    step = max(1, (1 << 20) // len(values))
    for k in range(0, len(values), step):
        rows, cols = np.nonzero(_distances(values[k : k + step], values, radius))
        for i, j in zip((rows + k).tolist(), cols.tolist(), strict=True):
            if i < j and (a := find(i)) != (b := find(j)):
                root[a] = b
                links.append((i, j))
    return links


def _linked(groups: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) within each row's list ``fps``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freed(batches):
            a, b = [], []
            for fps in batch.column(0):
                values = fps.values.to_numpy(zero_copy_only=False).astype(np.int64)
                for i, j in forest(values.view(np.uint64), radius):
                    a.append(values[i])
                    b.append(values[j])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return groups.select("fps").mapInArrow(run, "a long, b long")


def near_links(nodes: DataFrame, radius: int = 2, groups: int = 4, cell: int = CELL, fine: int | None = None) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``fp`` that connect all those within ``radius`` bits.

    A link that other links already connect inside one cell is left out. ``fine``: groups of the second grid, 8 * ``radius``
    unless given; fewer make fewer but larger cells, which leave 64 * ``radius`` / ``fine`` bits open.
    """
    fine = fine or 8 * radius
    if not radius < min(groups, fine):
        raise ValueError("more groups than differing bits are needed")
    nodes = nodes.select("fp")
    cells = written(_cells(nodes, popcounts(F.col("fp")), _masks(groups, radius)), "cells")
    # Sizes are written before they are joined, so that the join's hot cells can be split.
    sizes = written(cells.groupBy("cell").count().filter("count > 1"), "cell-sizes")
    shared = cells.join(sizes, "cell")
    small = shared.filter(F.col("count") <= cell).groupBy("cell").agg(F.collect_list("fp").alias("fps"))
    crowded = shared.filter(F.col("count") > cell).select("fp").distinct()
    second = _cells(crowded, F.col("fp"), _masks(fine, radius))
    second = second.groupBy("cell").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
    links = written(_linked(small.select("fps").union(second.select("fps")), radius), "near-links")
    delete_written(cells)
    delete_written(sizes)
    return links


def roots(prints: DataFrame, radius: int = 2, groups: int = 4, cell: int = CELL) -> DataFrame:
    """(fp, root) of every fingerprint that is linked to another; the root is one of them."""
    links = near_links(prints.select("fp").distinct(), radius, groups, cell)
    return components(links).select(F.col("node").alias("fp"), "root")


def near_copies(prints: DataFrame, radius: int = 2, groups: int = 4, cell: int = CELL) -> DataFrame:
    """``prints`` (id, fp) with ``component_id``: the least id linked directly or through others.

    ``prints`` should be a written table, as it is read several times.
    """
    id_ = prints.columns[0]
    least = prints.groupBy("fp").agg(F.min(id_).alias(OWN + "least"))
    linked = written(roots(prints, radius, groups, cell).join(least, "fp"), "linked")
    by_root = written(linked.groupBy("root").agg(F.min(OWN + "least").alias(OWN + "of")), "least-of-roots")
    of = linked.join(by_root, "root").select("fp", OWN + "of")
    named = least.join(of, "fp", "left").select("fp", F.coalesce(OWN + "of", OWN + "least").alias("component_id"))
    named = written(named, "named")  # the join on it can be split, where one fingerprint is hot
    return prints.join(named, "fp", "left").select(*prints.columns, "component_id")

"""Near copies by SimHash, decided by the Jaccard similarity of word shingles; MinHash bands find what lies beyond the radius.

A text is the set of its runs of ``WIDTH`` words, lower-cased (of all its words, where it has fewer). Texts of equal sets are one
node, however many documents have them. A node's SimHash is the majority vote over the hashes of its shingles. The grid of
``simhash`` over segment popcounts, with the Manhattan distance as bound, links the fingerprints within ``RADIUS`` bits, and
the shingles themselves verify each link.

Texts of similarity 0.8 have fingerprints about 10 bits apart, and no grid with small cells holds such a radius. So nodes also meet
in a cell if all ``PER_BAND`` least hashes of one of ``BANDS`` bands are equal; at similarity 0.8 none of the bands is equal
in 1 of 300,000 pairs, above it in fewer. Pairs that the grid has found already are not compared again. Every link is
verified on the shingles, so there are none below ``LEAST``.

Of a band's cell, each node is compared with the least one first, which joins a large group of near copies by a row a
node. After that only nodes of a cell that are not linked yet, directly or through others, by the grid or the bands, are compared, each with each.

Defined results: null and blank texts are one node and like themselves only; rows without an id are kept like any others;
an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from noticeworks.llm import simhash
from noticeworks.llm.common import OWN, delete_written, freed, slices, written
from noticeworks.llm.components import components
from noticeworks.llm.tokens import Words, mix, runs

WIDTH, BANDS, PER_BAND = 5, 24, 4
#: Bits that linked fingerprints differ in at most; groups of segments of the grid, and of its second grid for crowded cells.
RADIUS, GROUPS, FINE = 3, 5, 12
#: Least similarity, as a fraction, so that it is compared in whole numbers.
LEAST = (4, 5)
#: Shingles that are hashed by all seeds at once.
ROWS = 4096

_SEEDS = mix(np.arange(1, BANDS * PER_BAND + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[None]


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The hashes of each text's shingles, sorted, every one once."""
    words = Words(texts)
    hashes, first = words.hashes(), words.first
    n = np.diff(first)
    counts = np.where(n > 0, np.maximum(n - WIDTH + 1, 1), 0)
    of = np.repeat(np.arange(len(texts)), counts)
    ends = np.cumsum(counts)
    starts = np.arange(len(of)) - np.repeat(ends - counts, counts) + first[:-1][of]
    every = runs(hashes, starts, np.minimum(starts + WIDTH, first[1:][of]))
    return [np.unique(every[b - c : b]) for b, c in zip(ends.tolist(), counts.tolist(), strict=True)]


def bands(shingles: np.ndarray) -> np.ndarray:
    """The keys of the cells of a set of shingles; none for the empty set."""
    if not len(shingles):
        return np.zeros(0, np.uint64)
    least = None
    for k in range(0, len(shingles), ROWS):
        x = (shingles[k : k + ROWS, None] ^ _SEEDS) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0x94D049BB133111EB)
        low = x.min(axis=0)
        least = low if least is None else np.minimum(least, low)
    starts = np.arange(BANDS) * PER_BAND
    return mix(runs(mix(least), starts, starts + PER_BAND) + np.arange(BANDS, dtype=np.uint64))


def fingerprint(shingles: np.ndarray) -> int:
    """Bit i is set if it is in over half of the shingles' hashes; zero for the empty set."""
    ones = np.zeros(simhash.BITS, np.int64)
    for k in range(0, len(shingles), simhash.RUN):
        part = np.ascontiguousarray(shingles[k : k + simhash.RUN])
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(shingles), bitorder="little").view("<i8")[0])


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the Jaccard similarity of two sets of shingles is ``LEAST`` or more."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * LEAST[1] >= (len(a) + len(b) - both) * LEAST[0]


def node_of(shingles: np.ndarray) -> int:
    return int(runs(shingles, np.zeros(1, np.int64), np.array([len(shingles)])).view(np.int64)[0])


def _prints(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(key, node, size, fp, cells) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freed(batches):
            for part in slices(batch, OWN + "text"):
                sets = shingle_sets([t or b"" for t in part.column(1).to_pylist()])
                cells = pa.array([bands(s).view(np.int64) for s in sets], pa.list_(pa.int64()))
                nodes = pa.array([node_of(s) for s in sets], pa.int64())
                sizes = pa.array([len(s) for s in sets], pa.int64())
                fps = pa.array([fingerprint(s) for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), nodes, sizes, fps, cells], [key, "node", "size", "fp", "cells"])

    texts = rows.select(key, F.col(text).cast("binary").alias(OWN + "text"))
    schema = texts.select(key).schema.add("node", "long").add("size", "long").add("fp", "long").add("cells", ArrayType(LongType()))
    return texts.mapInArrow(run, schema)


def _sets(rows: DataFrame, text: str) -> DataFrame:
    """(node, shingles) of rows with a column ``node``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freed(batches):
            for part in slices(batch, OWN + "text"):
                sets = shingle_sets([t or b"" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "shingles"])

    return rows.select("node", F.col(text).cast("binary").alias(OWN + "text")).mapInArrow(run, "node long, shingles binary")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freed(batches):
            good = [alike(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _of_near_size(x: str, y: str) -> F.Column:
    """Sets whose sizes differ by more cannot be alike."""
    return F.least(x, y) * LEAST[1] >= F.greatest(x, y) * LEAST[0]


def grid_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of ``nodes`` (node, size, fp) to verify: those that connect all fingerprints within ``RADIUS`` bits.

    Nodes of one fingerprint pair with the least of them, which stands for it in the grid. ``nodes`` should be a written table.
    """
    nodes = nodes.filter("size > 0")
    of = written(nodes.groupBy("fp").agg(F.struct(F.min("node").alias("node"), F.count("*").alias("n")).alias("of")), "fingerprints")
    near = simhash.near_links(of.select("fp"), RADIUS, GROUPS, fine=FINE)
    left, right = (of.select(F.col("fp").alias(c), F.col("of.node").alias(f"{c}_node")) for c in "ab")
    near = near.join(left, "a").join(right, "b").select(F.col("a_node").alias("x"), F.col("b_node").alias("y"))
    equal = nodes.join(of.filter("of.n > 1"), "fp").filter("node <> of.node").select(F.col("of.node").alias("x"), F.col("node").alias("y"))
    pairs = near.union(equal).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return written(pairs.distinct(), "grid-pairs")


def _links(shared: DataFrame, sets: DataFrame, tried: DataFrame, found: DataFrame) -> DataFrame:
    """Links (a, b) that connect all nodes of ``shared`` (cell, node, size) that are alike and meet in a cell, ``found`` among them.

    ``found`` are the links among the pairs ``tried``, which are not compared again.
    """
    # What is counted by cell is written before it is joined, so that the joins' hot cells can be split.
    first = written(shared.groupBy("cell").agg(F.min(F.struct("node", "size")).alias("first")), "first-of-cells")
    pairs = shared.join(first, "cell").filter(F.col("node") != F.col("first.node")).filter(_of_near_size("size", "first.size"))
    pairs = pairs.select(F.col("first.node").alias("a"), F.col("node").alias("b")).distinct()
    compared = written(pairs.join(tried, ["a", "b"], "left_anti"), "first-pairs")
    links = written(found.union(_verified(compared, sets)), "first-links")
    compared = compared.union(tried)
    roots = written(components(links).select("node", "root"), "first-roots")
    parts = written(shared.join(roots, "node", "left").select("cell", F.coalesce("root", "node").alias("root"), "node", "size"), "parts")
    several = parts.groupBy("cell").agg(F.min("root").alias("m"), F.max("root").alias("x")).filter("m < x").select("cell")
    several = written(several, "cells-of-several")
    parts = parts.join(several, "cell", "left_semi")
    groups = parts.select("cell", "root").distinct()
    met = groups.withColumnRenamed("root", "ra").join(groups.withColumnRenamed("root", "rb"), "cell").filter("ra < rb")
    left = parts.select("cell", F.col("root").alias("ra"), F.col("node").alias("na"), F.col("size").alias("sa"))
    right = parts.select("cell", F.col("root").alias("rb"), F.col("node").alias("nb"), F.col("size").alias("sb"))
    rest = met.join(left, ["cell", "ra"]).join(right, ["cell", "rb"]).filter(_of_near_size("sa", "sb"))
    rest = rest.select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b")).distinct().join(compared, ["a", "b"], "left_anti")
    return links.union(written(_verified(rest, sets), "further-links"))


def firsts(rows: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The least ``key`` of each group of rows whose texts are alike, directly or through others.

    ``rows`` should be a written table, as it is read twice; no two rows have the same key.
    """
    prints = written(_prints(rows, key, text), "shingled")
    nodes = prints.groupBy("node").agg(F.min(key).alias(key), *(F.first(c).alias(c) for c in ("size", "fp", "cells")))
    nodes = written(nodes, "nodes")
    delete_written(prints)
    cells = nodes.select("node", "size", F.explode("cells").alias("cell"))
    crowded = written(cells.groupBy("cell").count().filter("count > 1").select("cell"), "crowded-cells")
    shared = cells.join(crowded, "cell")
    shared = written(shared.select("cell", "node", "size"), "shared-cells")
    tried = grid_pairs(nodes)
    met = shared.select("node").union(tried.select("a")).union(tried.select("b")).distinct()
    wanted = nodes.join(met, "node", "left_semi").select(key, "node")
    sets = written(_sets(rows.select(key, text).join(wanted, key), text), "shingle-sets")
    found = written(_verified(tried, sets), "grid-links")
    roots = components(_links(shared, sets, tried, found))
    of = nodes.select(key, "node").join(roots, "node", "left")
    return of.groupBy(F.coalesce("root", "node").alias(OWN + "root")).agg(F.min(key).alias(key)).select(key)

"""A uniform random shuffle into shards of exact sizes, by a communication matrix.

How many rows of partition p go to shard s follows the multivariate hypergeometric law that a uniform
random permutation of all rows induces. So this matrix is drawn first, from row counts alone; then each
partition deals its rows, in a random order of its own, to the shards by the drawn counts; the rows are
exchanged; and each shard orders what it received at random. The result is a uniform permutation cut
into shards whose row counts differ by one at most.

Rows are first written with partition and place, so that what a lost executor did is redone alike, and
so that equal rows, or one key with most of the rows, have no influence on where they go. The driver
draws the matrix from one count per partition. A shard is ordered in blocks: a random key cuts it into
blocks of about ``block_rows`` rows, so no task holds a whole shard.

Defined results: null values in any column, repeated rows and ties are just rows; an empty table gives an
empty one; with fewer rows than shards the later shards stay empty. Columns of the input that have the names of the
added ones are replaced.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeworks.llm.common import OWN, written

#: Up to here numpy's own hypergeometric sampler is exact.
NUMPY_LIMIT = 1_000_000_000


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` from ``good + bad`` are good; also where the counts pass numpy's limit.

    There by inversion outwards from the mode, which takes steps of the order of the standard deviation.
    """
    if good + bad < NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, drawn))
    if drawn == 0 or good == 0:
        return 0
    if bad == 0:
        return drawn
    low, high = max(0, drawn - bad), min(good, drawn)
    mode = min(high, max(low, (drawn + 1) * (good + 1) // (good + bad + 2)))

    def up(k: int) -> float:  # P(k + 1) / P(k)
        return (good - k) * (drawn - k) / ((k + 1) * (bad - drawn + k + 1))

    width = 12 * math.isqrt(1 + (good * bad * drawn * (good + bad - drawn)) // (good + bad) ** 3) + 40
    a, b = max(low, mode - width), min(high, mode + width)  # what lies beyond has less weight than a float can add
    weights = np.ones(b - a + 1)
    for k in range(mode, b):
        weights[k + 1 - a] = weights[k - a] * up(k)
    for k in range(mode, a, -1):
        weights[k - 1 - a] = weights[k - a] / up(k - 1)
    total = np.cumsum(weights)
    return a + int(np.searchsorted(total, rng.random() * total[-1], side="right"))


def matrix(counts: list[int], shards: int, seed: int) -> list[list[int]]:
    """Row counts from partition to shard: margins are ``counts`` and shard sizes at most one apart."""
    rng = np.random.default_rng(seed)
    total = sum(counts)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    out = []
    for n in counts:
        left, open_room, row = n, sum(room), []
        for s in range(shards):
            open_room -= room[s]
            k = hypergeometric(rng, room[s], open_room, left) if open_room else left
            row.append(k)
            left -= k
        room = [r - k for r, k in zip(room, row, strict=True)]
        out.append(row)
    return out


def _random(seed: int, salt: int, *cols: str) -> Column:
    return F.xxhash64(F.lit(seed), F.lit(salt), *cols)


def shuffle_shards(df: DataFrame, shards: int, seed: int = 7, block_rows: int = 250_000) -> DataFrame:
    """``df`` with ``shard`` (int, from 0) and ``slot`` (long, gapless from 0 within its shard)."""
    spark = df.sparkSession
    part, place, key = OWN + "part", OWN + "place", OWN + "key"
    mono = F.monotonically_increasing_id()
    rows = df.drop("shard", "slot").withColumns({part: F.spark_partition_id(), place: mono % (1 << 33)})
    rows = written(rows, "shard-rows")
    sizes = [(r[0], r[1]) for r in rows.groupBy(part).count().orderBy(part).collect()]
    total = sum(n for _, n in sizes)
    drawn = matrix([n for _, n in sizes], shards, seed)
    bounds = [(p, np.cumsum(row).tolist()) for (p, _), row in zip(sizes, drawn, strict=True)]
    bounds = spark.createDataFrame(bounds, f"{part} int, {OWN}ends array<bigint>")
    # Permute locally and deal out: the first rows of the random order to shard 0, the next to shard 1, …
    local = Window.partitionBy(part).orderBy(_random(seed, 1, part, place), place)
    dealt = rows.withColumn(OWN + "turn", F.row_number().over(local)).join(bounds, part)
    shard = F.size(F.filter(OWN + "ends", lambda e: e < F.col(OWN + "turn"))).alias("shard")
    blocks = max(1, math.ceil(total / shards / block_rows))
    own = [c for c in dealt.columns if not c.startswith(OWN)]
    dealt = dealt.select(*own, shard, part, place, _random(seed, 2, part, place).alias(key))
    # The key's high bits name the block, so blocks in order, each ordered by key, order the shard by key.
    block = (F.shiftrightunsigned(key, 33) * blocks / F.lit(1 << 31)).cast("int").alias(OWN + "block")
    dealt = dealt.select("*", block)
    dealt = written(dealt, "shard-dealt")
    ahead = Window.partitionBy("shard").orderBy(OWN + "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("shard", OWN + "block").agg(F.count("*").alias(OWN + "n"))
    starts = starts.select("shard", OWN + "block", F.coalesce(F.sum(OWN + "n").over(ahead), F.lit(0)).alias(OWN + "start"))
    within = Window.partitionBy("shard", OWN + "block").orderBy(F.shiftrightunsigned(key, 1), key, part, place)
    out = dealt.withColumn(OWN + "rank", F.row_number().over(within)).join(starts, ["shard", OWN + "block"])
    return out.select(*own, "shard", (F.col(OWN + "start") + F.col(OWN + "rank") - 1).alias("slot"))

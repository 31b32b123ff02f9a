"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.common import delete_written, written


def _with_least(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (u, v) with ``m``, the least of u and its partners; and the working table behind it.

    The least ones are written: a join in the stage of its aggregate is never split, however hot one key is.
    """
    least = written(pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least")
    return pairs.join(least, "u"), least


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    linked, least = _with_least(both)
    out = written(linked.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
    delete_written(least)
    return out


def _small_star(links: DataFrame) -> DataFrame:
    """Expects u > v in every row, as the large star gives them."""
    linked, least = _with_least(links)
    moved = linked.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = written(moved.union(linked.select("u", F.col("m").alias("v"))).distinct(), "links")
    delete_written(least)
    return out


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (two columns of one type); the root is the least node.

    Each step is written to the shared folder and the one before deleted. A hub is one key with many
    rows: its least partner is found with partial aggregation and written, and both sides of the join on it are
    shuffled for it alone, so that adaptive execution can split it. Null ends and loops are no links.
    """
    a, b = links.columns
    links = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(F.col(a) != F.col(b))
    links, before = written(links.distinct(), "links"), None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                links.select("v", "v").distinct()
            )
        old, before = links, state
        star = _large_star(links)
        links = _small_star(star)
        delete_written(old)
        delete_written(star)

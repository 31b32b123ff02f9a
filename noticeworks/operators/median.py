"""Exact median without gathering the values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_BUCKETS = 4096
_DIRECT = 100_000
#: A value of the quantile sketch is at most n / _ACCURACY ranks off.
_ACCURACY = 10_000


def exact_median(df: DataFrame, column: str, buckets: int = _BUCKETS, direct: int = _DIRECT) -> float | None:
    """Interpolated median of a numeric column, ignoring NULL and NaN; None without values.

    Spark's own ``median`` holds every distinct value in one task. Here a first scan counts the values and sketches their
    quantiles: two values a little below and above the middle rank, by more than the sketch can be off. A second scan
    counts what lies below, between and above, and the values between are ranked: two scans.

    Where more than ``direct`` values may lie between, or infinities have moved the middle, the range is cut into
    equal buckets instead, which are only counted; the bucket with the middle rank is cut again until its
    values are few enough or all alike. Each pass moves one small row per bucket and task.
    """
    v = df.select(F.col(column).cast("double").alias("v")).filter(
        F.col("v").isNotNull() & ~F.isnan("v")
    )
    inf = float("inf")
    finite = F.when(F.abs("v") < inf, F.col("v"))
    around = [0.5 - 2 / _ACCURACY, 0.5 + 2 / _ACCURACY]
    total, n, below, low, high, bounds = v.agg(
        F.count("v"), F.count(finite), F.count_if(F.col("v") == -inf), F.min(finite), F.max(finite),
        F.percentile_approx(finite, around, _ACCURACY),
    ).first()
    if not total:
        return None
    first, last = (total - 1) // 2 + 1, total // 2 + 1  # 1-based ranks of the two middle values
    ends = [-inf if rank <= below else inf for rank in (first, last) if not below < rank <= below + n]
    if ends:  # a middle value is infinite; opposite ends have no middle
        return ends[0] if ends[0] == ends[-1] else float("nan")
    v = v.filter(F.abs("v") < inf)
    if low != high and 6 * n / _ACCURACY <= direct:  # ranks between the bounds, at most
        side = F.when(F.col("v") < bounds[0], -inf).when(F.col("v") > bounds[1], inf).otherwise(F.col("v"))
        a, b = _at_ranks(v.select(side.alias("v")), below, first, last)
        if abs(a) < inf and abs(b) < inf:
            return (a + b) / 2
    while low != high and n > direct:
        inside = v.filter(F.col("v").between(low, high))
        # Halved first, so that the width of the widest range does not overflow.
        share = (F.col("v") / 2 - low / 2) / F.lit(high / 2 - low / 2)
        cut = (
            inside.groupBy(F.least(F.floor(share * buckets), F.lit(buckets - 1)).alias("b"))
            .agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
            .withColumn("upto", F.sum("n").over(Window.orderBy("b")) + F.lit(below))
            .filter(F.col("upto") >= first)
            .orderBy("b")
            .limit(2)
            .collect()
        )
        mid = cut[0]
        if mid["upto"] < last:  # the two middle values lie on both sides of a bucket edge
            return (mid["hi"] + cut[1]["lo"]) / 2
        narrowed = (mid["lo"], mid["hi"]) != (low, high)
        below, n, low, high = mid["upto"] - mid["n"], mid["n"], mid["lo"], mid["hi"]
        if not narrowed:
            break
    if low == high:
        return low
    a, b = _at_ranks(v.filter(F.col("v").between(low, high)), below, first, last)
    return (a + b) / 2


def _at_ranks(v: DataFrame, below: int, first: int, last: int) -> tuple[float, float]:
    """The values at two ranks, where ``below`` values come before those of ``v``; equal values travel as one row."""
    counts = v.groupBy("v").agg(F.count("v").alias("n"))
    ranked = counts.withColumn("upto", F.sum("n").over(Window.orderBy("v")) + F.lit(below))
    return tuple(
        ranked.agg(
            F.min(F.when(F.col("upto") >= first, F.col("v"))),
            F.min(F.when(F.col("upto") >= last, F.col("v"))),
        ).first()
    )

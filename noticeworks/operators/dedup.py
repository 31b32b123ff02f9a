"""Keep-one-per-key operators.

``row_number() = 1`` is planned by Spark as a group limit before *and* after the shuffle: every map
task first cuts a key down to its own best row, so a key holding a third of all rows sends one row
per task, not all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeworks import fixed_values as fixed
from noticeworks.functions.text import text_key
from noticeworks.operators.lookup import is_small
from noticeworks.session import new_path

# Largest k for which Spark limits groups before the shuffle.
_GROUP_LIMIT = 1000
_SALTS = 64


def keep_first(df: DataFrame, key: str | list[str], order: list[Column | str]) -> DataFrame:
    """First row per key in an explicit order."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def first_n_per_key(df: DataFrame, key: str | list[str], order: list[Column | str], n: int) -> DataFrame:
    """First ``n`` rows per key; adds ``_rn``.

    Beyond the size Spark limits by itself, each key is first cut within 64 salted shares.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if n > _GROUP_LIMIT:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(_SALTS))
        w = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = (
            df.withColumn("_salt", salt)
            .withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") <= n)
            .drop("_rn", "_salt")
        )
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)


def richest_group() -> list[Column]:
    """What notices of one group have in common: buyer and title by letters and digits, the title by its first 50, and the value."""
    return [text_key("buyer_name").alias("_buyer"), F.col("value_amount").alias("_value"), text_key("title", 50).alias("_title")]


def _richness() -> list[Column]:
    """Columns to sort a group by, the richest notice first; none of them is long."""
    return [
        F.col("awards").isNotNull().alias("_has_awards"),
        F.coalesce(F.col("supplier_name") != fixed.UNKNOWN_SUPPLIER, F.lit(False)).alias("_named"),
        F.col("value_amount").isNotNull().alias("_valued"),
        F.col("published_date").alias("_day"),
        F.col("source").alias("_source"),
        F.col("notice_id").alias("_id"),
    ]


def richest_ids(notices: DataFrame) -> DataFrame:
    """``notice_id`` of the notices that ``dedup_richest`` keeps. Only keys, flags, dates and ids are shuffled, no texts."""
    narrow = notices.select(*richest_group(), *_richness())
    order = [
        F.col("_has_awards").desc(),
        F.col("_named").desc(),
        F.col("_valued").desc(),
        F.col("_day").desc_nulls_last(),
        F.col("_source").asc_nulls_last(),
        F.col("_id").asc_nulls_last(),
    ]
    return keep_first(narrow, ["_buyer", "_value", "_title"], order).select(F.col("_id").alias("notice_id"))


def dedup_stored(notices: DataFrame) -> DataFrame:
    """``dedup_richest`` of a stored table, in which every notice id stands once: winners from narrow rows, then a look-up.

    The table is read twice, its texts once. Where winners, or else losers, are measured small, they are sent to that
    scan and no text is shuffled; otherwise winners and table are joined by id, and only then do texts move.
    """
    spark = notices.sparkSession
    path = new_path(spark, "richest")
    richest_ids(notices).write.parquet(path)
    winners = spark.read.parquet(path)
    if is_small(winners):
        return notices.join(F.broadcast(winners), "notice_id", "left_semi")
    losers = notices.select("notice_id").join(winners, "notice_id", "left_anti")
    path = new_path(spark, "poorer")
    losers.write.parquet(path)
    losers = spark.read.parquet(path)
    if is_small(losers):
        return notices.join(F.broadcast(losers), "notice_id", "left_anti")
    return notices.join(winners, "notice_id", "left_semi")


def dedup_richest(notices: DataFrame) -> DataFrame:
    """One notice per buyer, value and title: the richest one.

    Buyer and title are compared by letters and digits, the title by its first 50 of them. Richest
    means: has awards, names a supplier, has a value, then the latest, then source and notice id.
    """
    named = F.coalesce(F.col("supplier_name") != fixed.UNKNOWN_SUPPLIER, F.lit(False))
    w = Window.partitionBy(
        text_key("buyer_name"), F.col("value_amount"), text_key("title", 50)
    ).orderBy(
        F.col("awards").isNotNull().desc(),
        named.desc(),
        F.col("value_amount").isNotNull().desc(),
        F.col("published_date").desc_nulls_last(),
        F.col("source").asc_nulls_last(),
        F.col("notice_id").asc_nulls_last(),
    )
    return notices.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")

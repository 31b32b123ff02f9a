"""Organisation names: resolving them through the alias table and finding unknown ones."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeworks.functions.text import alias_key
from noticeworks.operators.dedup import keep_first
from noticeworks.operators.lookup import is_small

AliasPolicy = Literal["distinct", "as_is"]


def alias_lookup(aliases: DataFrame, policy: AliasPolicy = "distinct") -> DataFrame:
    """``(_key, canonical_name)`` of the alias table, marked for broadcast if that is small.

    Spellings that differ only in case share a key. ``distinct`` keeps one row per key and canonical
    name; ``as_is`` keeps the repeats, which then count a matching row once per spelling.
    """
    lookup = aliases.select(alias_key("raw_name").alias("_key"), "canonical_name")
    if policy == "distinct":
        lookup = lookup.distinct()
    # No more rows than the alias table has, so that is what is measured.
    return F.broadcast(lookup) if is_small(aliases) else lookup


def resolve(df: DataFrame, name: str, aliases: DataFrame, output: str = "canonical_name") -> DataFrame:
    """Add the canonical name, NULL where there is no alias. Never adds or drops rows."""
    one = keep_first(
        aliases.select(alias_key("raw_name").alias("_key"), "raw_name", F.col("canonical_name").alias(output)),
        "_key",
        ["raw_name"],
    ).drop("raw_name")
    if is_small(aliases):
        one = F.broadcast(one)
    return df.withColumn("_key", alias_key(name)).join(one, "_key", "left").drop("_key")


def alias_join(df: DataFrame, name: str, aliases: DataFrame, policy: AliasPolicy = "as_is") -> DataFrame:
    """Rows that have an alias, once for each."""
    return df.withColumn("_key", alias_key(name)).join(alias_lookup(aliases, policy), "_key").drop("_key")


def unmatched_names(df: DataFrame, name: str, aliases: DataFrame) -> DataFrame:
    """Distinct normalised names without an alias, sorted: the rows of SQL ``NOT IN``.

    Its null rules are spelled out so that a large alias table can use an ordinary anti join: a NULL
    alias leaves nothing, no alias at all leaves everything, and else NULL names drop out.
    """
    names = df.select(alias_key(name).alias("raw")).distinct()
    keys = aliases.select(alias_key("raw_name").alias("raw"))
    n, n_null = keys.agg(F.count(F.lit(1)), F.count_if(F.col("raw").isNull())).first()
    if n_null:
        names = names.limit(0)
    elif n:
        names = names.filter(F.col("raw").isNotNull()).join(keys, "raw", "left_anti")
    return names.orderBy(F.col("raw").asc_nulls_last())

"""Insert-only merges: existing keys always win, and so does the first of a batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from noticeworks.operators.dedup import keep_first
from noticeworks.operators.lookup import measured
from noticeworks.schemas import KEYS, TABLES, conform


def duplicate_keys(batch: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return batch.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def new_rows(
    batch: DataFrame,
    existing: DataFrame,
    key: str,
    order: list[Column | str] | None,
    flag: str | None = None,
) -> DataFrame:
    """Rows of ``batch`` a merge would insert into ``existing``.

    ``flag`` names the boolean that must be true; it is tested *before* the first row per key is
    taken, so the first relevant row wins. ``order`` says which row is first; None means keys are
    known to be unique. Only the key column of ``existing`` is read.
    """
    if flag is not None:
        batch = batch.filter(F.col(flag))
    if order is not None:
        batch = keep_first(batch, key, order)
    return batch.join(existing.select(key), key, "left_anti")


def known_keys(existing: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The keys of ``existing`` that ``batch`` holds too.

    A batch measured small is sent to the scan of ``existing``, which then is not shuffled: merging
    a small batch costs one read of the key column. ``batch`` is read once for this; persist it.
    """
    keys = batch.select(key)
    return existing.select(key).join(measured(keys), key, "left_semi")


def merge_insert_only(
    batch: DataFrame,
    existing: DataFrame,
    table: str,
    order: list[Column | str] | None,
    flag: str | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """New rows of ``batch`` for a registered table, in the table's own columns and types."""
    return conform(new_rows(batch, existing, KEYS[table], order, flag), schema or TABLES[table])


def merge_notices(batch: DataFrame, existing: DataFrame, order: list[Column | str], keep_all: bool = False) -> DataFrame:
    return merge_insert_only(
        batch, existing, "procurement_notices", order, None if keep_all else "ai_relevant"
    )


def merge_announcements(batch: DataFrame, existing: DataFrame, order: list[Column | str], keep_all: bool = False) -> DataFrame:
    return merge_insert_only(
        batch, existing, "gov_announcements", order, None if keep_all else "ai_relevant"
    )


def merge_questions(batch: DataFrame, existing: DataFrame, order: list[Column | str], keep_all: bool = False) -> DataFrame:
    return merge_insert_only(
        batch, existing, "written_questions", order, None if keep_all else "ai_relevance_flag"
    )


def merge_records(batch: DataFrame, existing: DataFrame) -> DataFrame:
    """Transparency records: no relevance filter, and a new key may occur only once per batch.

    A repeated key fails the job that reads the result, as a unique key would fail the insert.
    :func:`duplicate_keys` lists the repeated ones. The test is part of the plan and counts the keys alone;
    whole rows are neither sorted nor shuffled for it.
    """
    key = KEYS["atrs_records"]
    fresh = conform(new_rows(batch, existing, key, None), TABLES["atrs_records"])
    repeated = duplicate_keys(fresh.select(key), key).agg(F.max(key)).scalar()
    fails = F.raise_error(F.concat(F.lit("key occurs more than once in the batch: "), repeated)).cast("boolean")
    return fresh.filter(F.when(repeated.isNull(), F.lit(True)).otherwise(fails))


def merge_seed(rows: DataFrame, existing: DataFrame, table: str, order: list[Column | str]) -> DataFrame:
    """Curated rows whose key is not there yet."""
    return merge_insert_only(rows, existing, table, order)


def append_new(rows: DataFrame, path: str, **write_options: str) -> int:
    """Append ``rows`` to a Parquet table and return how many there were, in one pass."""
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").options(**write_options).parquet(path)
    return seen.get["n"]

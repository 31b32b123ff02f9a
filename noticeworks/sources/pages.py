"""Landed result pages: scanning, unpacking and storing them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noticeworks import fixed_values as fixed
from noticeworks.functions.text import blank_to_null, last_segment
from noticeworks.operators.dedup import first_n_per_key, keep_first
from noticeworks.schemas import columns

BRONZE_SCHEMA = columns("page string, body string, source string, run_date date, run_id string")


def page_name(page: Column | None = None) -> Column:
    return F.substring_index(F.col("_metadata.file_path"), "/", -1) if page is None else page


def read_pages(spark: SparkSession, path: str, page: Column | None = None, bundled: bool = False) -> DataFrame:
    """One row per landed JSON file: ``(page, body)``. A page is named by its file, or by ``page``.

    ``bundled``: files hold many pages each, under their names (:func:`land_pages`).
    """
    if bundled:
        return bundled_pages(spark.read.text(path, recursiveFileLookup=True))
    return spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(
        page_name(page).alias("page"),
        F.col("value").alias("body"),
    )


def land_pages(pages: DataFrame, root: str) -> None:
    """Store ``pages`` (``page``, ``body``) many to a file, a line each, as :func:`bundled_pages` reads them.

    A page of a few items has no file of its own, so files, and the batches of a stream of them, follow the bytes landed. Line
    breaks in a body become spaces: JSON has them between its parts only. Names of pages hold neither tabs nor line breaks.
    """
    name, body = F.coalesce("page", F.lit("")), F.coalesce("body", F.lit(""))
    line = F.concat(name, F.lit("\t"), F.translate(body, "\r\n", "  "))
    pages.select(line.alias("value")).write.mode("append").text(root)


def bundled_pages(lines: DataFrame) -> DataFrame:
    """``(page, body)`` of lines (``value``) that :func:`land_pages` wrote; lines without a name are no pages."""
    cut = F.instr("value", "\t")
    found = lines.filter(F.contains("value", F.lit("\t")))
    return found.select(F.expr("substring_index(value, '\t', 1)").alias("page"), F.substr("value", cut + 1).alias("body"))


def explode_items(pages: DataFrame, field: str = "results", body: str = "body", unwrap: str | None = None) -> DataFrame:
    """One row per item of each page: adds ``pos`` and ``item`` (JSON text).

    ``unwrap`` names a key whose value replaces the item where it is present.
    """
    items = F.from_json(F.col(body), f"struct<`{field}` array<string>>")[field]
    kept = [c for c in pages.columns if c != body]
    out = pages.select(*kept, F.posexplode(items).alias("pos", "item"))
    return out.withColumn("item", unwrap_item("item", unwrap)) if unwrap else out


def unwrap_item(item: str, key: str) -> Column:
    """What stands under ``key`` of a JSON object, or the object itself without that key."""
    inner = F.from_json(F.col(item), f"struct<`{key}` string>")[key]
    return F.coalesce(inner, F.col(item))


def count_items(body: Column | str, field: str = "results") -> Column:
    c = F.col(body) if isinstance(body, str) else body
    return F.coalesce(F.json_array_length(F.get_json_object(c, f"$.{field}")), F.lit(0))


def cap_per_query(
    pages: DataFrame, query: str, start: str, n_items: str, cap: int = fixed.MAX_ITEMS_PER_QUERY
) -> DataFrame:
    """Pages a fetch loop would have asked for: those starting before ``cap`` items were seen.

    Whole pages are kept, so a query may end a little above the cap; an empty page ends it. A page
    kept has only non-empty pages before it, so no more than ``cap`` pages of a query can matter: that
    many are picked first (before the shuffle), and only they are summed up.
    """
    near = first_n_per_key(pages, query, [start], cap).drop("_rn")
    before = Window.partitionBy(query).orderBy(start).rowsBetween(Window.unboundedPreceding, -1)
    return (
        near.withColumn("_seen", F.coalesce(F.sum(n_items).over(before), F.lit(0)))
        .withColumn("_least", F.coalesce(F.min(n_items).over(before), F.lit(1)))
        .filter((F.col("_seen") < cap) & (F.col("_least") > 0))
        .drop("_seen", "_least")
    )


def first_wins_union(items: DataFrame, key: str, order: list[Column | str]) -> DataFrame:
    """One row per key over all queries, the first in ``order``; rows without a key are dropped."""
    return keep_first(items.filter(blank_to_null(F.col(key).cast("string")).isNotNull()), key, order)


def candidate_filter(
    items: DataFrame,
    document_type: str,
    organisations: str,
    types: tuple[str, ...] = fixed.ANNOUNCEMENT_DOCUMENT_TYPES,
    slugs: tuple[str, ...] | None = None,
) -> DataFrame:
    """Announcements of the wanted types, and of the wanted organisations if any are named.

    ``organisations`` is an array of structs with ``link``.
    """
    out = items.filter(F.col(document_type).isin(*types))
    if slugs:
        out = out.filter(
            F.exists(organisations, lambda o: F.coalesce(last_segment(o["link"]).isin(*slugs), F.lit(False)))
        )
    return out


def stage_filter(df: DataFrame, stage: str, source: str, stages: list[str] | None = None) -> DataFrame:
    """Releases in the asked stages, else in the default stages of ``source`` (None means all)."""
    wanted = stages or fixed.DEFAULT_STAGES[source]
    return df.filter(F.col(stage).isin(*wanted)) if wanted else df


def between_days(df: DataFrame, ts: str, first: str, last: str) -> DataFrame:
    """Rows from the first instant of ``first`` to the last instant of ``last``."""
    day_after = F.date_add(F.lit(last).cast("date"), 1).cast("timestamp_ntz")
    return df.filter((F.col(ts) >= F.lit(first).cast("timestamp_ntz")) & (F.col(ts) < day_after))


def years(df: DataFrame, year: str, first: int | None, last: int | None) -> DataFrame:
    """Archives of a year range; both ends None means all of them."""
    if first is not None:
        df = df.filter(F.col(year) >= first)
    if last is not None:
        df = df.filter(F.col(year) <= last)
    return df


def run_order(run_id: str) -> Column:
    """Sorts run ids with their numbers as numbers, so that ``run-10`` comes after ``run-9``."""
    parts = F.regexp_extract_all(F.col(run_id), F.lit(r"\d+|\D+"), F.lit(0))
    return F.array_join(F.transform(parts, lambda x: F.when(x.rlike(r"^\d"), F.lpad(x, 20, "0")).otherwise(x)), "")


def write_bronze(pages: DataFrame, root: str, run_id: str) -> None:
    """Store raw pages ``(page, body, source, run_date)`` under source, day and run.

    Writing a run again replaces that run only, so a retried job leaves no doubles.
    """
    (
        pages.withColumn("run_id", F.lit(run_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("source", "run_date", "run_id")
        .parquet(root)
    )


def read_bronze(spark: SparkSession, root: str) -> DataFrame:
    """Raw pages, each once per source and day, as the latest run of that day left it."""
    stored = spark.read.schema(BRONZE_SCHEMA).parquet(root)
    return keep_first(stored, ["source", "run_date", "page"], [run_order("run_id").desc(), F.col("run_id").desc()])

"""From landed result pages to new rows of the other three feeds.

Pages are read from files, unpacked, narrowed to candidates, parsed once, and merged: the first relevant
occurrence of a key in page order wins, keys that other runs have stored are left out. Every load is a run
of its own (see :mod:`noticeworks.plans.store`), so it can be repeated.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from noticeworks import fixed_values as fixed
from noticeworks.operators.merge import merge_insert_only
from noticeworks.plans import feeds
from noticeworks.plans.gold import run_count_columns
from noticeworks.plans.notices import good
from noticeworks.plans.store import delete, merge_run, new_run, write_run
from noticeworks.schemas import KEYS, empty
from noticeworks.session import new_path
from noticeworks.sources.pages import candidate_filter, explode_items, read_pages, run_order

_CANDIDATE = "struct<content_store_document_type string, organisations array<struct<link string>>>"


@dataclass(frozen=True)
class Feed:
    """How the pages of a feed become rows of ``table``; ``flag`` is its relevance column, if it has one."""

    table: str
    parse: Callable[..., DataFrame]
    flag: str | None
    field: str = "results"
    unwrap: str | None = None


ANNOUNCEMENTS = Feed("gov_announcements", feeds.parse_announcements, "ai_relevant")
QUESTIONS = Feed("written_questions", feeds.parse_questions, "ai_relevance_flag", unwrap="value")
RECORDS = Feed("atrs_records", feeds.parse_records, None)


def announcement_candidates(
    items: DataFrame, types: tuple[str, ...] = fixed.ANNOUNCEMENT_DOCUMENT_TYPES, slugs: tuple[str, ...] | None = None
) -> DataFrame:
    """Items (``item``: JSON text) of the wanted document types and organisations."""
    seen = items.withColumn("_c", F.from_json("item", _CANDIDATE))
    seen = seen.select("*", F.col("_c.content_store_document_type").alias("_type"), F.col("_c.organisations").alias("_orgs"))
    return candidate_filter(seen, "_type", "_orgs", types, slugs).select(*items.columns)


def load_pages(
    pages: DataFrame,
    table: str,
    feed: Feed,
    run: str,
    keep_all: bool = False,
    candidates: Callable[[DataFrame], DataFrame] | None = None,
    counts: Observation | None = None,
    quarantine_path: str | None = None,
) -> int:
    """Unpack ``pages`` (``page``, ``body``), store what they add to ``table`` as ``run``, and set the rest aside.

    ``candidates`` narrows the unpacked items (announcements default to :func:`announcement_candidates`). The first
    occurrence in page order wins. ``counts`` and ``quarantine_path`` are those of an archive load. Returns the rows added.
    """
    spark = pages.sparkSession
    if candidates is None and feed is ANNOUNCEMENTS:
        candidates = announcement_candidates
    items = explode_items(pages, feed.field, unwrap=feed.unwrap)
    items = candidates(items) if candidates else items
    parsed = feed.parse(items.withColumn("text", F.col("item")))
    if counts is not None:
        relevant = parsed.withColumn("_relevant", F.col(feed.flag) if feed.flag else F.lit(True))
        parsed = relevant.observe(counts, *run_count_columns("_relevant")).drop("_relevant")
    staged = new_path(spark, "marked")
    parsed.withColumn("text", F.when(F.col("reason").isNotNull(), F.col("text"))).write.parquet(staged)
    parsed = spark.read.schema(parsed.schema).parquet(staged)
    order = [run_order("page"), F.col("page"), F.col("pos")]
    flag = None if keep_all else feed.flag
    nothing = empty(spark, parsed.select(KEYS[feed.table]).schema)
    batch = merge_insert_only(good(parsed), nothing, feed.table, order, flag)
    added = merge_run(batch, table, run, feed.table)
    if quarantine_path:
        bad = parsed.filter("reason IS NOT NULL")
        write_run(bad.select(F.col("page").alias("file"), "text", "reason"), quarantine_path, run)
    delete(spark, staged)
    return added


def load_feed(
    spark: SparkSession,
    path: str,
    table: str,
    feed: Feed,
    run: str | None = None,
    keep_all: bool = False,
    candidates: Callable[[DataFrame], DataFrame] | None = None,
    counts: Observation | None = None,
    quarantine_path: str | None = None,
    page: Column | None = None,
    bundled: bool = False,
) -> int:
    """Load the page files at ``path`` into ``table`` (see :func:`load_pages`); returns the rows added.

    ``page`` names a page by its file, in the order of which the first occurrence wins; by default the file's name.
    ``bundled`` pages stand many to a file, under their own names (:func:`noticeworks.sources.pages.land_pages`).
    """
    pages = read_pages(spark, path, page, bundled)
    return load_pages(pages, table, feed, run or new_run("load"), keep_all, candidates, counts, quarantine_path)

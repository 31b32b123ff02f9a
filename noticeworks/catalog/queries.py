"""Registered queries: each runs library operators over records derived from whole test tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from noticeworks import fixed_values as fixed
from noticeworks.catalog import derive
from noticeworks.catalog.settings import CAP, CORPUS_KEYWORDS, PART_CONFIG, SEARCH, SLUGS
from noticeworks.functions.display import money, money_bn, status_label, supplier_summary
from noticeworks.functions.relevance import any_code_prefix, any_keyword, classify
from noticeworks.functions.text import last_segment, text_key, to_day, to_number, version_label
from noticeworks.operators import merge, orgs
from noticeworks.operators.dedup import keep_first
from noticeworks.operators.median import exact_median
from noticeworks.plans import explore, export, feed_loads, feeds, gold
from noticeworks.plans.load import archive_notices, load_archive, load_years
from noticeworks.plans.notices import good, parse_releases, quarantine
from noticeworks.plans.store import compact, merge_run, read_manifest, read_runs
from noticeworks.schemas import TABLES, append_by_name, conform, create_tables, empty, evolve, read_table
from noticeworks.session import configure, new_path
from noticeworks.sources import archives, html, pages, seeds
from noticeworks.streaming.incremental import merge_batch, start_feed_ingest, start_ingest, stream_id

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
BOTH = (fixed.CONTRACTS_FINDER, fixed.FIND_A_TENDER)


def query(fn: Query) -> Query:
    """Register ``fn`` under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


# --- tables the queries start from ----------------------------------------------------------------


def parsed(spark: SparkSession, sf_dir: str, lenient: bool = False) -> DataFrame:
    return parse_releases(derive.releases(spark, sf_dir), F.col("src"), lenient=lenient).drop("src")


def notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every readable notice, with ``k``, the order it came from."""
    return parsed(spark, sf_dir).filter("reason IS NULL")


def _nothing(spark: SparkSession, name: str) -> DataFrame:
    return empty(spark, TABLES[name])


def silver_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_notices(notices(spark, sf_dir), _nothing(spark, "procurement_notices"), ["k"])


def dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.procurement_dedup(silver_notices(spark, sf_dir))


def announcements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.parse_announcements(derive.announcement_items(spark, sf_dir)).filter("reason IS NULL")


def silver_announcements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_announcements(announcements(spark, sf_dir), _nothing(spark, "gov_announcements"), ["d"])


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = derive.question_items(spark, sf_dir)
    items = items.withColumn("item", pages.unwrap_item("item", "value"))
    return feeds.parse_questions(items).filter("reason IS NULL")


def silver_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_questions(questions(spark, sf_dir), _nothing(spark, "written_questions"), ["qid"])


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.parse_records(derive.record_items(spark, sf_dir)).filter("reason IS NULL").drop("body")


def silver_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "procurement_notices": silver_notices(spark, sf_dir),
        "atrs_records": conform(records(spark, sf_dir), TABLES["atrs_records"]),
        "gov_announcements": silver_announcements(spark, sf_dir),
        "written_questions": silver_questions(spark, sf_dir),
        "ai_growth_zones": clean_zones(spark, sf_dir),
        "org_aliases": derive.aliases(spark, sf_dir),
    }


def clean_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.zones(spark, sf_dir).withColumn("compute_capacity", F.nullif("compute_capacity", F.lit("N/A")))


# --- sources and sinks ----------------------------------------------------------------------------


@query
def q_jsonl_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    junk = F.expr("CASE _ord % 50 WHEN 0 THEN '   ' WHEN 1 THEN '{not json}' WHEN 2 THEN '[1,2]' END")
    lines = derive.archive_lines(spark, sf_dir, in_order=True).select(
        "_ord", "src", F.explode(F.array_compact(F.array("line", junk))).alias("line")
    )
    root = new_path(spark, "archives")
    finder = F.col("src") == fixed.CONTRACTS_FINDER
    lines.filter(finder).select("line").write.text(f"{root}/plain")
    lines.filter(~finder).select("line").write.option("compression", "gzip").text(f"{root}/gz")
    read = archives.read_lines(spark, f"{root}/plain").unionAll(
        archives.read_lines(spark, f"{root}/gz", spread=spark.sparkContext.defaultParallelism)
    )
    ok, bad = archives.split_lines(read)
    found = archives.normalise_packages(ok)
    rid = F.coalesce(F.nullif(F.get_json_object("release", "$.id"), F.lit("")), F.col("compiled_id"))
    return found.select(
        F.lit("release").alias("kind"),
        F.get_json_object("release", "$.ocid").alias("a"),
        F.coalesce(rid, F.get_json_object("release", "$.id")).alias("b"),
    ).unionAll(bad.select("reason", "line", F.lit(None).cast("string")))


@query
def q_normalise_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = archives.normalise_packages(derive.extra_lines(spark, sf_dir))
    rid = F.get_json_object("release", "$.id")
    return found.select(
        "k",
        "pos",
        F.get_json_object("release", "$.ocid").alias("ocid"),
        F.coalesce(F.nullif(rid, F.lit("")), F.col("compiled_id"), rid).alias("id"),
    )


@query
def q_page_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of at most 200 items: ten conversations, twenty turns."""
    landed = (
        derive.question_items(spark, sf_dir)
        .groupBy(F.expr("conv_id div 10").alias("grp"), F.expr("turn div 20").alias("page"))
        .agg(F.array_sort(F.collect_list(F.struct("qid", "item"))).alias("items"))
        .select("grp", "page", _page_body("items").alias("body"))
    )
    items = pages.explode_items(landed, unwrap="value")
    return items.select("grp", "page", "pos", F.get_json_object("item", "$.id").alias("id"))


def _page_body(items: str) -> F.Column:
    return F.concat(
        F.lit('{"total":1000,"results":['),
        F.array_join(F.transform(items, lambda i: i["item"]), ","),
        F.lit("]}"),
    )


@query
def q_query_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of at most 50 items: one source, fifty document ids."""
    landed = (
        derive.announcement_items(spark, sf_dir)
        .groupBy(F.col("source").alias("query"), F.expr("d div 50").alias("start"))
        .agg(F.collect_list(F.struct("item")).alias("items"))
        .select(
            "query",
            "start",
            F.when(F.expr("query LIKE '%3' AND start = 7"), '{"results":[]}').otherwise(_page_body("items")).alias("body"),
        )
    )
    counted = landed.select("query", "start", pages.count_items("body").alias("n_items"))
    return pages.cap_per_query(counted, "query", "start", "n_items", CAP)


@query
def q_first_wins_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document is found by two of three queries."""
    items = derive.announcement_items(spark, sf_dir).select(
        F.get_json_object("item", "$.link").alias("link"),
        "d",
        F.explode(F.expr("array(d % 3, (d + 1) % 3)")).alias("query_idx"),
        F.expr("d div 50").alias("start"),
        F.expr("d % 50").alias("pos"),
    )
    return pages.first_wins_union(items, "link", ["query_idx", "start", "pos"]).select("link", "query_idx", "d")


@query
def q_candidate_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = derive.announcement_items(spark, sf_dir).withColumn("r", F.from_json("item", feeds.ANNOUNCEMENT_SCHEMA))
    items = items.select(
        "d",
        F.col("r.link").alias("announcement_id"),
        F.col("r.content_store_document_type").alias("document_type"),
        F.col("r.organisations").alias("organisations"),
    )
    return pages.candidate_filter(items, "document_type", "organisations", slugs=SLUGS).drop("organisations")


@query
def q_seed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "zones-csv")
    derive.zones(spark, sf_dir).write.option("escape", '"').csv(path, header=True, nullValue="")
    return seeds.read_seed_csv(spark, path, TABLES["ai_growth_zones"]).drop("_ord")


@query
def q_parquet_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "parts")
    n = notices(spark, sf_dir)
    n.filter("k % 2 = 0").select("k", "notice_id", "title", "currency").write.parquet(f"{path}/even.parquet")
    n.filter("k % 2 = 1").select("title", "k", "notice_id").write.parquet(f"{path}/odd.parquet")
    schema = StructType.fromDDL("k bigint, notice_id string, title string, currency string, published_date date")
    absent = read_table(spark, f"{path}-absent", schema)
    return read_table(spark, path, schema, recursiveFileLookup="true").unionAll(absent)


@query
def q_bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run lands every page, a second run of the same days a fifth of them again; then the
    second run is repeated, as after a failure."""
    root = new_path(spark, "bronze")
    landed = derive.table(spark, sf_dir, "pages").selectExpr(
        "CAST(page_id AS STRING) AS page",
        "html AS body",
        "concat('web', page_id % 3) AS source",
        "DATE '2025-01-01' + CAST(page_id % 2 AS INT) AS run_date",
    )
    pages.write_bronze(landed, root, "run-1")
    again = landed.filter("CAST(page AS BIGINT) % 5 = 0").withColumn("body", F.concat(F.lit("again "), "body"))
    pages.write_bronze(again, root, "run-2")
    pages.write_bronze(again, root, "run-2")
    return pages.read_bronze(spark, root).select("page", "source", "run_date", F.md5("body").alias("body_md5"))


@query
def q_export_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "by-year")
    export.write_by_year(dedup(spark, sf_dir), path)
    return export.read_by_year(spark, path, TABLES["procurement_notices"]).select("notice_id", "year")


@query
def q_export_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs of notices, by year of publication, into a stored table, parts put together in between; an export after
    each rewrites the years that the run touches."""
    root = new_path(spark, "refreshed")
    silver_notices(spark, sf_dir).write.parquet(f"{root}/batch")
    batch = spark.read.parquet(f"{root}/batch")
    day = F.coalesce(F.year("published_date"), F.lit(0))
    for k, wave in enumerate((day.between(1, 1996), day == 1997, (day < 1) | (day > 1997))):
        merge_run(batch.filter(wave), f"{root}/table", f"run-{k}")
        if k == 1:
            compact(spark, f"{root}/table")
        export.export_new(spark, f"{root}/table", f"{root}/by-year")
    return export.read_by_year(spark, f"{root}/by-year", TABLES["procurement_notices"]).select("notice_id", "title", "year")


@query
def q_dedup_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The richest notices of a stored table: winners from narrow rows, texts looked up."""
    path = new_path(spark, "stored")
    merge_run(silver_notices(spark, sf_dir), path, "all")
    kept = gold.stored_dedup(read_runs(spark, path))
    return kept.select("notice_id", "source", "title", F.col("awards").isNotNull().alias("has_awards"))


@query
def q_export_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = export.export_gold(spark, silver_tables(spark, sf_dir), new_path(spark, "gold"))
    return spark.createDataFrame(list(counts.items()), "relation string, n bigint")


@query
def q_schema_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered tables made, made again (nothing happens), one filled, and read back."""
    root = new_path(spark, "registry")
    create_tables(spark, root)
    path = f"{root}/procurement_notices"
    conform(notices(spark, sf_dir), TABLES["procurement_notices"]).write.mode("append").parquet(path)
    if create_tables(spark, root):
        raise RuntimeError("a table was made twice")
    found = []
    for name, schema in TABLES.items():
        table = read_table(spark, f"{root}/{name}", schema)
        counts = table.agg(*[F.count(c).alias(c) for c in table.columns])
        found.append(counts.unpivot([], table.columns, "column_name", "n").select(F.lit(name).alias("table_name"), "column_name", "n"))
    return functools.reduce(DataFrame.unionAll, found)


@query
def q_migrate(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = notices(spark, sf_dir).select("notice_id", "title")
    schema = TABLES["procurement_notices"]
    new = evolve(evolve(old, schema), schema)
    n_null = sum((F.col(c).isNull().cast("int") for c in new.columns), F.lit(0))
    return new.select("notice_id", "title", F.lit(len(new.columns)).alias("n_columns"), n_null.alias("n_null"))


@query
def q_append_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = notices(spark, sf_dir)
    table = n.filter("k % 2 = 0").select("notice_id", "title", "published_date", "currency")
    rows = n.filter("k % 2 = 1").select(F.col("published_date").cast("string"), "notice_id", "title", "stage")
    return append_by_name(table, rows)


# --- releases -------------------------------------------------------------------------------------


def _of_notices(name: str, *columns: str | F.Column) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return notices(spark, sf_dir).select("k", *columns)

    run.__name__ = name
    query(run)


@query
def q_parse_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = notices(spark, sf_dir)
    return n.withColumn("has_awards", F.col("awards").isNotNull()).drop("awards", "ingested_at", "reason", "issue")


@query
def q_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine(parsed(spark, sf_dir)).select("k", "reason")


@query
def q_parse_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = parsed(spark, sf_dir, lenient=True)
    return p.select("k", "tender_status", "buyer_name", F.coalesce("reason", F.lit("read")).alias("reason"))


@query
def q_cpv_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = F.array_join(F.from_json("cpv_codes", "array<string>"), " ")
    return notices(spark, sf_dir).select("k", codes.alias("codes"))


_of_notices("q_headline_value", "value_amount", "currency")
_of_notices("q_headline_supplier", "supplier_name", "supplier_id")
_of_notices("q_documents", "documents")
_of_notices("q_contract_status", "contract_status")
_of_notices("q_notice_url", "source_url", "link_status")
_of_notices("q_framework_id", "framework_id")
_of_notices("q_contract_dates", "published_date", "contract_start", "contract_end", "issue")


@query
def q_supplier_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notices(spark, sf_dir).select("k", supplier_summary("awards", "supplier_name").alias("suppliers"))


@query
def q_status_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notices(spark, sf_dir).select("k", status_label("contract_status").alias("label"))


@query
def q_utf8_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles with half a surrogate pair in them."""
    text = F.concat(F.lit('{"ocid":"o","id":"i","tender":{"title":"'), "titlevar", F.lit(r"\ud83d"), "seg", F.lit('"}}'))
    raw = derive.orders(spark, sf_dir).select("k", text.alias("release"))
    return parse_releases(raw, fixed.FIND_A_TENDER).select("k", "title")


# --- the other feeds ------------------------------------------------------------------------------


@query
def q_organisations(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = derive.announcement_items(spark, sf_dir)
    return feeds.parse_announcements(items).select("d", "organisations")


@query
def q_parse_announcement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return announcements(spark, sf_dir).select(
        "d",
        "announcement_id",
        "title",
        "document_type",
        "organisations",
        F.col("public_timestamp").cast("timestamp_ntz").alias("public_timestamp"),
        "summary",
        "ai_relevant",
        "ai_confidence",
        "source_url",
    )


@query
def q_parse_question(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions(spark, sf_dir).select(
        "question_id",
        "house",
        "date_tabled",
        "date_answered",
        "member_name",
        "department",
        "question_text",
        "ai_relevance_flag",
        "source_url",
    )


@query
def q_parse_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).drop("d", "ingested_at", "reason", "issue")


@query
def q_html_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    bodies = derive.record_items(spark, sf_dir).select(F.lit("doc").alias("kind"), F.col("d").alias("key"), "body")
    plain = derive.table(spark, sf_dir, "pages").select(F.lit("page"), "page_id", "html")
    found = bodies.unionAll(plain).select("kind", "key", F.explode_outer(html.html_sections("body")).alias("s"))
    hrefs = F.nullif(F.array_join("s.hrefs", " "), F.lit(""))
    return found.select("kind", "key", "s.id", "s.text", hrefs.alias("hrefs"))


@query
def q_section_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select("d", "model_architecture", "sensitive_attributes")


@query
def q_section_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select("d", "dpi_assessment_url")


# --- scalar functions -----------------------------------------------------------------------------


@query
def q_text_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.table(spark, sf_dir, "documents").select(
        "doc_id",
        text_key("text").alias("full_key"),
        text_key("text", 50).alias("short_key"),
        text_key("source", 2).alias("source_key"),
    )


@query
def q_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.expr("concat(url, CASE page_id % 3 WHEN 0 THEN '/' WHEN 1 THEN '//' ELSE '' END)")
    return derive.table(spark, sf_dir, "pages").select("page_id", last_segment(path).alias("slug"))


@query
def q_version_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select("d", version_label("standard_version").alias("version"))


@query
def q_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of dates and numbers, some of them wrong."""
    raw = derive.table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "CASE WHEN event_id % 3 <> 0 THEN CAST(CAST(ts AS DATE) AS STRING) WHEN event_id % 2 = 0 THEN '2024-13-45' ELSE 'soon' END AS day",
        "CASE WHEN event_id % 4 <> 0 THEN CAST(value AS STRING) ELSE 'n/a' END AS amount",
        "CASE WHEN event_id % 5 <> 0 THEN event_type END AS confidence",
    )
    return raw.select(
        "event_id",
        to_day("day").alias("day"),
        to_number("amount").alias("amount"),
        F.coalesce("confidence", F.lit("none")).alias("confidence"),
    )


@query
def q_money_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        money("o_totalprice").alias("value"),
        money_bn(F.col("o_totalprice") * 12345).alias("bn"),
        money(F.expr("CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END")).alias("maybe"),
    )


# --- relevance ------------------------------------------------------------------------------------


@query
def q_keyword_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.lower("text")
    return derive.table(spark, sf_dir, "documents").select(
        "doc_id",
        any_keyword(text, fixed.STRONG_KEYWORDS).alias("strong"),
        any_keyword(text, CORPUS_KEYWORDS).alias("corpus"),
    )


@query
def q_cpv_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = F.expr("CASE WHEN p_partkey % 13 <> 0 THEN array(concat('72', lpad(p_size, 2, '0')), p_brand) END")
    return derive.table(spark, sf_dir, "part").select(
        "p_partkey", any_code_prefix(codes, ("722", "Brand#1")).alias("hit")
    )


@query
def q_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = F.array(F.expr("lpad(p_size, 2, '0')"))
    return derive.table(spark, sf_dir, "part").select(
        "p_partkey", classify("p_name", "p_type", codes, PART_CONFIG).alias("tier")
    )


# --- filters --------------------------------------------------------------------------------------


@query
def q_text_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.text_search(
        records(spark, sf_dir).select("d", "one_sentence_desc", "organisation_name"),
        ["one_sentence_desc", "organisation_name"],
        SEARCH,
    ).select("d")


@query
def q_filter_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = notices(spark, sf_dir).select("k", status_label("contract_status").alias("label"))
    return explore.filter_in(explore.filter_in(labelled, "label", []), "label", ["Awarded", "Planned"])


@query
def q_confidence_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "confidence")
    notices(spark, sf_dir).select("k", "ai_confidence").write.parquet(path)  # both modes read what one parse gave
    n = spark.read.parquet(path)
    return (
        explore.confident(n).select(F.lit("strong").alias("mode"), "k")
        .unionAll(explore.confident(n, strong_only=False).select(F.lit("both"), "k"))
    )


@query
def q_stage_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "stages")
    notices(spark, sf_dir).select("k", "stage", "source").write.parquet(path)  # all three read what one parse gave
    n = spark.read.parquet(path)
    finder = n.filter(F.col("source") == fixed.CONTRACTS_FINDER)
    other = n.filter(F.col("source") == fixed.FIND_A_TENDER)
    return (
        pages.stage_filter(finder, "stage", fixed.CONTRACTS_FINDER).select(F.lit("default").alias("asked"), "k")
        .unionAll(pages.stage_filter(other, "stage", fixed.FIND_A_TENDER).select(F.lit("all"), "k"))
        .unionAll(pages.stage_filter(finder, "stage", fixed.CONTRACTS_FINDER, ["tender"]).select(F.lit("tender"), "k"))
    )


@query
def q_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = derive.table(spark, sf_dir, "events")
    return pages.between_days(events, "ts", "2024-01-05", "2024-01-07").select("event_id", "event_type")


@query
def q_year_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = derive.table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    return (
        pages.years(o, "year", 1996, 1998).select(F.lit("some").alias("asked"), "o_orderkey")
        .unionAll(pages.years(o, "year", None, None).select(F.lit("all"), "o_orderkey"))
    )


# --- organisations --------------------------------------------------------------------------------


@query
def q_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = notices(spark, sf_dir).select("k", "buyer_name")
    return orgs.resolve(n, "buyer_name", derive.aliases(spark, sf_dir)).select("k", "canonical_name")


@query
def q_alias_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = notices(spark, sf_dir).select("k", "buyer_name")
    return orgs.alias_join(n, "buyer_name", derive.aliases(spark, sf_dir)).select("k", "canonical_name")


@query
def q_unmatched_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orgs.unmatched_names(notices(spark, sf_dir), "buyer_name", derive.aliases(spark, sf_dir))


# --- views ----------------------------------------------------------------------------------------


@query
def q_dedup_richest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(spark, sf_dir).select(
        "notice_id",
        "source",
        "title",
        "buyer_name",
        "value_amount",
        F.col("awards").isNotNull().alias("has_awards"),
        "published_date",
    )


def _gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.reporting_gap(dedup(spark, sf_dir), records(spark, sf_dir), derive.aliases(spark, sf_dir))


@query
def q_reporting_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gap(spark, sf_dir)


@query
def q_gap_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.gap_top(_gap(spark, sf_dir))


@query
def q_gap_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.gap_long(_gap(spark, sf_dir))


def _spend(spark: SparkSession, sf_dir: str, policy: orgs.AliasPolicy) -> DataFrame:
    spend = gold.spend_by_month(dedup(spark, sf_dir), derive.aliases(spark, sf_dir), policy)
    return spend.withColumn("total_value", F.round("total_value", 2))


@query
def q_spend_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spend(spark, sf_dir, "distinct")


@query
def q_spend_by_month_as_is(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spend(spark, sf_dir, "as_is")


@query
def q_wpq_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.question_trends(questions(spark, sf_dir))


@query
def q_announcement_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.announcement_trends(silver_announcements(spark, sf_dir))


@query
def q_capacity_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.capacity_overview(clean_zones(spark, sf_dir))


@query
def q_run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.run_counts(parsed(spark, sf_dir))


# --- report operators -----------------------------------------------------------------------------


@query
def q_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures over the exported notices: de-duplication runs once, the figures read two columns."""
    path = new_path(spark, "kpis")
    export.write_by_year(dedup(spark, sf_dir), path)
    exported = export.read_by_year(spark, path, TABLES["procurement_notices"])
    return explore.kpis(explore.confident(exported)).withColumns(
        {c: F.round(c, 2) for c in ("spend", "awarded_value")}
    )


@query
def q_exact_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians over whole tables by bucket refinement, never by holding the values in one task."""
    found = [
        (what, exact_median(derive.table(spark, sf_dir, name), column, buckets=64, direct=1000))
        for what, name, column in (
            ("price", "orders", "o_totalprice"),
            ("quantity", "lineitem", "l_quantity"),
        )
    ]
    return spark.createDataFrame(found, "what string, median_value double")


@query
def q_zone_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.zone_kpis(clean_zones(spark, sf_dir)).withColumn("pledged", F.round("pledged", 0))


@query
def q_source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.source_counts(dedup(spark, sf_dir))


@query
def q_monthly_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.monthly_by_source(dedup(spark, sf_dir)).withColumn("value", F.round("value", 2))


@query
def q_monthly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_type = explore.monthly_counts(silver_announcements(spark, sf_dir), "public_timestamp", "document_type")
    tabled = explore.monthly_counts(silver_questions(spark, sf_dir), "date_tabled")
    return by_type.select("month", F.col("document_type").alias("grp"), "count").unionAll(
        tabled.select("month", F.lit("question"), "count")
    )


@query
def q_phase_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.group_sizes(records(spark, sf_dir), "phase")


@query
def q_top_departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.top_groups(silver_questions(spark, sf_dir).dropna(subset=["date_tabled"]), "department")


@query
def q_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    phases = explore.facet(records(spark, sf_dir), "phase")
    statuses = explore.present_status_labels(notices(spark, sf_dir))
    return phases.select(
        F.lit("phase").alias("facet"), F.col("phase").alias("value"), F.lit(None).cast("int").alias("position")
    ).unionAll(statuses.select(F.lit("status"), "status_label", "position"))


@query
def q_top_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.top_contracts(dedup(spark, sf_dir))


@query
def q_record_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.record_listing(explore.filter_in(records(spark, sf_dir), "phase", ["pilot", "production"]))


@query
def q_announcement_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.announcement_listing(silver_announcements(spark, sf_dir))


@query
def q_latest_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.question_listing(silver_questions(spark, sf_dir))


@query
def q_zone_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.zone_listing(clean_zones(spark, sf_dir))


@query
def q_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.preview(records(spark, sf_dir), ["d"], ["record_id", "one_sentence_desc", "date_published"])


# --- merges ---------------------------------------------------------------------------------------


@query
def q_merge_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = notices(spark, sf_dir)
    existing = conform(batch.filter("k % 20 = 1"), TABLES["procurement_notices"])
    return merge.merge_notices(batch, existing, ["k"]).select(
        "notice_id", "source", "title", "ai_confidence", "enrichment_version"
    )


@query
def q_merge_notices_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = merge.merge_notices(notices(spark, sf_dir), _nothing(spark, "procurement_notices"), ["k"], keep_all=True)
    return new.select("notice_id", "title", "ai_relevant")


@query
def q_merge_announcements(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = announcements(spark, sf_dir)
    new = merge.merge_announcements(batch, batch.filter("d % 7 = 0"), ["d"])
    return new.select("announcement_id", "title", "ai_confidence")


@query
def q_merge_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = questions(spark, sf_dir)
    new = merge.merge_questions(batch, batch.filter("turn % 3 = 0"), ["qid"])
    return new.select("question_id", "department", "member_name")


@query
def q_merge_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = records(spark, sf_dir)
    new = merge.merge_records(batch, batch.filter("d % 3 = 0"))
    return new.select("record_id", "organisation_name", "date_published")


@query
def q_seed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derive.aliases(spark, sf_dir)
    old = derive.table(spark, sf_dir, "nation").filter("n_nationkey % 4 = 0").select(F.col("n_name").alias("raw_name"))
    new_aliases = merge.merge_seed(rows.unionAll(rows), old, "org_aliases", ["canonical_name"])
    z = clean_zones(spark, sf_dir)
    new_zones = merge.merge_seed(z, z.filter("status = 'announced'"), "ai_growth_zones", ["zone_id"])
    return new_aliases.select(
        F.lit("alias").alias("kind"), F.col("raw_name").alias("key"), F.col("canonical_name").alias("value")
    ).unionAll(new_zones.select(F.lit("zone"), "zone_id", F.col("announced_date").cast("string")))


@query
def q_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
    lines = derive.table(spark, sf_dir, "lineitem").select("l_orderkey", *order)
    return keep_first(lines, "l_orderkey", order).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query
def q_load_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive files of both sources loaded twice into one table: the second time adds nothing."""
    root = new_path(spark, "load")
    lines = derive.archive_lines(spark, sf_dir, in_order=True)
    for source in BOTH:
        lines.filter(F.col("src") == source).select("line").write.text(f"{root}/{source}")
    for source in BOTH * 2:
        load_archive(spark, f"{root}/{source}", f"{root}/table", source)
    return read_runs(spark, f"{root}/table").select(
        "notice_id", "title", "ai_confidence", "published_date"
    )


@query
def q_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two waves of files of each source, the second holding the first again; a stream run after each."""
    root = new_path(spark, "stream")
    lines = derive.archive_lines(spark, sf_dir, in_order=True)
    for source in BOTH:
        own = lines.filter(F.col("src") == source)
        for wave in (own.filter("_ord % 3 = 0"), own):
            wave.select("line").write.mode("append").text(f"{root}/{source}")
            start_ingest(
                spark, f"{root}/{source}", f"{root}/table", f"{root}/checkpoint-{source}", source
            ).awaitTermination()
    return read_runs(spark, f"{root}/table").select("notice_id", "title", "ai_confidence")


@query
def q_load_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives landed by source and year, two of the years loaded: of one source two stages, of the other its default stages."""
    root = new_path(spark, "years")
    year = derive.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("_ord"), F.year("o_orderdate").alias("year"))
    lines = derive.archive_lines(spark, sf_dir).join(year, "_ord").withColumnRenamed("src", "source")
    archives.land_lines(lines.repartitionByRange("_ord").sortWithinPartitions("source", "year", "_ord"), f"{root}/landed")
    for source in BOTH:
        stages = ["award", "tender"] if source == fixed.CONTRACTS_FINDER else None
        load_years(spark, f"{root}/landed", f"{root}/table", source, 1994, 1995, stages)
    return read_runs(spark, f"{root}/table").select("notice_id", "title", "stage", "ai_confidence")


@query
def q_one_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads and streams of both sources into one table, with parts put together in between, a fresh checkpoint, a repeated
    load and a repeated stream batch: every notice once."""
    root = new_path(spark, "one")
    table = f"{root}/table"
    lines = derive.archive_lines(spark, sf_dir, in_order=True)
    for source in BOTH:
        own = lines.filter(F.col("src") == source)
        own.filter("_ord % 3 = 0").select("line").write.text(f"{root}/archive-{source}")
        own.select("line").write.text(f"{root}/landing-{source}")
        load_archive(spark, f"{root}/archive-{source}", table, source, run=f"first-{source}")
        for checkpoint in ("a", "b"):
            start_ingest(
                spark, f"{root}/landing-{source}", table, f"{root}/{checkpoint}-{source}", source, compact_after=3
            ).awaitTermination()
        load_archive(spark, f"{root}/archive-{source}", table, source, run=f"first-{source}")
        again = archives.read_lines(spark, f"{root}/landing-{source}")
        merge_batch(again, 0, table, source, stream=stream_id(spark, f"{root}/a-{source}"))
    return read_runs(spark, table).select("notice_id", "ai_confidence")


@query
def q_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten runs of overlapping tenths of all notices, every notice stored by the first that has it; then one part."""
    path = new_path(spark, "compacted")
    staged = f"{path}-batch"
    share = F.pmod(F.crc32(F.col("notice_id").cast("binary")), F.lit(10))
    silver_notices(spark, sf_dir).withColumn("share", share).write.partitionBy("share").parquet(staged)
    batch = spark.read.parquet(staged)  # of which a run reads its own two tenths
    for k in range(10):
        merge_run(batch.filter(F.col("share").isin(k, (k + 1) % 10)).drop("share"), path, f"run-{k}")
    compact(spark, path)
    parts = len(read_manifest(spark, path).parts)
    return read_runs(spark, path).select("notice_id", "title", F.lit(parts).alias("n_parts"))


@query
def q_stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a streamed run read, set aside by reason, and added; every 50th line is cut off in the middle."""
    root = new_path(spark, "counted")
    lines = derive.archive_lines(spark, sf_dir, in_order=True)
    cut = F.when(F.col("_ord") % 50 == 7, F.concat(F.lit("{"), F.col("line"))).otherwise(F.col("line"))
    lines.withColumn("line", cut).select("line").write.text(f"{root}/landing")
    counts: list[dict] = []
    start_ingest(
        spark, f"{root}/landing", f"{root}/table", f"{root}/checkpoint", fixed.CONTRACTS_FINDER,
        quarantine_path=f"{root}/bad", on_counts=lambda _, c: counts.append(c),
    ).awaitTermination()
    total = [(k, sum(c[k] for c in counts)) for k in ("n_rows", "n_parsed", "n_errors")]
    bad = spark.read.schema("reason string").parquet(f"{root}/bad").groupBy("reason").agg(F.count("*").alias("n"))
    return spark.createDataFrame(total, "what string, n long").union(bad.select(F.col("reason"), "n"))


def _land(items: DataFrame, number: str, root: str) -> None:
    """Write ``item``s as result pages of 50, many to a file."""
    page = F.concat(F.lit("page-"), F.coalesce(F.floor(F.col(number) / 50).cast("string"), F.lit(""))).alias("page")
    pages_ = items.select(page, F.struct(F.col(number).alias("n"), "item").alias("i")).groupBy("page")
    inside = F.array_join(F.transform(F.sort_array(F.collect_list("i")), lambda i: i["item"]), ",")
    body = F.concat(F.lit('{"total": 1, "results": ['), inside, F.lit("]}"))
    pages.land_pages(pages_.agg(body.alias("body")), root)


def _loaded(spark: SparkSession, feed: feed_loads.Feed, items: DataFrame, number: str) -> DataFrame:
    """Page files of ``items`` loaded, and loaded again as another run, which adds nothing."""
    root = new_path(spark, feed.table)
    _land(items, number, f"{root}/pages")
    for run in ("one", "two"):
        feed_loads.load_feed(spark, f"{root}/pages", f"{root}/table", feed, run, bundled=True)
    return read_runs(spark, f"{root}/table", feed.table)


@query
def q_load_announcements(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = derive.announcement_items(spark, sf_dir)
    return _loaded(spark, feed_loads.ANNOUNCEMENTS, items, "d").select("announcement_id", "title", "ai_confidence", "run")


@query
def q_load_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = derive.question_items(spark, sf_dir)
    return _loaded(spark, feed_loads.QUESTIONS, items.withColumn("n", F.col("conv_id") * 50 + F.col("turn") % 50), "n").select(
        "question_id", "department", "date_tabled"
    )


@query
def q_load_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = derive.record_items(spark, sf_dir)
    return _loaded(spark, feed_loads.RECORDS, items, "d").select("record_id", "organisation_name", "sensitive_attributes")


def _streamed(spark: SparkSession, feed: feed_loads.Feed, items: DataFrame, number: str) -> DataFrame:
    """Page files landed in two waves, the second with the first's items again and in new files, a stream run after each; then
    a fresh checkpoint, which adds nothing."""
    root = new_path(spark, f"stream-{feed.table}")
    for wave, rows in (("wave=1", items.filter(F.col(number) % 3 == 0)), ("wave=2", items)):
        _land(rows, number, f"{root}/pages/{wave}")
        start_feed_ingest(spark, f"{root}/pages", f"{root}/table", f"{root}/cp", feed, bundled=True).awaitTermination()
    start_feed_ingest(spark, f"{root}/pages", f"{root}/table", f"{root}/fresh", feed, bundled=True).awaitTermination()
    return read_runs(spark, f"{root}/table", feed.table)


@query
def q_stream_announcements(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = derive.announcement_items(spark, sf_dir)
    return _streamed(spark, feed_loads.ANNOUNCEMENTS, items, "d").select("announcement_id", "ai_confidence")


@query
def q_stream_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = derive.question_items(spark, sf_dir)
    return _streamed(spark, feed_loads.QUESTIONS, items.withColumn("n", F.col("conv_id") * 50 + F.col("turn") % 50), "n").select(
        "question_id", "department", "date_tabled"
    )


@query
def q_stream_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = derive.record_items(spark, sf_dir)
    return _streamed(spark, feed_loads.RECORDS, items, "d").select("record_id", "organisation_name", "sensitive_attributes")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which organisations buy but do not register? From archive lines to the reporting gap."""
    configure(spark)
    lines = derive.archive_lines(spark, sf_dir)
    new = merge.merge_notices(
        good(archive_notices(lines, F.col("src"))), _nothing(spark, "procurement_notices"), ["_ord", "pos"]
    )
    return gold.reporting_gap(
        gold.procurement_dedup(new), records(spark, sf_dir), derive.aliases(spark, sf_dir)
    )


@query
def q_flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagship(spark, sf_dir)

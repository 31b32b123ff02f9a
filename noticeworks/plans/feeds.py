"""Announcements, parliamentary questions and transparency records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeworks import fixed_values as fixed
from noticeworks.functions.ocds import json_or_null
from noticeworks.functions.relevance import DEFAULT_CONFIG, RelevanceConfig, classify, is_relevant
from noticeworks.functions.text import (
    blank_to_null,
    col,
    first_non_blank,
    iso_day,
    last_segment,
    strip,
    to_day,
    to_instant,
)
from noticeworks.sources.html import html_sections, section_link, section_text

ANNOUNCEMENT_SCHEMA = """struct<link string, title string, description string,
    content_store_document_type string, public_timestamp string,
    organisations array<struct<link string, acronym string, title string>>>"""

QUESTION_SCHEMA = """struct<id string, uin string, house string, dateTabled string,
    dateAnswered string, askingMember struct<name string, nameDisplayAs string, listAs string>,
    answeringBodyName string, heading string, questionText string, answerText string>"""

RECORD_SCHEMA = """struct<base_path string, title string, description string,
    details struct<body string, metadata struct<
        algorithmic_transparency_record_atrs_version string,
        algorithmic_transparency_record_date_published string,
        algorithmic_transparency_record_phase string>>>"""


def _parsed(items: DataFrame, item: str, schema: str) -> tuple[DataFrame, list[str]]:
    """Parse once, behind a generator (see ``notices.with_release``)."""
    carried = [c for c in items.columns if c != item]
    return (
        items.select(
            *carried,
            F.col(item).alias("_text"),
            F.explode(F.array(F.from_json(F.col(item), schema))).alias("r"),
        ),
        carried,
    )


def organisations(orgs: Column | str) -> Column:
    """``array<struct(slug, acronym, title)>``; the slug is the last part of the link."""
    return F.transform(
        col(orgs),
        lambda o: F.struct(
            last_segment(F.coalesce(o["link"], F.lit(""))).alias("slug"),
            o["acronym"].alias("acronym"),
            o["title"].alias("title"),
        ),
    )


def parse_announcements(items: DataFrame, item: str = "item", config: RelevanceConfig = DEFAULT_CONFIG) -> DataFrame:
    """Announcements from search results; ``reason`` marks results without a link."""
    df, carried = _parsed(items, item, ANNOUNCEMENT_SCHEMA)
    tier = classify("r.title", "r.description", None, config)
    return df.select(
        *carried,
        F.col("r.link").alias("announcement_id"),
        F.col("r.title").alias("title"),
        F.col("r.content_store_document_type").alias("document_type"),
        json_or_null(organisations("r.organisations")).alias("organisations"),
        to_instant("r.public_timestamp").alias("public_timestamp"),
        F.lit(None).cast("timestamp").alias("updated_timestamp"),
        F.col("r.description").alias("summary"),
        F.lit(None).cast("string").alias("body_excerpt"),
        tier.alias("ai_confidence"),
        F.lit(config.version).alias("ai_relevance_version"),
        F.lit(None).cast("string").alias("topic_tags"),
        F.lit(None).cast("string").alias("enrichment_version"),
        F.concat(F.lit(fixed.GOV_UK), "r.link").alias("source_url"),
        F.current_timestamp().alias("ingested_at"),
        F.when(blank_to_null("r.link").isNull(), "no link").alias("reason"),
        F.when(
            F.col("r.public_timestamp").isNotNull() & to_instant("r.public_timestamp").isNull(),
            "date text is no date",
        ).alias("issue"),
    ).withColumn("ai_relevant", is_relevant("ai_confidence"))


def member_name(member: Column) -> Column:
    return first_non_blank(member["name"], member["nameDisplayAs"], member["listAs"])


def parse_questions(items: DataFrame, item: str = "item", config: RelevanceConfig = DEFAULT_CONFIG) -> DataFrame:
    """Written questions; ``reason`` marks those without an id. The answer is not classified."""
    df, carried = _parsed(items, item, QUESTION_SCHEMA)
    tabled, answered = iso_day("r.dateTabled"), iso_day("r.dateAnswered")
    tier = classify("r.heading", "r.questionText", None, config)
    return df.select(
        *carried,
        F.col("r.id").alias("question_id"),
        F.col("r.house").alias("house"),
        to_day(tabled).alias("date_tabled"),
        to_day(answered).alias("date_answered"),
        member_name(F.col("r.askingMember")).alias("member_name"),
        F.col("r.answeringBodyName").alias("department"),
        F.col("r.questionText").alias("question_text"),
        F.col("r.answerText").alias("answer_text"),
        is_relevant(tier).alias("ai_relevance_flag"),
        F.lit(None).cast("string").alias("topic_tags"),
        F.lit(None).cast("string").alias("enrichment_version"),
        F.concat_ws("/", F.lit(fixed.QUESTION_DETAIL_URL), tabled, F.col("r.uin")).alias("_url"),
        (tabled.isNotNull() & blank_to_null("r.uin").isNotNull()).alias("_has_url"),
        F.current_timestamp().alias("ingested_at"),
        F.when(F.col("r.id").isNull(), "no id").alias("reason"),
        F.when(
            (tabled.isNotNull() & to_day(tabled).isNull())
            | (answered.isNotNull() & to_day(answered).isNull()),
            "date text is no date",
        ).alias("issue"),
    ).withColumn("source_url", F.when(F.col("_has_url"), F.col("_url"))).drop("_url", "_has_url")


def organisation_of_title(title: Column | str) -> Column:
    """What stands before the first colon, or all of it."""
    return strip(F.substring_index(F.coalesce(col(title), F.lit("")), ":", 1))


def parse_records(items: DataFrame, item: str = "item") -> DataFrame:
    """Transparency records with the fields found in their HTML body."""
    df, carried = _parsed(items, item, RECORD_SCHEMA)
    v = F.when(F.col("_text").rlike(r":\s*null"), F.try_parse_json("_text"))
    staged = df.withColumn("_v", v).withColumn("_s", html_sections("r.details.body"))

    def is_null(path: str) -> Column:
        return F.coalesce(F.is_variant_null(F.try_variant_get("_v", path, "variant")), F.lit(False))

    meta = "r.details.metadata.algorithmic_transparency_record_"
    published = F.col(meta + "date_published")
    return staged.select(
        *carried,
        last_segment("r.base_path").alias("record_id"),
        organisation_of_title("r.title").alias("organisation_name"),
        F.col(meta + "phase").alias("phase"),
        F.col("r.description").alias("one_sentence_desc"),
        section_text("_s", fixed.MODEL_ARCHITECTURE_SECTIONS).alias("model_architecture"),
        section_text("_s", fixed.SENSITIVE_ATTRIBUTE_SECTIONS).alias("sensitive_attributes"),
        section_link("_s", fixed.IMPACT_ASSESSMENT_SECTIONS).alias("dpi_assessment_url"),
        to_day(published).alias("date_published"),
        F.col(meta + "atrs_version").alias("standard_version"),
        F.concat(F.lit(fixed.GOV_UK), "r.base_path").alias("source_url"),
        F.current_timestamp().alias("ingested_at"),
        F.when(blank_to_null("r.base_path").isNull(), "no base_path")
        .when(is_null("$.title"), "title is null")
        .when(is_null("$.details"), "details is null")
        .when(is_null("$.details.metadata"), "details.metadata is null")
        .when(is_null("$.details.body"), "details.body is null")
        .alias("reason"),
        F.when(published.isNotNull() & to_day(published).isNull(), "date text is no date").alias("issue"),
    )

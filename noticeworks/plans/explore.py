"""Report-level operators: figures, facets, rankings and listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeworks import fixed_values as fixed
from noticeworks.functions.display import (
    day_text,
    label_of,
    money,
    money_bn,
    preview_text,
    status_label,
    supplier_summary,
)
from noticeworks.functions.text import month_of
from noticeworks.operators.median import exact_median


def confident(notices: DataFrame, strong_only: bool = True) -> DataFrame:
    """Strong notices, or strong and weak ones."""
    return notices.filter(F.col("ai_confidence").isin(*(("strong",) if strong_only else ("strong", "weak"))))


def filter_in(df: DataFrame, column: str, chosen: list[str] | None) -> DataFrame:
    """Rows with one of the chosen values; nothing chosen means all rows."""
    return df.filter(F.col(column).isin(*chosen)) if chosen else df


def text_search(df: DataFrame, columns: list[str], pattern: str | None) -> DataFrame:
    """Rows where any of the columns matches the regular expression, in any case."""
    if not pattern:
        return df
    hit: Column = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.col(c), F.lit("")).rlike(f"(?iu){pattern}")
    return df.filter(hit)


def kpis(notices: DataFrame) -> DataFrame:
    """Headline figures over notices, one row. Sums are 0 without values, the median NULL."""
    median = exact_median(notices, "value_amount")

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0.0))

    def in_status(s: str) -> Column:
        return F.coalesce(F.col("contract_status") == s, F.lit(False))

    return notices.agg(
        F.count(F.lit(1)).alias("n_contracts"),
        total(F.col("value_amount")).alias("spend"),
        F.count_if(in_status("awarded")).alias("n_awarded"),
        F.count_if(in_status("open")).alias("n_open"),
        F.count_if(in_status("planned")).alias("n_planned"),
        total(F.when(in_status("awarded"), F.col("value_amount"))).alias("awarded_value"),
    ).withColumn("median_value", F.lit(median).cast("double"))


def zone_kpis(zones: DataFrame) -> DataFrame:
    """Zones tracked, confirmed, and the money pledged."""
    return zones.agg(
        F.count(F.lit(1)).alias("n_zones"),
        F.count_if(F.col("status") == "confirmed").alias("n_confirmed"),
        F.coalesce(F.sum("investment_gbp"), F.lit(0.0)).alias("pledged"),
    ).withColumn("pledged_text", money_bn("pledged", zero_is_none=True))


def source_counts(notices: DataFrame) -> DataFrame:
    """Notices of each of the two sources, 0 included, and of both."""
    return notices.agg(
        F.count(F.lit(1)).alias("n_contracts"),
        *[F.count_if(F.col("source") == s).alias(s) for s in fixed.NOTICE_DOMAINS],
    )


def monthly_by_source(notices: DataFrame) -> DataFrame:
    """Value and notices per month and source. Undated rows drop out; an all-NULL sum is 0."""
    return (
        notices.dropna(subset=["published_date", "source"])
        .groupBy(month_of("published_date").alias("month"), "source")
        .agg(
            F.coalesce(F.sum("value_amount"), F.lit(0.0)).alias("value"),
            F.count("notice_id").alias("notices"),
        )
    )


def monthly_counts(df: DataFrame, day: str, group: str | None = None) -> DataFrame:
    """Rows per month (and group); rows without a date or group drop out."""
    groups = [group] if group else []
    return (
        df.dropna(subset=[day, *groups])
        .groupBy(month_of(day).alias("month"), *groups)
        .agg(F.count(F.lit(1)).alias("count"))
    )


def group_sizes(df: DataFrame, group: str) -> DataFrame:
    """Rows per value, smallest first; NULL drops out."""
    return df.dropna(subset=[group]).groupBy(group).agg(F.count(F.lit(1)).alias("count")).orderBy("count", group)


def top_groups(df: DataFrame, group: str, n: int = 10) -> DataFrame:
    """The ``n`` most frequent values; NULL drops out."""
    return (
        df.dropna(subset=[group])
        .groupBy(group)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), group)
        .limit(n)
    )


def facet(df: DataFrame, column: str) -> DataFrame:
    """Distinct values in order."""
    return df.select(column).dropna().distinct().orderBy(column)


def present_status_labels(notices: DataFrame) -> DataFrame:
    """Labels of the statuses that occur, in the fixed label order."""
    labels = list(fixed.STATUS_LABELS.values())
    position = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("status_label"))
    return (
        notices.select(status_label("contract_status").alias("status_label"))
        .distinct()
        .withColumn("position", position.cast("int"))
        .orderBy("position")
    )


def top_contracts(notices: DataFrame, n: int = 20) -> DataFrame:
    """The largest contracts as shown in a report. Only the ``n`` rows kept are formatted."""
    largest = notices.orderBy(F.col("value_amount").desc_nulls_last(), "notice_id").limit(n)
    return largest.select(
        F.col("buyer_name").alias("Buyer"),
        F.col("title").alias("Title"),
        money("value_amount").alias("Value"),
        status_label("contract_status").alias("Status"),
        supplier_summary("awards", "supplier_name").alias("Supplier(s)"),
        F.col("source").alias("Source"),
        day_text("published_date").alias("Published"),
        F.col("source_url").alias("Link"),
    )


def gap_top(gap: DataFrame, n: int = 25) -> DataFrame:
    """Organisations active on either side, the biggest buyers first."""
    return (
        gap.filter((F.col("ai_procurement_count") > 0) | (F.col("atrs_record_count") > 0))
        .orderBy(F.col("ai_procurement_count").desc(), "canonical_name")
        .limit(n)
    )


def gap_long(gap: DataFrame) -> DataFrame:
    """One row per organisation and measure, the measure labelled."""
    return gap.unpivot(
        "canonical_name", list(fixed.GAP_METRIC_LABELS), "metric", "count"
    ).withColumn("metric", label_of("metric", fixed.GAP_METRIC_LABELS))


def record_listing(records: DataFrame) -> DataFrame:
    return records.select(
        F.col("organisation_name").alias("Organisation"),
        F.col("phase").alias("Phase"),
        F.col("standard_version").alias("Version"),
        day_text("date_published").alias("Published"),
        F.col("one_sentence_desc").alias("Description"),
        F.col("source_url").alias("Link"),
    )


def announcement_listing(announcements: DataFrame) -> DataFrame:
    """Dated announcements, latest first."""
    return (
        announcements.dropna(subset=["public_timestamp"])
        .orderBy(F.col("public_timestamp").desc(), "announcement_id")
        .select(
            day_text("public_timestamp").alias("Published"),
            F.col("document_type").alias("Type"),
            F.col("title").alias("Title"),
            F.col("summary").alias("Summary"),
            F.col("source_url").alias("Link"),
        )
    )


def question_listing(questions: DataFrame) -> DataFrame:
    """Dated questions, latest first, the text cut for display."""
    return (
        questions.dropna(subset=["date_tabled"])
        .orderBy(F.col("date_tabled").desc(), "question_id")
        .select(
            day_text("date_tabled").alias("Tabled"),
            F.col("house").alias("House"),
            F.col("department").alias("Department"),
            F.col("member_name").alias("Member"),
            preview_text("question_text", 160).alias("Question"),
            F.col("source_url").alias("Link"),
        )
    )


def zone_listing(zones: DataFrame) -> DataFrame:
    """Growth zones, earliest first."""
    return zones.orderBy(F.col("announced_date").asc_nulls_last(), "zone_id").select(
        F.col("zone_name").alias("Zone"),
        F.col("region").alias("Region"),
        F.col("status").alias("Status"),
        money_bn("investment_gbp").alias("£ pledged"),
        F.col("compute_capacity").alias("Compute"),
        day_text("announced_date").alias("Announced"),
        F.col("source_url").alias("Source"),
        F.col("notes").alias("Notes"),
    )


def preview(df: DataFrame, order: list[Column | str], columns: list[str], n: int = 5, length: int = 80) -> DataFrame:
    """First ``n`` rows with their texts cut short."""
    return df.orderBy(*order).limit(n).select(*[F.substring(F.col(c).cast("string"), 1, length).alias(c) for c in columns])

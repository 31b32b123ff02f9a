"""Analytical views over the typed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeworks.functions.text import alias_key, month_of
from noticeworks.operators.dedup import dedup_richest, dedup_stored
from noticeworks.operators.orgs import AliasPolicy, alias_lookup


def procurement_dedup(notices: DataFrame) -> DataFrame:
    """Relevant notices, one per contract. The filter comes before the window."""
    return dedup_richest(notices.filter("ai_relevant"))


def stored_dedup(notices: DataFrame) -> DataFrame:
    """The same of a stored table, whose texts it does not shuffle where one side of the look-up is small."""
    return dedup_stored(notices.filter("ai_relevant"))


def reporting_gap(dedup: DataFrame, records: DataFrame, aliases: DataFrame) -> DataFrame:
    """Per canonical organisation: distinct notices bought against distinct records registered.

    Each side is counted by itself and joined afterwards. Joining first would pair every notice with
    every record of an organisation only to count them distinct again.
    """
    lookup = alias_lookup(aliases)

    def counted(df: DataFrame, name: str, key: str, output: str) -> DataFrame:
        named = df.select(alias_key(name).alias("_key"), key)
        return (
            named.join(lookup, "_key")
            .groupBy("canonical_name")
            .agg(F.count_distinct(key).alias(output))
        )

    orgs = aliases.select("canonical_name").distinct()
    bought = counted(dedup, "buyer_name", "notice_id", "ai_procurement_count")
    registered = counted(records, "organisation_name", "record_id", "atrs_record_count")
    return (
        orgs.join(bought, "canonical_name", "left")
        .join(registered, "canonical_name", "left")
        .na.fill(0, ["ai_procurement_count", "atrs_record_count"])
        .orderBy(F.col("ai_procurement_count").desc(), "canonical_name")
    )


def spend_by_month(dedup: DataFrame, aliases: DataFrame, policy: AliasPolicy = "distinct") -> DataFrame:
    """Value and number of notices per canonical buyer, month and currency.

    NULL months and sums are kept. Notices are summed per buyer spelling before the join, so that
    only one row per spelling, month and currency meets the alias table. With ``as_is`` a buyer
    listed under several spellings of one name counts once for each.
    """
    by_name = (
        dedup.select(
            alias_key("buyer_name").alias("_key"),
            month_of("published_date").alias("month"),
            "currency",
            "value_amount",
        )
        .groupBy("_key", "month", "currency")
        .agg(F.sum("value_amount").alias("total_value"), F.count(F.lit(1)).alias("notice_count"))
    )
    return (
        by_name.join(alias_lookup(aliases, policy), "_key")
        .groupBy("canonical_name", "month", "currency")
        .agg(F.sum("total_value").alias("total_value"), F.sum("notice_count").alias("notice_count"))
        .select("canonical_name", "month", "total_value", "currency", "notice_count")
        .orderBy(F.col("month").desc_nulls_last(), F.col("total_value").desc_nulls_last())
    )


def _trend(df: DataFrame, flag: str, day: str, group: str, output: str) -> DataFrame:
    return (
        df.filter(F.col(flag))
        .groupBy(month_of(day).alias("month"), group)
        .agg(F.count(F.lit(1)).alias(output))
        .orderBy(F.col("month").desc_nulls_last(), F.col(output).desc(), F.col(group).asc_nulls_last())
    )


def question_trends(questions: DataFrame) -> DataFrame:
    """Relevant questions per department and month."""
    return _trend(questions, "ai_relevance_flag", "date_tabled", "department", "question_count")


def announcement_trends(announcements: DataFrame) -> DataFrame:
    """Relevant announcements per month and document type."""
    return _trend(announcements, "ai_relevant", "public_timestamp", "document_type", "announcement_count")


def capacity_overview(zones: DataFrame) -> DataFrame:
    """Growth zones by announcement date."""
    return zones.select(
        "zone_id",
        "zone_name",
        "region",
        "status",
        "investment_gbp",
        "compute_capacity",
        "announced_date",
        "lead_org",
        "source_url",
    ).orderBy(F.col("announced_date").asc_nulls_last(), "zone_id")


VIEWS = {
    "v_procurement_dedup": lambda t: procurement_dedup(t["procurement_notices"]),
    "v_reporting_gap": lambda t: reporting_gap(
        procurement_dedup(t["procurement_notices"]), t["atrs_records"], t["org_aliases"]
    ),
    "v_spend_by_month": lambda t: spend_by_month(
        procurement_dedup(t["procurement_notices"]), t["org_aliases"], "as_is"
    ),
    "v_wpq_trends": lambda t: question_trends(t["written_questions"]),
    "v_announcement_trends": lambda t: announcement_trends(t["gov_announcements"]),
    "v_capacity_overview": lambda t: capacity_overview(t["ai_growth_zones"]),
}


def register_views(tables: dict[str, DataFrame]) -> None:
    """Make the tables and the views over them known to ``spark.sql`` under their names.

    ``v_spend_by_month`` counts a buyer once for each of its spellings (``as_is``); call
    :func:`spend_by_month` to count it once.
    """
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    for name, view in VIEWS.items():
        view(tables).createOrReplaceTempView(name)


def run_count_columns(relevant: str = "ai_relevant", reason: str = "reason") -> list[Column]:
    """Rows read, rows parsed, relevant rows and rows in error, for ``agg`` or ``observe``."""
    ok = F.col(reason).isNull()
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(ok).alias("n_parsed"),
        F.count_if(ok & F.col(relevant)).alias("n_relevant"),
        F.count_if(~ok).alias("n_errors"),
    ]


def run_counts(parsed: DataFrame, relevant: str = "ai_relevant", reason: str = "reason") -> DataFrame:
    """The counts of a parse run, in one pass."""
    return parsed.agg(*run_count_columns(relevant, reason))

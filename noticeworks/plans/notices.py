"""Procurement releases to notices."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeworks.functions import ocds
from noticeworks.functions.relevance import DEFAULT_CONFIG, RelevanceConfig, classify, is_relevant
from noticeworks.functions.text import blank_to_null, first_non_blank, to_day, to_number


def with_release(df: DataFrame, release: str = "release", strict: bool = True) -> DataFrame:
    """Parse release JSON once: adds ``r``, ``aw`` (its awards), ``suspect`` and ``v`` (VARIANT).

    ``v`` is there only for texts with a null literal in them, if ``strict`` (no other can hold an explicit null), and for
    those whose parsed parts look as if one was of a wrong kind (``suspect``); so no other needs the second parse. The parses sit inside
    generators, which Spark never moves a filter below; with a plain projection, a later filter on a parsed field would parse
    every text once more.
    """
    r, awards, suspect, v = _parse_columns(df.sparkSession.sparkContext.applicationId, release, strict)
    return (
        df.select("*", F.explode(F.array(r)).alias("r"))
        .select("*", F.explode(F.array(awards)).alias("aw"))
        .select("*", suspect.alias("suspect"))
        .select("*", F.explode(F.array(v)).alias("v"))
    )


@lru_cache(maxsize=16)
def _parse_columns(app: str, release: str, strict: bool):
    r, aw = F.col("r"), F.col("aw")
    wanted = F.col("suspect") | F.contains(release, F.lit("null")) if strict else F.col("suspect")
    return (
        F.from_json(F.col(release), ocds.RELEASE_SCHEMA, ocds.UNREAD),
        F.from_json(r["awards"], ocds.AWARDS_SCHEMA),
        ocds.suspicious(r, aw),
        F.when(wanted, F.try_parse_json(release)),
    )


def parse_releases(
    releases: DataFrame,
    source: Column | str,
    release: str = "release",
    config: RelevanceConfig = DEFAULT_CONFIG,
    lenient: bool = False,
) -> DataFrame:
    """One notice per release, beside the input's other columns.

    ``source`` is a source name or a column of them. ``compiled_id``, if the input has it, stands in
    for a missing release id. No row is lost: ``reason`` says why a row is no notice (NULL for a
    good one) and ``issue`` notes a date text that is no date and was set to NULL. With ``lenient``
    an explicit ``null`` counts as a missing key instead of a reason.
    """
    src = F.lit(source) if isinstance(source, str) else source
    made_up = "compiled_id" in releases.columns
    carried = [c for c in releases.columns if c not in (release, "compiled_id")]
    app = releases.sparkSession.sparkContext.applicationId
    first, second, own, last, flags = _columns(app, release, made_up, config, lenient)
    return (
        with_release(releases.withColumn("_source", src), release, not lenient)
        .select(*carried, "_source", "r", "aw", "v", "suspect", *first)
        .withColumns(second)
        .withColumn("_own", own)
        .select(*carried, *last)
        .withColumns(flags)
    )


@lru_cache(maxsize=16)
def _columns(app: str, release: str, made_up: bool, config: RelevanceConfig, lenient: bool):
    """The expressions of each step. They name columns only, so they are built once per application
    and used for any number of inputs: building them takes longer than planning a query."""
    r, aw = F.col("r"), F.col("aw")
    has_null = F.contains(release, F.lit("null"))
    first = [
        notice_key(release, r, made_up).alias("_id"),
        ocds.headline_value(r, aw).alias("_value"),
        ocds.headline_supplier(aw).alias("_supplier"),
        ocds.award_period(aw).alias("_period"),
        ocds.all_documents(r, aw).alias("_docs"),
        ocds.cpv_codes(r).alias("_cpv"),
        ocds.notice_title(r).alias("_title"),
        ocds.type_reason(F.col("v"), r, aw, F.col("suspect") & ocds.miscounted(release, r, aw)).alias("_wrong"),
        has_null.alias("_has_null"),
        F.when(F.col("suspect") & F.col("v").isNull(), ocds.unread_parts(release, r, aw)).alias("_untold"),
    ]
    second = {
        "_dates": ocds.contract_dates(r, "_period"),
        "_documents": ocds.distinct_documents("_docs"),
        "_amount": ocds.amount_text("_value"),
    }
    own = ocds.own_documents("_documents", F.col("_source"))

    amount = to_number("_amount")
    reason = F.when(F.col("_id").isNull() | blank_to_null("r.ocid").isNull(), "no ocid or id")
    reason = F.coalesce(reason, F.col("_wrong"))
    if not lenient:
        nulls = ocds.null_reason(F.col("v"), r, aw, F.col("_period"))
        # A text with a null that the strict parser refuses (a key twice, say) must not pass unchecked.
        unchecked = F.when(F.col("_has_null") & F.col("v").isNull(), "explicit nulls cannot be told")
        reason = F.coalesce(reason, F.when(F.col("_has_null") & F.col("v").isNotNull(), nulls), unchecked)
    reason = F.coalesce(reason, F.when(F.col("_untold"), "kinds of parts cannot be told"))
    reason = F.coalesce(reason, F.when(F.col("_amount").isNotNull() & amount.isNull(), "amount is no number"))
    published, start, end = F.col("_dates.published"), F.col("_dates.start"), F.col("_dates.end")
    forwards = ~ocds.backwards("_dates")
    days = {
        "published_date": to_day(published),
        "contract_start": F.when(forwards, to_day(start)),
        "contract_end": F.when(forwards, to_day(end)),
    }
    not_a_day = (published.isNotNull() & days["published_date"].isNull()) | (
        forwards
        & ((start.isNotNull() & days["contract_start"].isNull()) | (end.isNotNull() & days["contract_end"].isNull()))
    )
    last = [
        F.concat("r.ocid", F.lit("::"), "_id").alias("notice_id"),
        F.col("_source").alias("source"),
        ocds.stage(r).alias("stage"),
        F.col("r.tender.status").alias("tender_status"),
        ocds.contract_status(r, aw).alias("contract_status"),
        F.col("_title").alias("title"),
        F.col("r.tender.description").alias("description"),
        amount.alias("value_amount"),
        ocds.currency("_value").alias("currency"),
        F.col("r.buyer.name").alias("buyer_name"),
        F.col("r.buyer.identifier.id").alias("buyer_org_id"),
        F.col("_supplier.name").alias("supplier_name"),
        F.col("_supplier.id").alias("supplier_id"),
        F.to_json("_cpv").alias("cpv_codes"),
        ocds.json_or_null(F.col("_documents")).alias("documents"),
        F.nullif("r.awards", F.lit("[]")).alias("awards"),
        ocds.framework_id(r).alias("framework_id"),
        F.col("r.tender.procurementMethod").alias("procurement_method"),
        *[day.alias(name) for name, day in days.items()],
        classify("_title", "r.tender.description", "_cpv", config).alias("ai_confidence"),
        F.lit(config.version).alias("ai_relevance_version"),
        ocds.notice_url("_own", F.col("r.ocid"), F.col("_source")).alias("source_url"),
        F.current_timestamp().alias("ingested_at"),
        reason.alias("reason"),
        F.when(not_a_day, "date text is no date").alias("issue"),
    ]
    flags = {
        "ai_relevant": is_relevant("ai_confidence"),
        "link_status": F.when(F.col("source_url").isNotNull(), "ok").otherwise("unresolved"),
    }
    return first, second, own, last, flags


#: What tells which notice a release is and whether it is relevant; ``unread`` is NULL where all of that, and the text's form, could be read.
_GLANCE = """struct<ocid string, id string, unread string,
    tender struct<title string, description string, classification struct<scheme string, id string>,
        items array<struct<classification struct<scheme string, id string>>>>,
    planning struct<project struct<title string>>>"""


def promising(releases: DataFrame, release: str = "release", config: RelevanceConfig = DEFAULT_CONFIG, keep_all: bool = False) -> DataFrame:
    """The rows from which :func:`parse_releases` may make a good and, unless ``keep_all``, relevant notice; adds ``notice``, its id.

    Only a small part of each release is read. ``notice`` is NULL where that could not be done; such rows stay, so the whole parse decides on them.
    """
    made_up = "compiled_id" in releases.columns
    looked = releases.select("*", F.explode(F.array(F.from_json(release, _GLANCE, ocds.UNREAD))).alias("r"))
    r, sure = F.col("r"), F.col("r.unread").isNull()
    id_ = notice_key(release, r, made_up)
    tier = classify(ocds.notice_title(r), r["tender"]["description"], ocds.cpv_codes(r), config)
    wanted = id_.isNotNull() & blank_to_null(r["ocid"]).isNotNull() & (F.lit(True) if keep_all else is_relevant(tier))
    notice = F.when(sure, F.concat(r["ocid"], F.lit("::"), id_)).alias("notice")
    return looked.filter(~sure | wanted).select(*releases.columns, notice)


def notice_key(release: str, r: Column, made_up: bool) -> Column:
    """The release's own id, unless it is the number 0, or else the one made up for it."""
    own = F.when(~F.coalesce(ocds.zero_id(release, r), F.lit(False)), r["id"])
    return first_non_blank(own, F.col("compiled_id") if made_up else F.lit(None))


def good(parsed: DataFrame) -> DataFrame:
    """Rows that could be read."""
    return parsed.filter("reason IS NULL").drop("reason", "issue")


def quarantine(parsed: DataFrame) -> DataFrame:
    """Rows that could not be read, with the reason."""
    return parsed.filter("reason IS NOT NULL")

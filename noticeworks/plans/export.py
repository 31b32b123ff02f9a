"""Writing the analytical views out."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from noticeworks.functions.text import version_label
from noticeworks.operators.dedup import dedup_richest, dedup_stored, richest_group
from noticeworks.operators.lookup import measured
from noticeworks.plans import gold
from noticeworks.plans.store import Manifest, changed_rows, delete, read_manifest, read_text, visible, write_text
from noticeworks.schemas import TABLES, read_table
from noticeworks.session import new_path

UNKNOWN_YEAR = "unknown"


def with_year(df: DataFrame, day: str = "published_date") -> DataFrame:
    return df.withColumn("year", F.coalesce(F.year(day).cast("string"), F.lit(UNKNOWN_YEAR)))


def write_by_year(df: DataFrame, path: str, day: str = "published_date", rows_per_file: int = 5_000_000) -> int:
    """Replace ``path`` by one folder per year, ``year=unknown`` for undated rows; returns the rows.

    Rebalancing gives each year its own few files and splits a year that is far larger than the
    others over several tasks.
    """
    seen = Observation()
    (
        with_year(df, day)
        .observe(seen, F.count(F.lit(1)).alias("n"))
        .hint("rebalance", F.col("year"))
        .write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("year")
        .parquet(path)
    )
    return seen.get["n"]


def read_by_year(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The exported years. ``year`` is read as text, whether or not ``unknown`` occurs."""
    return spark.read.schema(
        StructType([*schema.fields, StructField("year", StringType())])
    ).parquet(path)


def _in_groups(rows: DataFrame, groups: DataFrame, how: str) -> DataFrame:
    """Rows whose group is, or with ``left_anti`` is not, among ``groups`` (written); missing parts of a key are equal."""
    names = [f"_own{c}" for c in groups.columns]
    own = rows.select("*", *(c.alias(n) for c, n in zip(richest_group(), names, strict=True)))
    same = [F.col(n).eqNullSafe(F.col(c)) for c, n in zip(groups.columns, names, strict=True)]
    return own.join(measured(groups), same, how).drop(*names)


#: Beside the exported years: the stored version they show, or nothing while they are being replaced.
LAST_EXPORT = "_last_export.json"


def export_new(spark: SparkSession, store: str, path: str, rows_per_file: int = 5_000_000) -> list[str]:
    """Bring the richest notices under ``path``, a folder per year, up to date with the stored table; the years rewritten.

    Of the rows that runs brought or took since the last export, the groups are formed anew: a richer notice may take the
    place of one of another year. Years in which such a group has, or had, its notice are rewritten, other years' files
    are not touched. The first export, one after an export that was broken off, and one that cannot tell what went
    (its files are deleted) write all years.
    """
    last = read_text(spark, f"{path}/{LAST_EXPORT}")
    now, changed = read_manifest(spark, store), None
    if last:
        now, changed = changed_rows(spark, store, Manifest.from_json(last))
    schema = TABLES["procurement_notices"]
    relevant = visible(spark, store, now, "procurement_notices").filter("ai_relevant").select(*schema.names)
    if changed is None:
        write_by_year(dedup_stored(relevant), path, rows_per_file=rows_per_file)
        years = {r[0] for r in read_by_year(spark, path, schema).select("year").distinct().collect()}  # as many as years
    else:
        years = _rewrite(spark, relevant, changed, path, rows_per_file)
    write_text(spark, f"{path}/{LAST_EXPORT}", now.to_json())
    return sorted(years)


def _rewrite(spark: SparkSession, relevant: DataFrame, changed: DataFrame, path: str, rows_per_file: int) -> set[str]:
    staged = new_path(spark, "groups")
    changed.filter("ai_relevant").select(*richest_group()).distinct().write.parquet(staged)
    groups = spark.read.parquet(staged)
    exported = read_by_year(spark, path, TABLES["procurement_notices"])
    staged = new_path(spark, "winners")
    with_year(dedup_richest(_in_groups(relevant, groups, "left_semi"))).write.parquet(staged)
    winners = spark.read.parquet(staged)
    years = {r[0] for r in _in_groups(exported, groups, "left_semi").select("year").union(winners.select("year")).distinct().collect()}
    if not years:
        return years
    rows = _in_groups(exported.filter(F.col("year").isin(*years)), groups, "left_anti").unionByName(winners)
    seen = Observation()
    rows = rows.observe(seen, F.collect_set("year").alias("years"), F.count(F.lit(1)).alias("n"))
    write_text(spark, f"{path}/{LAST_EXPORT}", "")  # until the years are in place, nobody knows what they show
    (
        rows.hint("rebalance", F.col("year"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("year")
        .parquet(path)
    )
    for year in years - set(seen.get["years"]):  # the only notice of a year may have given way to one of another
        delete(spark, f"{path}/year={year}")
    return years


# Exported relations whose columns are not those of a table. Months are plain timestamps.
_MONTH = StructField("month", TimestampNTZType())
VIEW_SCHEMAS = {
    "v_reporting_gap": StructType(
        [
            StructField("canonical_name", StringType()),
            StructField("ai_procurement_count", LongType()),
            StructField("atrs_record_count", LongType()),
        ]
    ),
    "v_spend_by_month": StructType(
        [
            StructField("canonical_name", StringType()),
            _MONTH,
            StructField("total_value", DoubleType()),
            StructField("currency", StringType()),
            StructField("notice_count", LongType()),
        ]
    ),
    "v_announcement_trends": StructType(
        [_MONTH, StructField("document_type", StringType()), StructField("announcement_count", LongType())]
    ),
    "v_wpq_trends": StructType(
        [_MONTH, StructField("department", StringType()), StructField("question_count", LongType())]
    ),
    "v_capacity_overview": StructType(
        [f for f in TABLES["ai_growth_zones"] if f.name not in ("site", "notes")]
    ),
}
_EXPORTED_TABLES = ("atrs_records", "gov_announcements", "written_questions", "ai_growth_zones")


def read_gold(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The exports under ``root`` as reports use them; one not written yet is empty.

    Record versions are put into one form and notices without a confidence read ``none``.
    """
    schemas = {name: TABLES[name] for name in _EXPORTED_TABLES} | VIEW_SCHEMAS
    out = {name: read_table(spark, f"{root}/{name}", schema) for name, schema in schemas.items()}
    by_year = StructType([*TABLES["procurement_notices"].fields, StructField("year", StringType())])
    notices = read_table(spark, f"{root}/procurement_notices", by_year)
    out["procurement_notices"] = notices.na.fill("none", ["ai_confidence"])
    out["atrs_records"] = out["atrs_records"].withColumn("standard_version", version_label("standard_version"))
    return out


def gold_relations(tables: dict[str, DataFrame], dedup: DataFrame) -> dict[str, DataFrame]:
    """The nine named exports beside the notices."""
    return {
        "atrs_records": tables["atrs_records"],
        "v_reporting_gap": gold.reporting_gap(dedup, tables["atrs_records"], tables["org_aliases"]),
        "v_spend_by_month": gold.spend_by_month(dedup, tables["org_aliases"], "as_is"),
        "gov_announcements": tables["gov_announcements"].filter("ai_relevant"),
        "written_questions": tables["written_questions"].filter("ai_relevance_flag"),
        "ai_growth_zones": tables["ai_growth_zones"],
        "v_announcement_trends": gold.announcement_trends(tables["gov_announcements"]),
        "v_wpq_trends": gold.question_trends(tables["written_questions"]),
        "v_capacity_overview": gold.capacity_overview(tables["ai_growth_zones"]),
    }


def export_gold(spark: SparkSession, tables: dict[str, DataFrame], root: str) -> dict[str, int]:
    """Write every export under ``root`` and return the rows of each.

    De-duplication runs once: the views read the notices just written, not the raw table again.
    """
    notices = f"{root}/procurement_notices"
    counts = {"procurement_notices": write_by_year(gold.procurement_dedup(tables["procurement_notices"]), notices)}
    dedup = read_by_year(spark, notices, TABLES["procurement_notices"]).drop("year")
    for name, df in gold_relations(tables, dedup).items():
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{root}/{name}")
        counts[name] = seen.get["n"]
    return counts

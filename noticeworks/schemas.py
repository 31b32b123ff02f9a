"""Typed tables: schema registry, additive evolution and append by column name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from noticeworks import fixed_values as fixed

_TYPES = {
    "string": StringType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
    "date": DateType(),
    "timestamp": TimestampType(),
}


def columns(text: str) -> StructType:
    """Schema from ``name type, …`` (needs no session, unlike ``StructType.fromDDL``)."""
    pairs = (c.split() for c in text.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


# JSON columns are STRING columns holding JSON text.
TABLES: dict[str, StructType] = {
    name: columns(text)
    for name, text in {
        "atrs_records": """record_id string, organisation_name string, phase string,
            one_sentence_desc string, model_architecture string, sensitive_attributes string,
            dpi_assessment_url string, date_published date, standard_version string,
            source_url string, ingested_at timestamp""",
        "procurement_notices": """notice_id string, source string, stage string, title string,
            description string, value_amount double, currency string, buyer_name string,
            buyer_org_id string, supplier_name string, supplier_id string, cpv_codes string,
            published_date date, contract_start date, contract_end date, ai_relevant boolean,
            ai_relevance_version string, link_status string, source_url string,
            ingested_at timestamp, documents string, awards string, framework_id string,
            procurement_method string, tender_status string, contract_status string,
            ai_confidence string, notice_summary string, enrichment_version string""",
        "org_aliases": "raw_name string, canonical_name string, org_type string",
        "written_questions": """question_id string, house string, date_tabled date,
            date_answered date, member_name string, department string, question_text string,
            answer_text string, ai_relevance_flag boolean, topic_tags string, source_url string,
            ingested_at timestamp, enrichment_version string""",
        "gov_announcements": """announcement_id string, title string, document_type string,
            organisations string, public_timestamp timestamp, updated_timestamp timestamp,
            summary string, body_excerpt string, ai_relevant boolean, ai_confidence string,
            ai_relevance_version string, topic_tags string, enrichment_version string,
            source_url string, ingested_at timestamp""",
        "ai_growth_zones": """zone_id string, zone_name string, site string, region string,
            status string, investment_gbp double, compute_capacity string, announced_date date,
            lead_org string, source_url string, notes string""",
        "datacentre_planning": """application_id string, site_name string, local_authority string,
            description string, status string, decision_date date, latitude double,
            longitude double, dc_relevant boolean, source_url string, ingested_at timestamp""",
    }.items()
}

KEYS = {
    "atrs_records": "record_id",
    "procurement_notices": "notice_id",
    "org_aliases": "raw_name",
    "written_questions": "question_id",
    "gov_announcements": "announcement_id",
    "ai_growth_zones": "zone_id",
    "datacentre_planning": "application_id",
}


def evolve(df: DataFrame, schema: StructType) -> DataFrame:
    """Add the columns of ``schema`` that ``df`` lacks, as typed NULLs; the rest is unchanged."""
    have = set(df.columns)
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name not in have]
    return df.select("*", *missing) if missing else df


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns of ``schema``, matched by name, cast; absent ones are NULL.

    A text that is no valid value of the column type becomes NULL.
    """
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )


def append_by_name(table: DataFrame, rows: DataFrame) -> DataFrame:
    """``table`` followed by ``rows`` put into the table's columns."""
    return table.unionByName(conform(rows, table.schema))


def read_table(spark: SparkSession, path: str, schema: StructType, **options: str) -> DataFrame:
    """Parquet table, or an empty one with the right columns where nothing was written yet.

    Files may differ in columns: they are matched by name and missing ones are NULL.
    """
    if not exists(spark, path):
        return empty(spark, schema)
    return spark.read.options(**options).schema(schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows. Unlike a frame made from an empty list, the optimizer sees that, and drops joins with it."""
    fields = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema)
    return spark.sql(f"SELECT {fields} WHERE false")


def create_tables(spark: SparkSession, root: str) -> list[str]:
    """Write an empty Parquet table for every registered name not there yet; returns those written.

    Tables that exist are left as they are, so a second call does nothing.
    """
    created = []
    for name, schema in TABLES.items():
        if not exists(spark, f"{root}/{name}"):
            spark.createDataFrame([], schema).write.parquet(f"{root}/{name}")
            created.append(name)
    return created


def shipped_aliases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(fixed.ORG_ALIASES), TABLES["org_aliases"])


def shipped_growth_zones(spark: SparkSession) -> DataFrame:
    text = StructType([StructField(f.name, StringType()) for f in TABLES["ai_growth_zones"]])
    return conform(spark.createDataFrame(list(fixed.GROWTH_ZONES), text), TABLES["ai_growth_zones"])

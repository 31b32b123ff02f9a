"""Curated CSV registers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from noticeworks import fixed_values as fixed


def read_seed_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header, in the column order of ``schema``: quoted commas, doubled quotes, empty and
    the usual "no value" texts as NULL, columns cast to their types. Adds ``_ord``, the file order.
    """
    text = StructType([StructField(f.name, StringType()) for f in schema])
    raw = spark.read.csv(path, header=True, schema=text, quote='"', escape='"', enforceSchema=False)
    typed = [
        F.when(~F.col(f.name).isin(*fixed.CSV_NULLS), F.col(f.name)).try_cast(f.dataType).alias(f.name)
        for f in schema
    ]
    order = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("n"),
    )
    return raw.select(*typed, order.alias("_ord"))

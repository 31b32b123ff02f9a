"""From documents to token ids: five stages, each reading what the one before it wrote.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``docs``. Rows with null ids, empty texts, repeated rows and extra columns go through all of them; an
empty table gives an empty result.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.llm import bpe, decontaminate, lines, similar, toxicity
from noticeworks.llm.common import OWN, ship, table, written
from noticeworks.llm.queries import PATTERN, RANKS


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under 0.5. The model learns from the source tables, not from ``docs``."""
    model = toxicity.learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    score = OWN + "score"
    return toxicity.with_scores(docs, model, score=score).filter(F.col(score) < 0.5).select(*docs.columns)


def lines_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks that earlier ones have; one of which nothing is left goes."""
    gone = OWN + "removed"
    out = lines.dedup_lines(docs, removed=gone).filter((F.col(gone) == 0) | F.col("text").rlike("\\S"))
    changed = F.when(F.col(gone) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", changed).select(*docs.columns)


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (similarity 0.8 or more of 5-word shingles): the least id, null ids last; of equal ids, one row."""
    row, key = OWN + "row", OWN + "key"
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")  # written, so that numbers stay
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", row).alias(key)
    kept = similar.firsts(rows.select(order, "text"), key).select(F.col(f"{key}.{row}").alias(row))
    return rows.join(kept.hint("merge"), row, "left_semi").select(*docs.columns)  # the kept ids grow with the documents


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminate.without_matches(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document and the digest of what they decode to."""
    out = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), RANKS, PATTERN)
    packed = out.withColumns({"n_tokens": (F.octet_length("ids") / 4).cast("long"), "ids_sha256": F.sha2("ids", 256)})
    return packed.withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


def _stage(fn):
    """``fn`` with the package sent to the workers first."""

    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return fn(ship(spark), docs, sf_dir)

    return run_stage


STAGES = [
    ("toxicity", _stage(toxic_out)),
    ("line dedup", _stage(lines_out)),
    ("near copies", _stage(near_copies_out)),
    ("decontamination", _stage(benchmark_out)),
    ("token ids", _stage(token_ids)),
]

#: SQL can express none of the stages; tests hold each against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

"""Registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.llm import bpe, decontaminate, exact, fingerprints, langid, lines, pii, sharding, simhash, spelling, toxicity, webtext, whitening
from noticeworks.llm.common import held_out, ship, table, written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
SHARDS = 24


def query(fn: Query) -> Query:
    """Register ``fn`` under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(ship(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select("doc_id", "text", F.length("text").alias("n_chars").cast("long"), "words_removed")


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.with_scores(docs, model, keep_text=False)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def joined(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, pii.BASE),
        F.sha2(joined("base_spans").cast("binary"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
        (F.size("spans") - F.size("base_spans")).cast("long").alias("n_added"),
    )


@query
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.with_language(docs.drop("lang"), langid.learn(docs), keep_text=False)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    prints = written(simhash.with_fingerprints(docs), "fingerprints")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return simhash.near_copies(prints).select("doc_id", hexed.alias("fingerprint"), "component_id")


@query
def op6_web_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = webtext.main_texts(table(spark, sf_dir, "pages"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


@query
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fingerprints.with_fingerprints(table(spark, sf_dir, "documents"))
    return out.withColumn("edited", F.sha2(F.col("edited").cast("binary"), 256)).withColumnRenamed("edited", "edited_sha256")


@query
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return decontaminate.matches(table(spark, sf_dir, "documents"), items)


@query
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.col("text").cast("binary")
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(b""))).alias("text_crc32"),
    )
    return sharding.shuffle_shards(rows, SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.round_trip(docs, RANKS, PATTERN)
    return out.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


@query
def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.dedup_exact(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


ORACLE["op12_exact_dedup"] = r"""
WITH d AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), h AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT d.doc_id, h.keep_id, h.group_size, d.doc_id = h.keep_id AS kept, d.text_sha256
FROM d JOIN h ON h.text_sha256 = d.text_sha256"""


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")

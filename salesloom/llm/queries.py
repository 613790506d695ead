"""One query per operator, over the whole of its table and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from salesloom.llm import (
    conversations, decontaminate, fingerprints, langid, lm_score, middle, minhash, ngram_join, packing,
    pii, placement, revisits, secrets,
)
from salesloom.llm.common import table
from salesloom.llm.oracles import ORACLE_SQL as ORACLE_SQL

Query = Callable[[SparkSession, str], DataFrame]


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.report(pii.detect(documents, pii.fit(documents)))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(
        table(spark, sf_dir, "documents"), words=4, num=85, den=100
    )


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    )
    hit = decontaminate.hit_words(F.col("spans"))
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op4_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    addressed = secrets.address(documents)
    return secrets.report(secrets.findings(addressed, secrets.scan(documents, addressed)))


def op6_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page of the crawl derived from ``pages``, resolved; fields as name=value."""
    fields = F.array_join(F.transform(
        "fields", lambda e: F.concat(e["key"], F.lit("="), e["value"])
    ), ";")
    found = revisits.resolve(revisits.crawl(table(spark, sf_dir, "pages")))
    return found.withColumn("fields", fields)


def op7_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


SHARDS = [f"shard-{i:03d}" for i in range(256)]


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document on one of 256 shards, and where it goes if the last one leaves."""
    documents = table(spark, sf_dir, "documents").select("doc_id")
    placed = placement.place(documents, "doc_id", SHARDS)
    fewer = placed.withColumnRenamed("shard", "now").drop("slot")
    return placement.place(fewer, "doc_id", SHARDS[:-1]).select(
        "doc_id", "slot", F.col("now").alias("shard"), F.col("shard").alias("shard_without_last")
    )


def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.sequences(table(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(
        table(spark, sf_dir, "documents"), words=3, num=85, den=100
    )


def op12_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return middle.report(middle.transform(table(spark, sf_dir, "documents")))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversations.report_of_all(rows, conversations.repair(conversations.damage(rows)))


QUERIES: dict[str, Query] = {
    "op1_pii": op1_pii,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_decontaminate": op3_decontaminate,
    "op4_lattice_score": op4_lattice_score,
    "op5_secrets": op5_secrets,
    "op6_revisits": op6_revisits,
    "op7_fingerprint": op7_fingerprint,
    "op8_shards": op8_shards,
    "op9_pack": op9_pack,
    "op10_language": op10_language,
    "op11_minhash": op11_minhash,
    "op12_middle": op12_middle,
    "op13_conversations": op13_conversations,
}

"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import (decontaminate, extraction, licenses, merkle, mil, minhash, mixing, packing, pii, quality_rules, toxicity, urls,
                           whitening)
from cartwheel.llm.common import table
from cartwheel.llm.training import held_out


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = mil.fit(documents, table(spark, sf_dir, "labels"))
    return mil.score(documents, model, ["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    links = toxicity.fit(documents, table(spark, sf_dir, "labels"))
    scored = toxicity.score(documents, links, ["doc_id"])
    return scored.withColumn("score", F.col("p_toxic")).withColumn("toxic", F.col("p_toxic") >= toxicity.THRESHOLD)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform(F.coalesce("items", F.array().cast("array<long>")), lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(F.col("of").alias("doc_id"), *[count(kind) for kind in pii.KINDS], F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"),
                        pii.joined(F.col("spans")).alias("spans"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(licenses.scan(table(spark, sf_dir, "documents"), licenses.default_templates(spark)))


def op8_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract_pages(table(spark, sf_dir, "pages"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality_rules.judge(documents, quality_rules.fit(documents, table(spark, sf_dir, "labels")))


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules, listed = urls.default_rules(spark)
    return urls.filter_urls(table(spark, sf_dir, "pages"), rules, listed).select(
        "page_id", "host", "path", "rule", "verdict", "listed")


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return merkle.proofs(table(spark, sf_dir, "documents"), even, F.replace(F.col("text"), F.lit("\n")))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_minhash": op2_minhash,
    "op3_toxicity": op3_toxicity,
    "op4_decontamination": op4_decontamination,
    "op5_packing": op5_packing,
    "op6_pii": op6_pii,
    "op7_licenses": op7_licenses,
    "op8_extraction": op8_extraction,
    "op9_quality_rules": op9_quality_rules,
    "op10_urls": op10_urls,
    "op11_mixing": op11_mixing,
    "op12_merkle": op12_merkle,
    "op13_whitening": op13_whitening,
}

"""Training-data pipeline over ``documents``: quality, near-dedup, benchmark
decontamination, personal data, packing.

Each stage gets the documents that the one before kept, written as Parquet to
the shared folder and read again, and returns the columns of documents; the
last returns the packed pieces. An empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import decontaminate, mil, minhash, packing, pii
from cartwheel.llm.common import materialise, table


def counted(docs: DataFrame) -> DataFrame:
    """``docs`` with n_chars as its changed texts have it."""
    if "n_chars" not in docs.columns:
        return docs
    chars = F.coalesce(F.length("text"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return docs.withColumn("n_chars", chars)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier rejects."""
    model = mil.fit(docs, table(spark, sf_dir, "labels"))
    return mil.score(docs, model, docs.columns, value="_score", flag="_accepted").where("_accepted = 1").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages cut out of the texts."""
    return counted(decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by the name of its kind."""
    return counted(pii.redact(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenised texts with their sequence and offset."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("best-fit packing", best_fit_packing),
]

#: SQL has neither the trained classifier nor the tokenizer; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialise(docs)
    return docs

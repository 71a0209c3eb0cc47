"""The pipeline's stages against the operators, and its edge cases."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from cartwheel.llm import pii
from llm_util import component_ids

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), stage(spark, docs, SF).schema)
        out.append(docs)
    return out


def test_stages(spark, steps):
    docs, quality, unique, clean, redacted, packed = steps
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "MinHash near-dedup", "benchmark decontamination", "PII", "best-fit packing"]
    assert all(s.columns == docs.columns and s.dtypes == docs.dtypes for s in steps[:5])
    assert 0 < quality.count() < docs.count()
    ids = component_ids([(r.doc_id, r.text) for r in quality.collect()])
    assert sorted(r.doc_id for r in unique.collect()) == sorted({*ids.values()})
    assert clean.count() == redacted.count() == unique.count()
    assert pii.find(redacted).where(F.size("base") > 0).count() == 0
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in redacted.collect()}
    assert redacted.where("n_chars <> length(text)").count() == 0


def test_run_gives_the_last_stage(spark, steps):
    want = steps[-1].select("doc_id", "piece", "length", "ids_crc32").collect()
    got = corpus_pipeline.run(spark, SF).select("doc_id", "piece", "length", "ids_crc32").collect()
    assert sorted(got) == sorted(want)


def test_odd_documents_pass_through(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, " ", None, None, 1)]
    for table in (rows, []):
        docs = spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long").withColumn("score", F.lit(1))
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != "best-fit packing":
                assert out.columns == docs.columns
                docs = out
        out.count()

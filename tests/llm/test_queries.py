"""The registered queries on the smallest tables: contract columns, and SQL where there is any."""

import duckdb
import pytest

import __spark_entry__ as entry
from cartwheel.llm.oracle import ORACLE
from cartwheel.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
#: The contracts' columns, by name and type.
CONTRACT = {
    "op1_quality": "doc_id bigint held_out boolean score double predicted int",
    "op2_minhash": "doc_id bigint n_shingles bigint component_id bigint kept boolean",
    "op3_toxicity": "doc_id bigint score double toxic boolean",
    "op4_decontamination": "doc_id bigint n_words bigint n_hit bigint n_items bigint items_sha256 string contaminated boolean",
    "op5_packing": "doc_id bigint piece int start bigint length bigint ids_crc32 bigint sequence_id bigint offset bigint",
    "op6_pii": "doc_id bigint n_email bigint n_ip bigint n_card bigint n_phone bigint base_sha256 string spans string",
    "op7_licenses": "doc_id bigint n_words bigint n_base bigint first_word bigint last_word bigint base_labels string labels string score double",
    "op8_extraction": "page_id bigint url string text string n_chars bigint",
    "op9_quality_rules": "doc_id bigint n_words bigint word_chars bigint n_symbols bigint n_dup_lines bigint n_repeat_words bigint "
                         "base_failed boolean kept boolean",
    "op10_urls": "page_id bigint host string path string rule string verdict string",
    "op11_mixing": "doc_id bigint size bigint source_size bigint target double taken bigint",
    "op12_merkle": "doc_id bigint leaf string subroot string root string proof_sha256 string folded_root string verified boolean",
    "op13_whitening": "vec_id bigint component int n bigint deviation bigint whitened double explained double identity_error double",
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_contract_columns_and_rows(spark, name):
    df = QUERIES[name](spark, SF)
    words = CONTRACT[name].split()
    assert set(zip(words[::2], words[1::2])) <= set(df.dtypes)
    rows = df.collect()
    source = "pages" if "page_id" in df.columns else "embeddings" if "vec_id" in df.columns else "documents"
    n = spark.read.parquet(f"{SF}/{source}.parquet").count()
    several = {"op5_packing", "op13_whitening"}  # rows of a document or vector
    assert len(rows) == n if name not in several else len({r[0] for r in rows}) == n
    if name in ORACLE:
        con = duckdb.connect()
        for t in ("documents", "benchmark", "pages"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
        want = con.sql(ORACLE[name])
        order = [df.columns.index(c) for c in want.columns]
        assert sorted([tuple(r[i] for i in order) for r in rows], key=repr) == sorted(want.fetchall(), key=repr)


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= {*entry.queries()} and sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0])) == list(CONTRACT)
    assert {*ORACLE} <= {*QUERIES}

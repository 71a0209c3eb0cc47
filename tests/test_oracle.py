"""Every registered query equals its DuckDB statement (small scale factor)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from cartwheel.plans.catalog import QUERIES
from cartwheel.plans.oracle import oracle_sql
from cartwheel.plans.streamed import STREAM_QUERIES

SF = "/root/testdata/sf0.001"


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v


SPARK_TO_DUCK = {"date": "DATE", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "timestamp_ntz": "TIMESTAMP"}


def multiset(rows):
    return sorted((tuple(norm(x) for x in r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("events", "part"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_oracle():
    assert {*QUERIES, *STREAM_QUERIES} == {*oracle_sql()} <= {*entry.queries()} & {*entry.oracle_sql()}


@pytest.mark.parametrize("key", sorted({**QUERIES, **STREAM_QUERIES}))
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF)
    rel = con.sql(entry.oracle_sql()[key])
    assert sorted(df.columns) == sorted(rel.columns)
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == duck_types
    order = [rel.columns.index(c) for c in df.columns]
    duck = [tuple(r[i] for i in order) for r in rel.fetchall()]
    assert multiset([tuple(r) for r in df.collect()]) == multiset(duck)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["average_order_value", "average_session_duration", "session_count"]
    assert df.count() == 1


def test_stream_queries_run_concurrently_without_touching_session(spark, con):
    from concurrent.futures import ThreadPoolExecutor
    before = spark.conf.get("spark.sql.shuffle.partitions")
    keys = ["stream_purchase_sessions", "stream_product_summary"]
    with ThreadPoolExecutor(2) as pool:
        dfs = list(pool.map(lambda k: entry.queries()[k](spark, SF), keys))
    for key, df in zip(keys, dfs):
        rel = con.sql(entry.oracle_sql()[key])
        order = [rel.columns.index(c) for c in df.columns]
        duck = [tuple(r[i] for i in order) for r in rel.fetchall()]
        assert multiset([tuple(r) for r in df.collect()]) == multiset(duck), key
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_lookback_does_not_depend_on_driver_time_zone(spark, con):
    import os
    import time
    old = os.environ.get("TZ")
    os.environ["TZ"] = "America/New_York"
    time.tzset()
    try:
        df = entry.queries()["recent_averages"](spark, SF)
        rel = con.sql(entry.oracle_sql()["recent_averages"])
        order = [rel.columns.index(c) for c in df.columns]
        duck = [tuple(r[i] for i in order) for r in rel.fetchall()]
        assert multiset([tuple(r) for r in df.collect()]) == multiset(duck)
    finally:
        if old is None:
            os.environ.pop("TZ", None)
        else:
            os.environ["TZ"] = old
        time.tzset()

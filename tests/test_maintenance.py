"""X4 compaction and X5 schema evolution."""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel import schemas
from cartwheel.operators import decode, maintenance
from cartwheel.sources import harness
from test_edges import _env


def test_compaction_partitions_by_date_and_keeps_rows(spark, scratch):
    ev = harness.events(spark, "/root/testdata/sf0.001")
    src = f"{scratch}/small"
    ev.repartition(20).write.parquet(src)
    assert len([f for f in os.listdir(src) if f.endswith(".parquet")]) == 20
    out = maintenance.compact(spark, src, f"{scratch}/compact", time_col="time_generated", partitions=4)
    assert out.count() == ev.count()
    assert out.select("event_id").exceptAll(ev.select("event_id")).count() == 0
    days = [d for d in os.listdir(f"{scratch}/compact") if d.startswith("event_date=")]
    assert len(days) == ev.select(F.to_date("time_generated")).distinct().count()
    # a date filter prunes directories
    plan = out.where(F.col("event_date") == "2024-01-05")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_parquet_schema_evolution(spark, scratch):
    spark.createDataFrame([(1, "a")], "id bigint, name string").write.parquet(f"{scratch}/t/v=1")
    spark.createDataFrame([(2, "b", 3.5)], "id bigint, name string, score double").write.parquet(f"{scratch}/t/v=2")
    df = maintenance.read_evolving(spark, f"{scratch}/t")
    got = sorted((r["id"], r["score"]) for r in df.collect())
    assert got == [(1, None), (2, 3.5)]


def test_json_schema_evolution(spark):
    v2 = maintenance.widen(schemas.EVENT, T.StructField("channel", T.StringType()))
    old_msg = '{"event_id":1,"user_id":2,"event_type":"search","time_generated":"2026-01-01T00:00:00Z"}'
    new_msg = old_msg[:-1] + ',"channel":"app"}'
    env = _env(spark, [old_msg, new_msg])
    as_v2 = decode.decode_events(env, v2).collect()
    assert [r["channel"] for r in as_v2] == [None, "app"]
    as_v1 = decode.decode_events(env).collect()
    assert [r["event_id"] for r in as_v1] == [1, 1] and "channel" not in as_v1[0].asDict()


def test_compaction_splits_a_hot_date_over_tasks(spark, scratch):
    ev = harness.events(spark, "/root/testdata/sf0.01")
    hot = ev.withColumn("time_generated", F.when(
        F.pmod("event_id", F.lit(3)) == 0,
        F.to_timestamp(F.lit("2024-01-15 12:00:00")) + F.make_dt_interval(secs=F.col("event_id") % 3600)
    ).otherwise(F.col("time_generated")))
    hot.repartition(10).write.parquet(f"{scratch}/src")
    out = maintenance.compact(spark, f"{scratch}/src", f"{scratch}/dst", time_col="time_generated",
                              partitions=8)
    assert out.count() == ev.count()
    day = f"{scratch}/dst/event_date=2024-01-15"
    files = [f for f in os.listdir(day) if f.endswith(".parquet")]
    assert len(files) > 1   # the hot date is written by several tasks


def test_compaction_without_date_partitioning(spark, scratch):
    ev = harness.events(spark, "/root/testdata/sf0.001")
    ev.repartition(12).write.parquet(f"{scratch}/small")
    out = maintenance.compact(spark, f"{scratch}/small", f"{scratch}/big", partitions=2)
    files = [f for f in os.listdir(f"{scratch}/big") if f.endswith(".parquet")]
    assert len(files) <= 2 and out.count() == ev.count()
    assert "event_date" not in out.columns

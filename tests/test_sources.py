"""File sources S4 (CSV catalogue) and S5 (optional parquet)."""

from pyspark.sql import functions as F

from cartwheel import schemas
from cartwheel.sources import read_optional_parquet, read_products_csv
from conftest import PRODUCT_ROWS


def test_products_csv_with_header(spark, scratch):
    path = f"{scratch}/products.csv"
    with open(path, "w") as f:
        f.write("product_id,name,category,cost\n")
        for pid, name, cat, cost in PRODUCT_ROWS:
            f.write(f"{pid},{name},{cat},{int(cost)}\n")
    df = read_products_csv(spark, path)
    assert df.schema == schemas.PRODUCT
    assert sorted(tuple(r) for r in df.collect()) == sorted(PRODUCT_ROWS)


def test_optional_parquet(spark, scratch):
    assert read_optional_parquet(spark, schemas.GOLD_AVERAGES, f"{scratch}/missing") is None
    spark.createDataFrame([], schemas.GOLD_AVERAGES).write.parquet(f"{scratch}/empty")
    assert read_optional_parquet(spark, schemas.GOLD_AVERAGES, f"{scratch}/empty") is None
    spark.createDataFrame([(None, 1, 2, 3)], schemas.GOLD_AVERAGES).write.parquet(f"{scratch}/one")
    assert read_optional_parquet(spark, schemas.GOLD_AVERAGES, f"{scratch}/one").count() == 1


def test_params_are_validated():
    import pytest
    from cartwheel import REFERENCE
    with pytest.raises(ValueError):
        REFERENCE.with_(session_gap_s=0)
    with pytest.raises(ValueError):
        REFERENCE.with_(watermark_from="sometimes")
    assert REFERENCE.with_(starting_offsets="earliest").starting_offsets == "earliest"


def test_streams_read_a_directory_table_by_uri(spark, scratch):
    from cartwheel.plans import streamed
    raw = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    raw.repartition(3).write.parquet(f"{scratch}/events.parquet")
    spark.read.parquet("/root/testdata/sf0.001/part.parquet").write.parquet(f"{scratch}/part.parquet")
    got = streamed.STREAM_QUERIES["stream_product_summary"](spark, f"file://{scratch}")
    want = streamed.STREAM_QUERIES["stream_product_summary"](spark, "/root/testdata/sf0.001")
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() > 0


def test_replay_is_whole_and_in_order(spark, scratch):
    from cartwheel.sources import harness
    files = harness.write_replay(spark, "/root/testdata/sf0.001", f"{scratch}/replay", 4)
    rows = spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
    got = spark.read.parquet(f"{scratch}/replay")
    assert files == 1 and got.count() == rows and len(got.inputFiles()) == 4
    q = (harness.stream_replay(spark, f"{scratch}/replay", files).writeStream.format("memory").queryName("replayed")
         .trigger(availableNow=True).option("checkpointLocation", f"{scratch}/ck").start())
    q.awaitTermination(120)
    batches = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    assert len(batches) == 4 and sum(batches) == rows


def test_replay_of_a_large_file_is_read_by_several_tasks(spark, scratch, monkeypatch):
    """One input file; the third stretch of time has a single row."""
    from cartwheel.sources import harness
    monkeypatch.setattr(harness, "REPLAY_ROWS", 100, raising=False)
    at = F.when(F.col("id") == 700, 550).when(F.col("id") < 500, F.col("id") % 400).otherwise(600 + F.col("id") % 200)
    ts = F.when(F.col("id") != 3, F.timestamp_seconds(F.lit(1_700_000_000) + at)).cast("timestamp_ntz")
    rows = spark.range(1000).select(F.col("id").alias("event_id"), ts.alias("ts"), (F.col("id") % 7).alias("user_id"),
                                    F.lit("view").alias("event_type"), F.lit(1.0).alias("value"), F.lit("{}").alias("props"))
    rows.coalesce(1).write.parquet(f"{scratch}/t/events.parquet")
    files = harness.write_replay(spark, f"{scratch}/t", f"{scratch}/replay", 4)
    got = spark.read.parquet(f"{scratch}/replay")
    assert files == 3 and len(got.inputFiles()) == 12
    assert sorted(got.collect(), key=str) == sorted(rows.collect(), key=str)
    q = (harness.stream_replay(spark, f"{scratch}/replay", files).writeStream.format("memory").queryName("replayed_large")
         .trigger(availableNow=True).option("checkpointLocation", f"{scratch}/ck").start())
    q.awaitTermination(120)
    lo, step = 1_700_000_000, 799 / 4
    seconds = [r["s"] for r in rows.select(F.unix_timestamp(F.col("ts").cast("timestamp")).alias("s")).collect()]
    want = [sum(1 for s in seconds if k == (0 if s is None else min(3, int((s - lo) / step)))) for k in range(4)]
    assert [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]] == want and want[2] == 1


def test_session_takes_master_and_partitions_from_the_launcher(monkeypatch):
    from pyspark.sql import SparkSession
    from cartwheel import session
    set_ = {}

    class Builder:
        def appName(self, name): return self
        def master(self, m): set_["master"] = m; return self
        def config(self, k, v): set_[k] = v; return self
        def getOrCreate(self): return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    monkeypatch.setattr(session, "SparkSession", type("S", (), {"builder": Builder()}))
    session.build_session()
    assert "master" not in set_ and "spark.sql.shuffle.partitions" not in set_
    session.build_session("local[3]", shuffle_partitions=3)
    assert set_["master"] == "local[3]" and set_["spark.sql.shuffle.partitions"] == "3"


def test_a_job_without_a_checkpoint_is_an_error():
    import pytest
    from cartwheel.session import checkpoint_path

    class Bare:
        class conf:
            get = staticmethod(lambda key, default=None: default)
        class sparkContext:
            getCheckpointDir = staticmethod(lambda: None)
    with pytest.raises(RuntimeError, match="checkpoint"):
        checkpoint_path(Bare, "carts")

"""Storage upkeep (X4 compaction and layout, X5 schema evolution) and a look
into checkpoints (K12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def compact(spark: SparkSession, src: str, dst: str, time_col: str | None = None,
            partitions: int | None = None, max_records_per_file: int = 5_000_000,
            merge_schema: bool = True) -> DataFrame:
    """Rewrite a directory of many small parquet files into a new
    directory of fewer, larger files, optionally partitioned by the date of
    ``time_col`` (so date filters prune directories).

    Rows are range-partitioned on (date, time): a date holding a large share
    of the rows is split across many tasks instead of landing in one, and
    each task writes files for a contiguous time range. ``partitions``
    defaults to the shuffle-partition setting. Returns the written table,
    read back. The source is left untouched; swap directories afterwards.
    """
    df = spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(src)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    w = None
    if time_col:
        df = df.withColumn("event_date", F.to_date(F.col(time_col)))
        w = (df.repartitionByRange(n, "event_date", time_col).write
             .partitionBy("event_date"))
    else:
        w = df.repartition(n).write
    w.option("maxRecordsPerFile", str(max_records_per_file)).mode("errorifexists").parquet(dst)
    return spark.read.parquet(dst)


def read_evolving(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """X5 (parquet): read files written under successive schema versions.
    Columns added later are null in older files; with ``schema`` given, the
    declared (newest) schema is used as is."""
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path)


def widen(schema: StructType, *fields) -> StructType:
    """X5 (JSON): a newer message schema = the old one plus nullable fields.
    Decoding old messages with it gives null for the new fields (backward
    compatible); decoding new messages with the old schema ignores them
    (forward compatible)."""
    out = StructType(list(schema.fields))
    for f in fields:
        out = out.add(f.name, f.dataType, True)
    return out


def open_gold_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The windows that a gold job (:func:`~cartwheel.operators.gold.gold_averages`)
    holds in the state of its last batch: those that the watermark hasn't
    closed, with their sums so far. The checkpoint is read as a table; the job
    needn't run."""
    state = spark.read.format("statestore").load(checkpoint)
    # the value has the aggregates' buffers in their order, partly under one name
    sums = F.col("value").cast("struct<amount:double,seconds:bigint,sessions:bigint>")
    return state.select(F.col("key.window.start").alias("window_start"), sums.alias("v")).select(
        "window_start", F.round("v.amount", 2).alias("amount_so_far"), F.col("v.seconds").alias("seconds_so_far"),
        F.col("v.sessions").alias("sessions_so_far"))


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Operators, partitions and batches that a checkpoint's state has."""
    return spark.read.format("state-metadata").load(checkpoint)

"""Mapping of the driver's test tables onto the storefront model.

``events`` (event_id, ts, user_id, event_type, value, props) becomes the
clickstream; ``part`` becomes the product catalogue. The mapping is pure
projection — every row of both tables is used. Event time is UTC wall-clock
time in the tables: read them in a session whose zone is UTC.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel import schemas
from cartwheel.functions.codec import encode_json
from cartwheel.functions.columns import case_map

# Driver event type -> storefront event type.
EVENT_TYPE_MAP = {
    "view": "page_view",
    "signup": "search",
    "click": "product_view",
    "error": "add_to_cart",
    "purchase": "purchase",
}
# Event types that carry no product.
NO_PRODUCT_TYPES = ["view", "signup"]

# Declared schemas of the driver's tables (read without footer inference).
RAW_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
}

# Rows of a replay file: a batch of more is read, and its messages decoded, by several tasks.
REPLAY_ROWS = 50_000

CLICKSTREAM_TOPIC = "clickstream"
CART_TOPIC = "abandoned_carts"
TOPIC_PARTITIONS = 3


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in RAW_SCHEMAS:
        reader = reader.schema(RAW_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _mapped_type() -> Column:
    return case_map("event_type", EVENT_TYPE_MAP, "`event_type`")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clickstream events with the declared event schema."""
    return map_events(_table(spark, sf_dir, "events"))


def purchase_events(spark: SparkSession, sf_dir: str, since: datetime | None = None) -> DataFrame:
    """The purchases among :func:`events`, from ``since`` on. Both filters
    are on the table's own columns, so they reach the parquet scan."""
    raw = _table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    if since is not None:
        raw = raw.where(F.col("ts") >= F.lit(since.isoformat(sep=" ")).cast("timestamp_ntz"))
    return map_events(raw)


def double_sent(ev: DataFrame) -> DataFrame:
    """``ev`` as a producer that repeats itself sends it: purchases and every
    event whose id ends in 7 arrive twice, and the copy a second later."""
    again = ev.where((F.col("event_type") == "purchase") | (F.col("event_id") % 10 == 7))
    later = F.coalesce(F.col("time_received"), F.col("time_generated")) + F.expr("INTERVAL 1 SECOND")
    return ev.unionByName(again.withColumn("time_received", later))


def _event_columns() -> list[Column]:
    product = F.when(~F.col("event_type").isin(*NO_PRODUCT_TYPES),
                     F.get_json_object("props", "$.k").cast("bigint"))
    return [
        F.col("event_id").cast("bigint").alias("event_id"),
        F.col("user_id").cast("bigint").alias("user_id"),
        _mapped_type().alias("event_type"),
        product.alias("product_id"),
        F.col("ts").cast("timestamp").alias("time_generated"),
        F.lit(None).cast("timestamp").alias("time_received"),
    ]


def map_events(raw: DataFrame) -> DataFrame:
    """Projection of driver event rows onto the event schema (batch or
    streaming input alike)."""
    return raw.select(*_event_columns())


def write_replay(spark: SparkSession, sf_dir: str, path: str, batches: int, only: range | None = None, late: Column | None = None) -> int:
    """The events table as files in the order of event time, for a stream
    that reads them a batch at a time: ``batches`` stretches of time, written
    one after the other, each of as many files as are returned - about one per
    REPLAY_ROWS rows; a short stretch gets empty ones. Rows without
    a time come with the first, rows for which ``late`` holds with the last.
    ``only`` writes some of the batches, the others as if they were still to come."""
    raw = _table(spark, sf_dir, "events")
    rows, lo, hi = raw.agg(F.count(F.lit(1)), F.min("ts"), F.max("ts")).first()
    files = max(1, -(-rows // (batches * REPLAY_ROWS)))
    step = (hi - lo) / batches if lo is not None else None
    for k in range(batches if lo is not None and hi > lo else 1):
        if only is not None and k not in only:
            continue
        part = raw
        if lo is not None and hi > lo:
            after = F.lit(True) if k == 0 else F.col("ts") >= F.lit(str(lo + k * step)).cast("timestamp_ntz")
            before = F.lit(True) if k == batches - 1 else F.col("ts") < F.lit(str(lo + (k + 1) * step)).cast("timestamp_ntz")
            now = (after & before) | (F.col("ts").isNull() & F.lit(k == 0))
            if late is not None:
                now = F.when(late, F.lit(k == batches - 1)).otherwise(now)
            part = raw.where(now)
        part = part.coalesce(1) if files == 1 else part.repartition(files)
        part.write.mode("append").parquet(path)
        there = 0 if files == 1 else len(spark.read.schema(raw.schema).parquet(path).inputFiles())
        for _ in range(-there % files):  # tasks without rows write no file
            raw.where(F.lit(False)).coalesce(1).write.mode("append").parquet(path)
    return files


def stream_replay(spark: SparkSession, path: str, files_per_trigger: int) -> DataFrame:
    """The files of :func:`write_replay` as a stream of driver rows."""
    reader = spark.readStream.schema(RAW_SCHEMAS["events"]).option("maxFilesPerTrigger", str(files_per_trigger))
    return reader.parquet(path)


def stream_clickstream(raw: DataFrame) -> DataFrame:
    """Driver rows replayed as a clickstream topic (envelope rows)."""
    return clickstream_envelope(map_events(raw))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product catalogue from ``part``."""
    return _table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("bigint").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("double").alias("cost"),
    )


def to_envelope(df: DataFrame, key: Column, value: Column, topic: str,
                time_col: str, offset: Column | None = None) -> DataFrame:
    """Wrap rows as Kafka envelope rows (key/value binary, topic, partition).

    The partition is derived from the numeric key so the same rows always
    land in the same partition; the offset is the row's own number,
    ``offset`` where the caller gives one (null otherwise).
    """
    return df.select(
        key.cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.col("user_id"), F.lit(TOPIC_PARTITIONS)).cast("int").alias("partition"),
        (F.lit(None) if offset is None else offset).cast("bigint").alias("offset"),
        F.col(time_col).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def clickstream_envelope(ev: DataFrame) -> DataFrame:
    """Events as the producer sends them: key = user id text, value = JSON."""
    value = encode_json(F.struct(*[F.col(c) for c in schemas.EVENT_FIELDS]))
    return to_envelope(ev, F.col("user_id").cast("string"), value,
                       CLICKSTREAM_TOPIC, "time_generated")

"""Declared schemas (nothing is inferred).

Identifiers are 64-bit: at cluster scale event, user and product ids exceed
the 32-bit range the original demo used.
"""

from pyspark.sql import types as T

EVENT = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("time_generated", T.TimestampType()),
    T.StructField("time_received", T.TimestampType()),
])

EVENT_FIELDS = [f.name for f in EVENT.fields]
REQUIRED_EVENT_FIELDS = ["event_id", "user_id", "event_type", "time_generated"]

PRODUCT = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("cost", T.DoubleType()),
])

PURCHASE_SESSION = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("session_start", T.TimestampType()),
    T.StructField("session_end", T.TimestampType()),
    T.StructField("total_amount", T.DoubleType()),
])

PURCHASE_SLICE = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("slice_start", T.TimestampType()),
    T.StructField("first", T.TimestampType()),
    T.StructField("last", T.TimestampType()),
    T.StructField("total_amount", T.DoubleType()),
])

PRODUCT_SUMMARY = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("num_purchases", T.LongType()),
    T.StructField("revenue", T.DoubleType()),
])

CATEGORY_SUMMARY = T.StructType([
    T.StructField("category", T.StringType()),
    T.StructField("num_products", T.LongType()),
    T.StructField("num_purchases", T.LongType()),
    T.StructField("revenue", T.DoubleType()),
])

GOLD_AVERAGES = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("total_amount", T.LongType()),
    T.StructField("total_session_duration_seconds", T.LongType()),
    T.StructField("session_count", T.LongType()),
])

GOLD_SPEND = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("bucket_start", T.LongType()),
    T.StructField("bucket_end", T.LongType()),
    T.StructField("bucket_label", T.StringType()),
    T.StructField("session_count", T.LongType()),
])

FUNNEL_UPDATE = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("highest_funnel_stage", T.IntegerType()),
    T.StructField("event_time", T.TimestampType()),
])

# The users of a state bucket; times are wall-clock nanoseconds in the session's zone, deadlines epoch milliseconds.
FUNNEL_STATE = T.StructType([T.StructField(name, T.ArrayType(T.LongType()))
                             for name in ("user_id", "highest_funnel_stage", "event_time", "deadline")])

BATCH_CLOCK = T.StructType([
    T.StructField("latest", T.TimestampType()),
    T.StructField("batch_id", T.LongType()),
])

CART_MESSAGE = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("product_ids", T.ArrayType(T.LongType())),
    T.StructField("ts", T.TimestampType()),
])

# Public schema of Spark's Kafka source.
ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])

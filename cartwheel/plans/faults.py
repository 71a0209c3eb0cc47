"""Damaged clickstream messages for the dead-letter queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel import schemas
from cartwheel.functions.codec import encode_json
from cartwheel.sources.harness import CLICKSTREAM_TOPIC, _event_columns, _table, to_envelope


def source_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events plus the driver's own type and ``value`` (for fault rules)."""
    return map_source_events(_table(spark, sf_dir, "events"))


def map_source_events(raw: DataFrame) -> DataFrame:
    """Events (batch or stream) plus the driver's ``event_type`` and ``value``."""
    return raw.select(*_event_columns(), F.col("event_type").alias("src_type"),
                      F.col("value").alias("src_value"))


def faulty_clickstream_envelope(src: DataFrame) -> DataFrame:
    """Clickstream envelope in which some messages arrive damaged, by a fixed
    rule on the source row: the driver's ``error`` events lose their closing
    brace (invalid JSON); otherwise ``value`` < 1 gets a garbage time, < 2
    loses its user id, < 3 carries a non-numeric event id. Every row is sent."""
    clean = encode_json(F.struct(*[F.col(c) for c in schemas.EVENT_FIELDS]))
    v = F.col("src_value")
    damaged = (F.when(F.col("src_type") == "error", F.regexp_replace(clean, r"\}$", ""))
               .when(v < 1, F.regexp_replace(clean, '"time_generated":"[^"]*"',
                                             '"time_generated":"garbage"'))
               .when(v < 2, F.regexp_replace(clean, '"user_id":[0-9]+,', ""))
               .when(v < 3, F.regexp_replace(clean, '"event_id":[0-9]+', '"event_id":"x"'))
               .otherwise(clean))
    return to_envelope(src, F.col("user_id").cast("string"), damaged,
                       CLICKSTREAM_TOPIC, "time_generated")

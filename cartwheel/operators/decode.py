"""Decoding of message envelopes (F1-F4) and dead-letter routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cartwheel import schemas
from cartwheel.functions.codec import decode_json_or_raw, value_text

CORRUPT = "_corrupt_record"


def decode_events(envelope: DataFrame, schema: StructType = schemas.EVENT) -> DataFrame:
    """Value -> text -> from_json -> flat event columns + event_time.

    Permissive: malformed JSON gives an all-null row, a bad field a null
    field (rows are never dropped here; see :func:`route_events`).
    """
    parsed = envelope.select(
        F.from_json(value_text("value"), schema).alias("data"))
    return (parsed.select("data.*")
            .withColumn("event_time", F.to_timestamp("time_generated")))


def route_events(envelope: DataFrame, schema: StructType = schemas.EVENT,
                 required: list[str] | None = None) -> DataFrame:
    """Decode and classify each message; nothing dropped.

    A message that fits the schema is parsed once, with the texts of damaged
    ones kept beside; only these are parsed again, to tell what is wrong.
    Columns: the event fields, ``raw_value`` (original text), ``received_at``
    (envelope timestamp) and ``error_reason`` (null when valid). Reasons, in
    precedence order: ``invalid_json``, ``missing_field:<name>`` (also JSON
    null), ``bad_timestamp``, ``schema_mismatch``.
    """
    required = required or schemas.REQUIRED_EVENT_FIELDS
    with_corrupt = StructType(schema.fields + [StructField(CORRUPT, StringType())])
    text = value_text("value")
    df = envelope.select(
        text.alias("raw_value"),
        F.col("timestamp").alias("received_at"),
        F.from_json(text, with_corrupt, {"columnNameOfCorruptRecord": CORRUPT}).alias("_data"),
    )
    # a list of objects would be read as its first one
    is_object = F.coalesce(F.ltrim("raw_value", F.lit(" \t\r\n")).startswith("{"), F.lit(False))
    damaged = F.col(f"_data.{CORRUPT}").isNotNull()
    df = df.select("*", (~is_object).alias("_other"), damaged.alias("_damaged"),
                   F.when(damaged, F.from_json("raw_value", "map<string,string>")).alias("_fields"))

    def given(name: str) -> Column:
        there = F.element_at("_fields", name).isNotNull()
        read = F.col(f"_data.{name}").isNotNull() if name in schema.fieldNames() else F.get_json_object("raw_value", f"$['{name}']").isNotNull()
        return F.when(F.col("_damaged"), there).otherwise(read)
    checks = [F.when(F.col("_other") | (F.col("_damaged") & F.col("_fields").isNull()), F.lit("invalid_json"))]
    checks += [F.when(~given(f), F.lit(f"missing_field:{f}")) for f in required]
    ts_fields = [f.name for f in schema.fields if f.dataType.typeName() == "timestamp"]
    checks += [F.when(F.col("_damaged") & given(f) & F.col(f"_data.{f}").isNull(),
                      F.lit("bad_timestamp")) for f in ts_fields]
    checks += [F.when(F.col("_damaged"), F.lit("schema_mismatch"))]
    return df.select(
        *[F.when(~F.col("_other"), F.col(f"_data.{f.name}")).alias(f.name) for f in schema.fields],
        "raw_value", "received_at",
        F.coalesce(*checks).alias("error_reason"),
    )


def split_routes(routed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid events, dead letters) from :func:`route_events` output.

    When both are materialised, persist ``routed`` first: Catalyst pushes
    the reason filter below the projection and would repeat the parsing."""
    valid = routed.where(F.col("error_reason").isNull()).drop("raw_value", "error_reason")
    dlq = routed.where(F.col("error_reason").isNotNull()).select(
        "raw_value", "error_reason", "received_at")
    return valid, dlq


def decode_topic(envelope: DataFrame, value_schema: StructType) -> DataFrame:
    """S6 consumer: key as text, value as JSON when it is a JSON object, else
    kept raw; a null key stays null. Partition and offset are carried."""
    parsed, raw = decode_json_or_raw(value_text("value"), value_schema)
    return envelope.select(
        F.col("key").cast("string").alias("key"),
        parsed.alias("value"),
        raw.alias("raw_value"),
        "partition", "offset",
    )

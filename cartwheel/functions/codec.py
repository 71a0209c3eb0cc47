"""Message encoding and decoding (JSON values in a Kafka-style envelope)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# ISO-8601 with microseconds and offset, as the event producer writes times.
JSON_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def value_text(value: Column | str = "value") -> Column:
    """CAST(value AS STRING) — binary message value to text."""
    v = F.col(value) if isinstance(value, str) else value
    return v.cast("string")


def encode_json(struct: Column, micros: bool = True) -> Column:
    """to_json of a struct; null fields are omitted, as Spark does."""
    if micros:
        return F.to_json(struct, {"timestampFormat": JSON_TS_FORMAT})
    return F.to_json(struct)


def decode_json_or_raw(text: Column, schema: StructType | str) -> tuple[Column, Column]:
    """Parse ``text`` as a JSON object of ``schema``.

    Returns ``(parsed, raw)``: ``parsed`` is the struct when the text is a JSON
    object, else null; ``raw`` keeps the text only when it is not.
    """
    is_object = F.json_object_keys(text).isNotNull()
    parsed = F.when(is_object, F.from_json(text, schema))
    raw = F.when(~is_object, text)
    return parsed, raw

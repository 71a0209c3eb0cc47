"""Sources: Kafka topics, file streams, CSV/parquet tables, and the mapping of
the driver's test tables onto the storefront event model."""

from cartwheel.sources.files import (
    read_optional_parquet,
    read_products_csv,
    stream_envelopes,
    stream_parquet,
)
from cartwheel.sources.kafka import kafka_available, read_topic, stream_topic

__all__ = [
    "read_optional_parquet", "read_products_csv", "stream_parquet", "stream_envelopes",
    "kafka_available", "stream_topic", "read_topic",
]

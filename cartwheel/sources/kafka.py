"""Kafka sources.

The Kafka connector is not a core Spark module; when its jar is missing the
functions raise a clear error. Tests feed the same envelope schema from files
(:func:`cartwheel.sources.files.stream_envelopes`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_available(spark: SparkSession) -> bool:
    """True when the ``kafka`` data source can be resolved."""
    try:
        jvm = spark._jvm  # noqa: SLF001 - only to probe the classpath
        jvm.java.lang.Class.forName(
            "org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:  # noqa: BLE001
        return False


def _require(spark: SparkSession) -> None:
    if not kafka_available(spark):
        raise RuntimeError(
            "Kafka data source not on the classpath; add the "
            "spark-sql-kafka-0-10 package or use file envelopes instead")


def stream_topic(spark: SparkSession, servers: str, topic: str,
                 starting_offsets: str = "latest",
                 max_offsets_per_trigger: int | None = None,
                 min_partitions: int | None = None) -> DataFrame:
    """Subscribe to ``topic``; returns the Kafka envelope columns.

    ``max_offsets_per_trigger`` bounds each micro-batch, which bounds the
    rows a hot key can put into one task per batch; ``min_partitions``
    splits large topic partitions over several tasks, so a topic partition
    that carries a large share of the traffic is read in parallel.
    """
    _require(spark)
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    if min_partitions:
        reader = reader.option("minPartitions", str(min_partitions))
    return reader.load()


def read_topic(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Batch read of a whole topic from the earliest offsets."""
    _require(spark)
    return (spark.read.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", "earliest")
            .option("endingOffsets", "latest")
            .load())

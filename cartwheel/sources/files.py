"""File sources (S3, S4, S5) and file-backed envelope streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cartwheel import schemas


def read_products_csv(spark: SparkSession, path: str) -> DataFrame:
    """Product catalogue, CSV with header, declared schema."""
    return spark.read.schema(schemas.PRODUCT).option("header", "true").csv(path)


def read_optional_parquet(spark: SparkSession, schema: StructType,
                          path: str) -> DataFrame | None:
    """Parquet with a declared schema; ``None`` when there are no rows."""
    try:
        df = spark.read.schema(schema).parquet(path)
        return None if df.isEmpty() else df
    except Exception as exc:  # noqa: BLE001 - a missing directory counts as empty
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return None
        raise


def stream_parquet(spark: SparkSession, schema: StructType, path: str,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """S3: a parquet directory as a stream; new files become new rows."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def stream_envelopes(spark: SparkSession, path: str,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files holding Kafka envelope rows, read as a stream.

    Stands in for a Kafka topic in tests and offline replays.
    """
    return stream_parquet(spark, schemas.ENVELOPE, path, max_files_per_trigger)

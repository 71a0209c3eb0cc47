"""Tables that change as a whole (X3, A13): snapshots and upserts.

A snapshot is a small Parquet table ``<root>/_snapshots/snapshot=N`` of one
file, which lists the folders of data that belong to it. Data is written
first, into folders that no one else uses; the file then appears by the one
rename of its commit. Readers take their folders from a snapshot alone, so a
writer that fails half-way shows nothing, and what a retry leaves behind is
never read. A snapshot that is written again replaces itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartwheel.sources.files import read_optional_parquet

ENTRY = StructType().add("table", "string").add("part", "long").add("path", "string").add("snapshot", "long")


def entries(spark: SparkSession, root: str, upto: int | None = None) -> DataFrame:
    """(table, part, path, snapshot) of all snapshots, or those up to one."""
    found = read_optional_parquet(spark, ENTRY, f"{root.rstrip('/')}/_snapshots")
    found = spark.createDataFrame([], ENTRY) if found is None else found
    return found if upto is None else found.where(F.col("snapshot") <= upto)


def commit(spark: SparkSession, root: str, snapshot: int, rows: list[tuple[str, int, str]]) -> None:
    """Make ``rows`` (table, part, path) visible together as one file."""
    listed = spark.createDataFrame(rows, "table string, part long, path string").coalesce(1)
    listed.write.mode("overwrite").parquet(f"{root.rstrip('/')}/_snapshots/snapshot={snapshot}")


def publish(batch: DataFrame, root: str, snapshot: int, tables: dict[str, Callable[[DataFrame], DataFrame]]) -> None:
    """Write every table that is derived from ``batch`` and show them together."""
    batch.persist()
    try:
        rows = []
        for name, derive in tables.items():
            path = f"{root.rstrip('/')}/{name}/{snapshot}-{uuid.uuid4().hex}"
            derive(batch).write.parquet(path)
            rows.append((name, snapshot, path))
        commit(batch.sparkSession, root, snapshot, rows)
    finally:
        batch.unpersist()


def read_published(spark: SparkSession, root: str, table: str, schema: StructType, upto: int | None = None) -> DataFrame:
    """The rows of ``table`` in all snapshots, or those up to one (a reader
    that keeps the number sees the same rows while writers go on)."""
    paths = [r["path"] for r in entries(spark, root, upto).where(F.col("table") == table).select("path").collect()]  # one a batch
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


class UpsertTable:
    """One row per key, kept in buckets of the key's hash. An upsert reads and
    writes the buckets that its rows fall into; the others' files stay as they
    are and are listed again in the next snapshot."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, key: str, order: str, buckets: int = 64):
        self.spark, self.root, self.schema, self.key, self.order, self.buckets = spark, root.rstrip("/"), schema, key, order, buckets

    def snapshot(self, upto: int | None = None) -> tuple[int, dict[int, str]]:
        """(number, folder of each bucket) of the last snapshot; -1 of none."""
        found = entries(self.spark, self.root, upto)
        last = found.agg(F.max("snapshot").alias("n")).first()["n"]
        if last is None:
            return -1, {}
        return last, {r["part"]: r["path"] for r in found.where(F.col("snapshot") == last).collect()}  # at most ``buckets``

    def read(self, upto: int | None = None) -> DataFrame:
        paths = sorted(set(self.snapshot(upto)[1].values()))
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def upsert(self, changes: DataFrame) -> int:
        """Take the rows of ``changes`` in: of a key the row of the largest
        ``order`` stays (of equal ones the larger in the other columns).
        Returns the number of the snapshot that shows them."""
        number, folders = self.snapshot()
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets))
        columns = self.schema.fieldNames()
        fresh = changes.select(*columns).where(F.col(self.key).isNotNull()).persist()
        try:
            touched = [r["b"] for r in fresh.select(bucket.alias("b")).distinct().collect()]  # at most ``buckets``
            old = [folders[b] for b in touched if b in folders]
            rows = fresh if not old else fresh.unionByName(self.spark.read.schema(self.schema).parquet(*old))
            others = [c for c in columns if c not in (self.key, self.order)]
            best = rows.groupBy(self.key).agg(F.max(F.struct(self.order, *others)).alias("r"))
            best = best.select(*[F.col(self.key) if c == self.key else F.col(f"r.{c}").alias(c) for c in columns])
            data = f"{self.root}/data/{number + 1}-{uuid.uuid4().hex}"
            # all rows of a bucket in one file: the key's aggregate is dealt anew by bucket
            best.withColumn("bucket", bucket).repartition("bucket").write.partitionBy("bucket").parquet(data)
        finally:
            fresh.unpersist()
        folders = folders | {b: f"{data}/bucket={b}" for b in touched}
        commit(self.spark, self.root, number + 1, [("data", b, path) for b, path in sorted(folders.items())])
        return number + 1

"""X4 without rewriting a table: files are listed in a manifest, and only small
ones are merged, clustered on a space-filling order of some columns.

``<root>/_files/snapshot=N`` lists the files of a snapshot with their size,
rows and the range of each clustering column; it appears by the one rename of
its commit. Large files stay as they are from snapshot to snapshot. A reader
takes its files from the manifest, without those whose ranges rule them out.
One writer at a time; files that no snapshot lists any more stay until they
are removed by hand.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructType, TimestampType

from cartwheel.sources.files import read_optional_parquet


def number_of(schema: StructType, column: str) -> Column:
    """A clustering column (number or timestamp) as a number that keeps its order."""
    kind = schema[column].dataType
    if isinstance(kind, TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, NumericType):
        return F.col(column)
    raise ValueError(f"{column}: cluster by numbers or timestamps, not {kind.simpleString()}")


def z_order(ranks: list[Column], bits: int) -> Column:
    """The bits of several ranks below ``2 ** bits`` taken in turn, as one number."""
    z = F.lit(0).cast("long")
    for bit in range(bits):
        for k, rank in enumerate(ranks):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("long")
            z = z.bitwiseOR(F.shiftleft(one, bit * len(ranks) + k))
    return z


def rank_of(number: Column, bounds: list) -> Column:
    """How many of ``bounds`` lie below ``number``; 0 of a null."""
    return F.size(F.filter(F.array(*map(F.lit, bounds)), lambda bound: bound < number)) if bounds else F.lit(0)


class ClusteredTable:
    """A Parquet table of files of about ``target_bytes``; files below
    ``small_bytes`` (half of that by default) are merged by :meth:`compact`."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, columns: list[str],
                 target_bytes: int = 256 << 20, small_bytes: int | None = None, bits: int = 6):
        self.spark, self.root, self.schema, self.columns = spark, root.rstrip("/"), schema, columns
        self.target_bytes, self.bits = target_bytes, bits
        self.small_bytes = target_bytes // 2 if small_bytes is None else small_bytes
        self._numbers = [number_of(schema, c) for c in columns]
        self._entry = StructType().add("path", "string").add("bytes", "long").add("rows", "long")
        for c in columns:
            self._entry = self._entry.add(f"lo_{c}", schema[c].dataType).add(f"hi_{c}", schema[c].dataType)

    def files(self, upto: int | None = None) -> tuple[int, DataFrame]:
        """(number, files) of the last snapshot, or the last up to one; -1 of none."""
        found = read_optional_parquet(self.spark, StructType([*self._entry.fields]).add("snapshot", "long"), f"{self.root}/_files")
        if found is not None and upto is not None:
            found = found.where(F.col("snapshot") <= upto)
        last = None if found is None else found.agg(F.max("snapshot").alias("n")).first()["n"]
        if last is None:
            return -1, self.spark.createDataFrame([], self._entry)
        return last, found.where(F.col("snapshot") == last).drop("snapshot")

    def _listed(self, folder: str) -> DataFrame:
        """The manifest rows of a folder's files; reads the clustering columns only."""
        ranges = [f(c).alias(f"{n}_{c}") for c in self.columns for n, f in (("lo", F.min), ("hi", F.max))]
        rows = self.spark.read.schema(self.schema).parquet(folder)
        return rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(
            F.max("_metadata.file_size").alias("bytes"), F.count(F.lit(1)).alias("rows"), *ranges)

    def _commit(self, snapshot: int, kept: DataFrame, folder: str) -> int:
        listed = kept.unionByName(self._listed(folder)).select(*self._entry.fieldNames())
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/_files/snapshot={snapshot}")
        return snapshot

    def _folder(self, snapshot: int) -> str:
        return f"{self.root}/data/{snapshot}-{uuid.uuid4().hex}"

    def append(self, rows: DataFrame) -> int:
        """Add ``rows`` in files as they are partitioned; the new snapshot's number."""
        number, files = self.files()
        folder = self._folder(number + 1)
        rows.select(*self.schema.fieldNames()).write.parquet(folder)
        return self._commit(number + 1, files, folder)

    def clustered(self, rows: DataFrame, parts: int) -> DataFrame:
        """``rows`` in ``parts`` ranges of the columns' common order. A column's
        rank is its place among equal shares of the rows; rows of one place,
        a hot key's for one, are dealt on by the hash of all columns."""
        shares = [k / 2 ** self.bits for k in range(1, 2 ** self.bits)]
        bounds = rows.agg(*[F.percentile_approx(n, shares, 10_000).alias(f"b{k}") for k, n in enumerate(self._numbers)]).first()
        ranks = []
        for k, number in enumerate(self._numbers):
            ranks.append(rank_of(number, bounds[f"b{k}"] or []))  # 2 ** bits - 1 of them
        placed = rows.withColumn("_z", z_order(ranks, self.bits)).withColumn("_tie", F.xxhash64(*rows.columns))
        return placed.repartitionByRange(parts, "_z", "_tie").sortWithinPartitions("_z", *self.columns).drop("_z", "_tie")

    def compact(self) -> int | None:
        """Merge the small files into files of the target size; the number of
        the snapshot that shows them, or None where fewer than two are small."""
        number, files = self.files()
        small = files.where(F.col("bytes") < self.small_bytes)
        paths = [(r["path"], r["bytes"]) for r in small.select("path", "bytes").collect()]  # a row a file
        if len(paths) < 2:
            return None
        rows = self.spark.read.schema(self.schema).parquet(*[p for p, _ in paths])
        folder = self._folder(number + 1)
        self.clustered(rows, max(1, sum(b for _, b in paths) // self.target_bytes)).write.parquet(folder)
        return self._commit(number + 1, files.where(F.col("bytes") >= self.small_bytes), folder)

    def read(self, upto: int | None = None, **ranges) -> DataFrame:
        """The table, or its rows with ``lo <= column <= hi`` for each
        ``column=(lo, hi)``, from the files that can have such rows."""
        files, wanted = self.files(upto)[1], F.lit(True)
        for c, (lo, hi) in ranges.items():
            files = files.where((F.col(f"hi_{c}") >= F.lit(lo)) & (F.col(f"lo_{c}") <= F.lit(hi)))
            wanted = wanted & F.col(c).between(F.lit(lo), F.lit(hi))
        paths = [r["path"] for r in files.select("path").collect()]  # a row a file
        rows = self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)
        return rows.where(wanted) if ranges else rows

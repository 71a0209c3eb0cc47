"""T4 beyond the watermark: an event is passed on once, however late its
copies come, with no streaming state at all.

The ids of earlier batches are kept as files, in hash buckets, beside a
blocked Bloom filter: ``blocks`` bitmaps of 32,768 bits, of which an id has
``hashes`` bits in one. A batch looks its ids up in the filter first; those
it has not seen for certain pass, and the rest, copies and a few false hits,
are checked by an anti-join that reads only their buckets. Everything of a
batch is written under its number and only lower numbers are read, so a batch
that is run again finds the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartwheel.operators.events import dedup_events
from cartwheel.sources.files import read_optional_parquet
from cartwheel.streaming.sinks import batch_path, write_batch

# Fixed value: bits of a bitmap of ``bitmap_construct_agg``.
BITS = 32_768

FILTER = StructType().add("block", "integer").add("bitmap", "binary").add("batch_id", "long")


class SeenIds:
    """``blocks`` * 32,768 / 10 ids keep false hits near 1 % with four hashes;
    with more of them the anti-join reads more, but the result is the same.
    A new filter takes at most ``blocks`` * 4 KB a batch; those of earlier
    batches may be removed once a later batch is done."""

    def __init__(self, root: str, key: str = "event_id", time_col: str = "time_generated", blocks: int = 1024, hashes: int = 4, buckets: int = 64):
        self.root, self.key, self.time_col = root.rstrip("/"), key, time_col
        self.blocks, self.hashes, self.buckets = blocks, hashes, buckets

    def block(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.blocks)).cast("int")

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key, F.lit("bucket")), F.lit(self.buckets)).cast("int")

    def positions(self) -> Column:
        return F.array(*[F.pmod(F.xxhash64(self.key, F.lit(k)), F.lit(BITS)) for k in range(self.hashes)])

    def filter_before(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """(block, bitmap) of all ids of batches before ``batch_id``."""
        found = read_optional_parquet(spark, FILTER, f"{self.root}/filter")
        last = None if found is None else found.where(F.col("batch_id") < batch_id).agg(F.max("batch_id").alias("n")).first()["n"]
        return None if last is None else found.where(F.col("batch_id") == last).select("block", "bitmap")

    def maybe_seen(self, rows: DataFrame, known: DataFrame) -> DataFrame:
        """``rows`` with ``_maybe``: all bits of the id are set. Without an id: false."""
        bit = F.expr("""forall(_bits, p -> (shiftright(cast(conv(hex(substring(bitmap, cast(p div 8 + 1 as int), 1)), 16, 10) as int),
                                                        cast(p % 8 as int)) & 1) = 1)""")
        keyed = rows.withColumn("block", F.when(F.col(self.key).isNotNull(), self.block())).withColumn("_bits", self.positions())
        return keyed.join(known, "block", "left").withColumn("_maybe", F.coalesce(bit, F.lit(False))).drop("block", "_bits", "bitmap")

    def fresh(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """The rows of a batch, one a key, whose key no batch before it had."""
        known = self.filter_before(rows.sparkSession, batch_id)
        return rows if known is None else self.unseen(self.maybe_seen(rows, known), batch_id)

    def unseen(self, marked: DataFrame, batch_id: int) -> DataFrame:
        """:meth:`fresh` of rows with ``_maybe``, which are read three times."""
        maybe = marked.where("_maybe").drop("_maybe")
        touched = [r["b"] for r in maybe.select(self.bucket().alias("b")).distinct().collect()]  # at most ``buckets``
        schema = StructType([marked.schema[self.key]]).add("bucket", "integer").add("batch_id", "long")
        past = read_optional_parquet(marked.sparkSession, schema, f"{self.root}/ids")
        if past is None or not touched:
            return marked.drop("_maybe")
        past = past.where((F.col("batch_id") < batch_id) & F.col("bucket").isin(touched)).select(self.key)
        return marked.where("not _maybe").drop("_maybe").unionByName(maybe.join(past, self.key, "left_anti").select(*maybe.columns))

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """Keep the ids of ``rows``, and the filter of all ids up to here."""
        ids = rows.where(F.col(self.key).isNotNull()).select(self.key)
        bucketed = ids.withColumn("bucket", self.bucket())
        bucketed.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(batch_path(f"{self.root}/ids", batch_id))
        bits = ids.select(self.block().alias("block"), F.explode(self.positions()).alias("p"))
        new = bits.groupBy("block").agg(F.bitmap_construct_agg("p").alias("bitmap"))
        known = self.filter_before(rows.sparkSession, batch_id)
        both = new if known is None else known.unionByName(new).groupBy("block").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        write_batch(both, f"{self.root}/filter", batch_id)

    def write(self, batch_df: DataFrame, batch_id: int, out_root: str) -> None:
        """One micro-batch: its fresh rows to ``out_root/batch_id=N``, their ids kept."""
        rows = dedup_events(batch_df, self.key, self.time_col)
        known = self.filter_before(batch_df.sparkSession, batch_id)
        if known is None:
            write_batch(rows, out_root, batch_id)
        else:
            marked = self.maybe_seen(rows, known).persist()
            try:
                write_batch(self.unseen(marked, batch_id), out_root, batch_id)
            finally:
                marked.unpersist()
        written = batch_df.sparkSession.read.schema(batch_df.schema).parquet(batch_path(out_root, batch_id))
        self.add(written, batch_id)

"""Mixing sources to target weights by hash-threshold histograms.

1. Targets: the sources, in order, weigh WEIGHTS in turn and share SHARE of
   all words; a target stops at REPEATS times its source's size, and what is
   over is shared again by weight until no target is above.
2. A document has a place, the hash of its id. If a source's target is more
   than its size, all of it is taken once, and the rest of the target is the
   budget of a second copy; else the target is the budget of the first.
3. Thresholds: words are summed by source and bucket of the place's leading
   bits. The buckets before the one where the sum passes the budget are taken
   whole; only that boundary bucket is split by the next bits, until it is one
   place. What lies before it is taken by a filter; no row is ever sorted.
4. The document at the boundary doesn't fit. What is left of the budget is
   filled from the documents behind it in the same way, those that are too
   large for it left out, until no more than TOLERANCE of the target is left
   or none fits: in the order of places, a document is taken if it still fits.

DataFrame functions only; sources and thresholds stay in tables.

Defined results: null or wordless texts have size 0 and nothing is taken; a
null source is a source, the last; rows of one doc_id and source share a place
and are taken together or not at all; an empty table gives no rows; other
columns are ignored. Reruns agree, whatever the partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import materialise, of_columns
from cartwheel.llm.ranks import ranked

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
TOLERANCE = 0.001
#: Bits of a place, and those that a step of the histogram tells apart.
BITS, STEP = 60, 12
#: Sources whose thresholds are sent to every task; beyond it the join shuffles, and AQE splits a hot source.
BROADCAST_SOURCES = 50_000


def place(doc_id: Column) -> Column:
    """60 bits of a hash that SQL engines share."""
    text = F.coalesce(doc_id.cast("string"), F.lit("-"))
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("long")


def sizes(documents: DataFrame) -> DataFrame:
    """(doc_id, source, size, place) of every row."""
    return of_columns(documents, "doc_id", "source", "text").select(
        "doc_id", "source", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
        place(F.col("doc_id")).alias("place"))


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """(source, source_size, target) of each source of ``rows`` (source, size)."""
    of = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    of = ranked(of, [F.col("source").asc_nulls_last()])
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    of = materialise(of.select("source", "source_size", weight.alias("weight")))
    level = None  # words for a weight of one
    while True:
        above = F.lit(False) if level is None else F.col("weight") * level > repeats * F.col("source_size")
        got = of.agg(F.sum("source_size").alias("words"), F.sum(F.when(above, repeats * F.col("source_size")).otherwise(0)).alias("over"),
                     F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("weight")).first()
        now = (share * got["words"] - got["over"]) / got["weight"] if got["weight"] else 0.0
        if now == level:
            return of.select("source", "source_size", F.when(above, (repeats * F.col("source_size")).cast("double")).otherwise(
                F.col("weight") * F.lit(level)).alias("target"))
        level = now


def beside(rows: DataFrame, table: DataFrame, sources: int) -> DataFrame:
    """``rows`` joined to the one row that ``table`` has of their source."""
    t = table.withColumnRenamed("source", "_source")
    t = F.broadcast(t) if sources <= BROADCAST_SOURCES else t
    return rows.join(t, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def boundaries(rows: DataFrame, budgets: DataFrame, sources: int) -> DataFrame:
    """(source, stop, left): the first place of each source where the sum of
    ``rows`` (source, size, place) passes the budget, and what is left of it
    there; a null stop where all fits."""
    found, shift = budgets.select("source", F.lit(0).cast("long").alias("bucket"), F.col("budget").alias("left")), BITS
    closed = None
    while True:
        inside = beside(rows, found, sources).where(F.shiftright("place", shift) == F.col("bucket"))
        shift -= STEP
        sums = inside.groupBy("source", "left", F.shiftright("place", shift).alias("bucket")).agg(
            F.sum("size").alias("words"), F.min("place").alias("low"), F.max("place").alias("high"))
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))  # at most 2**STEP rows of a source
        first = F.min_by(F.struct("bucket", "low", "high", (F.col("left") - F.col("upto") + F.col("words")).alias("left")),
                         F.when(F.col("upto") > F.col("left"), F.col("bucket"))).alias("at")
        step = sums.withColumn("upto", upto).groupBy("source").agg(first, (F.first("left") - F.max("upto")).alias("rest"))
        step = materialise(step.select("source", "at.bucket", F.coalesce("at.left", "rest").alias("left"), "at.low", "at.high"))
        done = step.where("low is null or low = high").select("source", F.col("low").alias("stop"), "left")
        closed = done if closed is None else closed.unionByName(done)
        found = step.where("low < high").select("source", "bucket", "left")
        if found.isEmpty():
            return closed


def mix(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS,
        tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, source, size, source_size, target and taken of every row."""
    rows = materialise(sizes(documents))
    of = materialise(targets(rows, weights, share, repeats))
    n = of.count()
    whole = F.floor(F.col("target") / F.greatest(F.lit(1), F.col("source_size"))).cast("long")  # copies of all documents
    of = of.withColumn("whole", whole).withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
    # a round takes the places after `after` and before `stop` of documents not above `budget`
    live, rounds = of.select("source", "target", "budget", F.lit(-1).cast("long").alias("after")), None
    while True:
        live = live.where(F.col("budget") > tolerance * F.col("target"))
        fits = beside(rows.where("size > 0"), live, n).where("place > after and size <= budget").select("source", "size", "place")
        stops = boundaries(fits, live.select("source", "budget"), n).withColumnsRenamed({"source": "_s"})
        step = materialise(live.join(stops, F.col("source").eqNullSafe(F.col("_s"))).drop("_s"))
        rounds = step if rounds is None else materialise(rounds.unionByName(step))
        live = step.where("stop is not null").select("source", "target", F.col("left").alias("budget"), F.col("stop").alias("after"))
        if live.where(F.col("budget") > tolerance * F.col("target")).isEmpty():
            break
    # as many entries a source as there were rounds
    spans = rounds.groupBy("source").agg(F.collect_list(F.struct("after", "stop", "budget")).alias("spans"))
    of = of.join(spans.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    again = F.exists(F.coalesce("spans", F.array().cast("array<struct<after:bigint,stop:bigint,budget:double>>")), lambda r: (
        (F.col("place") > r["after"]) & (F.col("size") <= r["budget"]) & (r["stop"].isNull() | (F.col("place") < r["stop"]))))
    taken = F.col("size") * (F.col("whole") + F.when(again, 1).otherwise(0))
    return beside(rows, of, n).select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))

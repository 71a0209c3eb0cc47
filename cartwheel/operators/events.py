"""Event-level operators: flags, filters, deduplication, catalogue join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.columns import purchase_flag
from cartwheel.params import interval


def with_purchase_flag(events: DataFrame) -> DataFrame:
    """``is_purchase`` = 1 for purchases, else 0."""
    return events.withColumn("is_purchase", purchase_flag("event_type"))


def purchase_predicate(time_col: str = "time_generated",
                       watermark_from: str = "filtered") -> Column:
    """F7 predicate. With ``watermark_from="all"`` the predicate mentions the
    event-time column, so Catalyst keeps it above the watermark node and
    every event advances the watermark (D19); results are the same."""
    is_purchase = F.col("event_type") == "purchase"
    if watermark_from == "all":
        return F.when(F.col(time_col).isNotNull(), is_purchase)
    return is_purchase


def purchases(events: DataFrame, time_col: str = "time_generated",
              watermark_from: str = "filtered") -> DataFrame:
    """purchase events only."""
    return events.where(purchase_predicate(time_col, watermark_from))


def dedup_events(events: DataFrame, key: str = "event_id",
                 time_col: str = "time_generated",
                 watermark_s: float | None = None) -> DataFrame:
    """T4: one row per ``event_id``. Rows without an id are no copies of one
    another: all of them stay, and they share no group.

    Streams: ``dropDuplicatesWithinWatermark`` (bounded state; needs the
    watermark). Batch: the least copy by (time, other columns) — a
    deterministic choice, so a retried task reproduces the same row, and a
    plain aggregate, so copies of a hot id collapse map-side before the
    shuffle.
    """
    if events.isStreaming:
        df = events
        if watermark_s is not None:
            df = df.withWatermark(time_col, interval(watermark_s))
        own = F.coalesce(F.col(key).cast("string"), F.expr("uuid()"))
        return df.withColumn("_dedup_key", own).dropDuplicatesWithinWatermark(["_dedup_key"]).drop("_dedup_key")
    others = [c for c in events.columns if c != key]
    ordered = [time_col] + [c for c in others if c != time_col] if time_col in others else others
    best = F.min(F.struct(*[F.col(c) for c in ordered])).alias("_best")
    own = F.when(F.col(key).isNull(), F.expr("uuid()"))  # a group of its own for a row without an id
    return (events.withColumn("_own", own).groupBy(key, "_own").agg(best)
            .select(*[F.col(key) if c == key else F.col(f"_best.{c}").alias(c)
                      for c in events.columns]))


def enrich_with_products(events: DataFrame, products: DataFrame, guard_col: str | None = None) -> DataFrame:
    """Inner equi-join on ``product_id``; null and unknown ids drop out.

    No side is hinted: the planner broadcasts a catalogue whose size it knows
    to be below ``spark.sql.autoBroadcastJoinThreshold``, AQE one that turns
    out to be below ``spark.sql.adaptive.autoBroadcastJoinThreshold`` (a
    stream decides per micro-batch, as the catalogue is read again), and
    beyond that the sort-merge join's skew handling splits the partition of a
    hot product.

    ``guard_col`` (the event-time column) makes the join key null when that
    column is null. The key then mentions event time, so the null filter
    Catalyst infers from the join stays above a watermark instead of being
    pushed below it — rows without a product still advance the watermark
    (D19 option). Matches are the same as without the guard for every row
    with an event time.
    """
    right = products.select("product_id", "name", "category", "cost")
    if guard_col is None:
        # No explicit null filter: the inner join drops null ids, and a
        # filter that does not mention event time would sink below a watermark.
        return events.join(right, "product_id", "inner")
    keyed = events.withColumn("_join_key", F.when(F.col(guard_col).isNotNull(), F.col("product_id")))
    right = right.withColumnRenamed("product_id", "_catalogue_id")
    return (keyed.join(right, F.col("_join_key") == F.col("_catalogue_id"), "inner")
            .drop("_join_key", "_catalogue_id"))


def unknown_products(purchases: DataFrame, products: DataFrame) -> DataFrame:
    """What :func:`enrich_with_products` drops: ``product_id, num_purchases,
    num_users, first_seen, last_seen`` of purchases whose product is null or
    isn't in the catalogue. Purchases are summed by product before the
    anti-join, so a hot product is one row by then."""
    users = purchases.groupBy("product_id", "user_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("time_generated").alias("first"), F.max("time_generated").alias("last"))
    sold = users.groupBy("product_id").agg(
        F.sum("n").alias("num_purchases"), F.count("user_id").alias("num_users"),
        F.min("first").alias("first_seen"), F.max("last").alias("last_seen"))
    return sold.join(products.select("product_id"), "product_id", "left_anti")

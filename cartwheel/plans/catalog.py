"""Named batch queries over the driver's test tables, one per operator key.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
``events`` / ``part`` tables. Builders compose the same transforms the
streaming jobs run; only the final presentation differs: timestamps are
returned as ``timestamp_ntz`` (UTC wall clock) and id arrays as sorted,
comma-joined text so results compare exactly with a SQL engine.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel import schemas
from cartwheel.functions.codec import encode_json
from cartwheel.operators import decode, events, funnel, gold, layout, maintenance, serving, sessions, snapshots, summaries, versions
from cartwheel.params import HARNESS, Params
from cartwheel.plans import faults
from cartwheel.session import run_root
from cartwheel.sources import harness
from cartwheel.sources.files import read_optional_parquet, read_products_csv

Builder = Callable[[SparkSession, str], DataFrame]


def present(df: DataFrame) -> DataFrame:
    """Timestamps -> timestamp_ntz, arrays -> sorted comma-joined text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(F.array_sort(c), ",")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def utc_session(spark: SparkSession) -> SparkSession:
    """The caller's session if its zone is UTC, else one of its own beside it:
    the tables hold UTC wall-clock times, and the caller's settings stay."""
    if spark.conf.get("spark.sql.session.timeZone") == "UTC":
        return spark
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", "UTC")
    return own


class Chain:
    """The storefront chain over one scale-factor directory.

    Attributes are lazily built DataFrames; nothing runs until an action.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, params: Params = HARNESS):
        self.spark, self.sf_dir, self.p = utc_session(spark), sf_dir, params

    # -- inputs ---------------------------------------------------------
    def events(self) -> DataFrame:
        return harness.events(self.spark, self.sf_dir)

    def products(self) -> DataFrame:
        return harness.products(self.spark, self.sf_dir)

    def envelope(self) -> DataFrame:
        return harness.clickstream_envelope(self.events())

    # -- silver -----------------------------------------------------------
    def maybe_dedup(self, ev: DataFrame) -> DataFrame:
        return events.dedup_events(ev) if self.p.dedup else ev

    def purchases(self, since=None) -> DataFrame:
        # copies of a purchase are purchases: filter first, so a dedup
        # shuffles only the purchase stream
        return self.maybe_dedup(harness.purchase_events(self.spark, self.sf_dir, since))

    def enriched(self, since=None) -> DataFrame:
        return events.enrich_with_products(self.purchases(since), self.products())

    def product_summary(self) -> DataFrame:
        return summaries.product_summary(self.purchases(), self.products())

    def carts(self) -> DataFrame:
        return sessions.session_carts(self.events(), self.p.session_gap_s,
                                      slice_s=self.p.slice_width_s)

    def abandoned(self) -> DataFrame:
        return sessions.abandoned_carts(self.carts())

    def purchase_sessions(self, since=None) -> DataFrame:
        return sessions.purchase_sessions(self.enriched(since), self.p.session_gap_s,
                                          slice_s=self.p.slice_width_s)

    def recent_sessions(self) -> DataFrame:
        """Sessions enough for the look-back, from the events at most one gap
        before its bound. A session across the bound has an event in that gap,
        so it still starts before the bound, where F9 drops its window; every
        other session is whole."""
        if self.p.as_of is None:
            return self.purchase_sessions()
        return self.purchase_sessions(self.p.as_of - timedelta(seconds=self.p.look_back_s + self.p.session_gap_s))

    def user_stage(self) -> DataFrame:
        # max stage and max time are idempotent under duplicate sends, so the
        # batch funnel needs no dedup shuffle unless dedup is asked for
        return funnel.user_stage(self.maybe_dedup(self.events()))

    def daily_stage(self) -> DataFrame:
        """The highest stage of each user on each UTC day."""
        day = F.to_date("time_generated").alias("day")
        return funnel.user_stage(self.maybe_dedup(self.events()).select("*", day), by=["day"])

    # -- gold ---------------------------------------------------------------
    def gold_averages(self) -> DataFrame:
        return gold.gold_averages(self.purchase_sessions(), self.p.gold_window_s)

    def gold_spend(self) -> DataFrame:
        return gold.gold_spend_distribution(self.purchase_sessions(), self.p.gold_window_s,
                                            self.p.bucket_width)

    def recent_averages(self) -> DataFrame:
        return serving.recent(gold.gold_averages(self.recent_sessions(), self.p.gold_window_s),
                              self.p.look_back_s, self.p.as_of)

    def recent_spend(self) -> DataFrame:
        return serving.recent(gold.gold_spend_distribution(self.recent_sessions(), self.p.gold_window_s, self.p.bucket_width),
                              self.p.look_back_s, self.p.as_of)

    # -- stored gold --------------------------------------------------------
    def written(self, what: str) -> str:
        """A folder of its own for a table that a query writes."""
        return f"{run_root(self.spark)}/{what}/{uuid.uuid4().hex}"

    def stored(self, table: DataFrame, schema: T.StructType) -> DataFrame:
        """``table`` written as Parquet, and its look-back read from there."""
        path = self.written("gold")
        table.select(*schema.fieldNames()).write.parquet(path)
        written = read_optional_parquet(self.spark, schema, path)
        written = self.spark.createDataFrame([], schema) if written is None else written
        return serving.recent(written, self.p.look_back_s, self.p.as_of)


def _q(fn: Callable[[Chain], DataFrame]) -> Builder:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(fn(Chain(spark, sf_dir)))
    build.__doc__ = fn.__doc__
    return build


def _decode_events(c: Chain) -> DataFrame:
    """F1-F4 over the clickstream envelope."""
    return decode.decode_events(c.envelope())


def _purchase_flag(c: Chain) -> DataFrame:
    """F5."""
    return events.with_purchase_flag(c.events()).select(
        "event_id", "user_id", "event_type", "is_purchase")


def _purchases_enriched(c: Chain) -> DataFrame:
    """J1."""
    return c.enriched().select("event_id", "user_id", "product_id", "time_generated",
                               "name", "category", "cost")


def _abandoned_carts(c: Chain) -> DataFrame:
    """A2 with the topic key and JSON value."""
    return sessions.cart_messages(c.abandoned())


def _purchase_sessions(c: Chain) -> DataFrame:
    """A3; amounts shown at 2 dp."""
    return c.purchase_sessions().withColumn("total_amount", F.round("total_amount", 2))


def _product_summary(c: Chain) -> DataFrame:
    """A4."""
    return c.product_summary()


def _category_summary(c: Chain) -> DataFrame:
    """A5."""
    return summaries.category_summary(c.product_summary())


def _funnel_metrics(c: Chain) -> DataFrame:
    """A10 snapshot over all users, per day of their events."""
    return funnel.funnel_metrics(funnel.stage_counts(c.daily_stage(), ["day"]), ["day"])


def _latest_abandoned_cart(c: Chain) -> DataFrame:
    """A13 with retention."""
    return serving.latest_per_key(c.abandoned(), "user_id", "ts",
                                  c.p.cart_retention_s, c.p.as_of)


def _decode_topic(c: Chain) -> DataFrame:
    """S6 + JSON-or-raw decode of the abandoned-cart topic."""
    ab = c.abandoned()
    msg = sessions.cart_messages(ab)
    # the topic's offsets, here told by user and time
    own = F.col("user_id") * 1_000_000_007 + F.unix_seconds("ts")
    env = harness.to_envelope(msg, F.col("key"), F.col("value"), harness.CART_TOPIC, "ts", own)
    dec = decode.decode_topic(env, schemas.CART_MESSAGE)
    return dec.select("key", F.col("value.user_id").alias("user_id"),
                      F.col("value.product_ids").alias("product_ids"),
                      F.col("value.ts").alias("ts"), "raw_value", "partition", "offset")


def _dlq_route(c: Chain) -> DataFrame:
    """X1 over an envelope with damaged messages."""
    return decode.route_events(faults.faulty_clickstream_envelope(faults.source_events(c.spark, c.sf_dir)))


def _dedup_events(c: Chain) -> DataFrame:
    """T4 over events that are partly sent twice."""
    return events.dedup_events(harness.double_sent(c.events()), time_col="time_received")


def _dedup_events_dirty(c: Chain) -> DataFrame:
    """T4 where the ids of some events were lost: those all stay."""
    lost = F.when(F.col("event_type") == "add_to_cart", F.lit(None)).otherwise(F.col("event_id")).cast("bigint")
    return events.dedup_events(harness.double_sent(c.events().withColumn("event_id", lost)), time_col="time_received")


def _purchase_sessions_dedup(c: Chain) -> DataFrame:
    """Sessions of purchases that were sent twice."""
    pur = events.dedup_events(events.purchases(harness.double_sent(c.events())))
    enriched = events.enrich_with_products(pur, c.products())
    out = sessions.purchase_sessions(enriched, c.p.session_gap_s, slice_s=c.p.slice_width_s)
    return out.withColumn("total_amount", F.round("total_amount", 2))


def _summary_totals(c: Chain) -> DataFrame:
    """Category totals over product summaries made per day."""
    day = F.to_date("time_generated").alias("day")
    sold = c.purchases().where("product_id is not null").groupBy(day, "product_id").agg(
        F.count("event_id").alias("num_purchases"), F.count("*").alias("units"))
    days = events.enrich_with_products(sold, c.products()).withColumn("revenue", F.round(F.col("units") * F.col("cost"), 2))
    return summaries.summary_totals(days)[1]


def _evolved_events(c: Chain) -> DataFrame:
    """Events of which some were written before products were known."""
    path, ev = c.written("evolved"), c.events()
    ev.where("product_id is null").drop("product_id").write.parquet(path)
    ev.where("product_id is not null").write.mode("append").parquet(path)
    return maintenance.read_evolving(c.spark, path).select(*schemas.EVENT_FIELDS)


def _compacted_events(c: Chain) -> DataFrame:
    """A table of many small files, rewritten by date."""
    path = c.written("compacted")
    c.events().repartition(24).write.parquet(f"{path}/small")
    whole = maintenance.compact(c.spark, f"{path}/small", f"{path}/large", time_col="time_generated")
    return whole.select(*schemas.EVENT_FIELDS, F.col("event_date").cast("date"))


def _upserted_carts(c: Chain) -> DataFrame:
    """The latest cart of each user in a table that four upserts, a
    stretch of time each, have made."""
    carts = c.abandoned().select("user_id", "product_ids", "ts").persist()
    try:
        low, high = carts.agg(F.min("ts"), F.max("ts")).first()
        schema = T.StructType([f for f in schemas.CART_MESSAGE.fields])
        latest = snapshots.UpsertTable(c.spark, c.written("upserted"), schema, "user_id", "ts", buckets=16)
        for k in range(4 if low is not None else 0):
            share = F.floor((F.unix_micros("ts") - F.unix_micros(F.lit(low))) * 4 / (F.unix_micros(F.lit(high)) - F.unix_micros(F.lit(low)) + 1))
            latest.upsert(carts.where(share == 3 - k))  # the latest first: an older cart must not replace a newer one
        return latest.read().select("user_id", "product_ids", "ts")
    finally:
        carts.unpersist()


def _clustered_events(c: Chain) -> DataFrame:
    """A table that small appends fill and two compactions tidy up; the
    second leaves the files of the first alone where they are large enough."""
    table = layout.ClusteredTable(c.spark, c.written("clustered"), schemas.EVENT, ["user_id", "time_generated"], target_bytes=32 << 20)
    share = F.pmod(F.xxhash64("event_id"), F.lit(4))
    for k in range(4):
        table.append(c.events().where(share == k))
        if k % 2:
            table.compact()
    return table.read()


def _versioned_events(c: Chain) -> DataFrame:
    """Events written under three schema versions, told by their headers,
    and some under one that isn't known, in the newest schema."""
    first = T.StructType([f for f in schemas.EVENT.fields if f.name not in ("product_id", "time_received")])
    second = T.StructType([*first.fields, schemas.EVENT["product_id"]])
    third = T.StructType([*second.fields, T.StructField("channel", T.StringType(), True, {"default": "web"})])
    log = versions.SchemaLog(c.spark, c.written("schemas"))
    numbers = [log.register(s) for s in (first, second, third)]
    ev = c.events().withColumn("channel", F.lit("app"))
    texts = [encode_json(F.struct(*s.fieldNames())) for s in (first, second, third)]
    kind = F.pmod("event_id", F.lit(10))  # 0 to 3: first, 4 to 6: second, 7 and 8: third, 9: one to come
    number = F.when(kind < 4, numbers[0]).when(kind < 7, numbers[1]).when(kind < 9, numbers[2]).otherwise(max(numbers) + 1)
    text = F.when(kind < 4, texts[0]).when(kind < 7, texts[1]).otherwise(texts[2])
    sent = ev.select(versions.encode_version(number, text).alias("value"))
    read = versions.decode_versions(sent, log.versions(), third)
    return read.select(*third.fieldNames(), "schema_version", "error_reason")


def _unknown_products(c: Chain) -> DataFrame:
    """Purchases that the catalogue join leaves out, by product."""
    return events.unknown_products(c.purchases(), c.products().where(F.col("product_id") % 7 != 0))


def _products_csv(c: Chain) -> DataFrame:
    """The catalogue written as CSV, read from there into Parquet."""
    path = c.written("products")
    c.products().write.option("header", "true").csv(f"{path}/csv")
    read_products_csv(c.spark, f"{path}/csv").write.parquet(f"{path}/parquet")
    return c.spark.read.schema(schemas.PRODUCT).parquet(f"{path}/parquet")


QUERIES: dict[str, Builder] = {
    "decode_events": _q(_decode_events),
    "dedup_events": _q(_dedup_events),
    "dedup_events_dirty": _q(_dedup_events_dirty),
    "purchase_flag": _q(_purchase_flag),
    "purchases": _q(lambda c: harness.purchase_events(c.spark, c.sf_dir)),
    "purchases_enriched": _q(_purchases_enriched),
    "session_carts": _q(lambda c: c.carts()),
    "abandoned_carts": _q(_abandoned_carts),
    "purchase_sessions": _q(_purchase_sessions),
    "purchase_sessions_dedup": _q(_purchase_sessions_dedup),
    "product_summary": _q(_product_summary),
    "category_summary": _q(_category_summary),
    "funnel_user_stage": _q(lambda c: c.user_stage()),
    "summary_totals": _q(_summary_totals),
    "funnel_stage_counts": _q(lambda c: funnel.stage_counts(c.daily_stage(), ["day"])),
    "funnel_metrics": _q(_funnel_metrics),
    "gold_averages": _q(lambda c: c.gold_averages()),
    "gold_spend_distribution": _q(lambda c: c.gold_spend()),
    "recent_averages": _q(lambda c: c.recent_averages()),
    "kpi_averages": _q(lambda c: serving.kpi_averages(c.recent_averages())),
    "spend_histogram": _q(lambda c: serving.spend_histogram(c.recent_spend(), c.p.bucket_width)),
    "spend_histogram_totals": _q(lambda c: serving.spend_histogram_totals(c.recent_spend())),
    "stored_kpi_averages": _q(lambda c: serving.kpi_averages(c.stored(c.gold_averages(), schemas.GOLD_AVERAGES))),
    "stored_spend_histogram": _q(lambda c: serving.spend_histogram(
        c.stored(c.gold_spend(), schemas.GOLD_SPEND), c.p.bucket_width)),
    "latest_abandoned_cart": _q(_latest_abandoned_cart),
    "decode_topic": _q(_decode_topic),
    "dlq_route": _q(_dlq_route),
    "evolved_events": _q(_evolved_events),
    "compacted_events": _q(_compacted_events),
    "products_csv": _q(_products_csv),
    "clustered_events": _q(_clustered_events),
    "versioned_events": _q(_versioned_events),
    "upserted_carts": _q(_upserted_carts),
    "unknown_products": _q(_unknown_products),
}

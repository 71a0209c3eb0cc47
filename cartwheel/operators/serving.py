"""Serving queries over the gold tables: look-back (F9), ratio KPIs (A11),
dense spend histogram (A12, J2), latest record per key (A13)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.columns import bucket_label, ratio2

#: Buckets that one row of the spine's first step stands for.
SPINE_STRETCH = 10_000


def as_of_col(as_of: datetime | None) -> Column:
    """Reference instant: a fixed timestamp, or ``current_timestamp()``.

    A naive ``as_of`` is wall-clock time in the session time zone (an aware
    one keeps its offset). It is passed as text and cast by Spark, not as a
    Python datetime literal, whose conversion would depend on the driver
    machine's own time zone. The cast is constant-folded, so the look-back
    filter still reaches the scan."""
    if as_of is None:
        return F.current_timestamp()
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp")


def recent(gold: DataFrame, look_back_s: float, as_of: datetime | None = None,
           col: str = "window_start") -> DataFrame:
    """rows with ``col >= as_of - look_back``. The predicate is on the
    bare column against a constant, so it reaches the parquet scan."""
    bound = as_of_col(as_of) - F.make_dt_interval(secs=F.lit(float(look_back_s)))
    return gold.where(F.col(col) >= bound)


def kpi_averages(averages: DataFrame) -> DataFrame:
    """Average order value and average purchase-session duration,
    2 dp; 0 when there are no sessions (D12). One pass, one row."""
    tot = averages.agg(F.sum("total_amount").alias("a"),
                       F.sum("total_session_duration_seconds").alias("d"),
                       F.sum("session_count").alias("n"))
    return tot.select(ratio2("a", "n").alias("average_order_value"),
                      ratio2("d", "n").alias("average_session_duration"),
                      F.coalesce(F.col("n"), F.lit(0)).alias("session_count"))


def _reaggregate(spend: DataFrame) -> DataFrame:
    return (spend.groupBy("bucket_start", "bucket_end", "bucket_label")
            .agg(F.sum("session_count").alias("session_count")))


def spend_histogram(spend: DataFrame, width: int) -> DataFrame:
    """A12 + J2: session counts per bucket over all windows, on a dense
    spine from the lowest to the highest bucket with zero fill (O2: sorted).
    Sessions without an amount have no bucket.

    The spine is made in two steps, stretches and then the buckets of each,
    so that neither an array nor a task grows with the largest amount; the
    stored counts are joined to it.
    """
    hist = _reaggregate(spend).where(F.col("bucket_start").isNotNull())
    step = F.lit(width).cast("bigint")
    stretch = step * SPINE_STRETCH
    # the counts are named here too, so that both uses of the histogram share one shuffle
    bounds = hist.agg(F.min("bucket_start").alias("lo"), F.max("bucket_start").alias("hi"),
                      F.sum("session_count").alias("sessions")).where("sessions > 0")
    stretches = bounds.select("hi", F.explode(F.sequence("lo", "hi", stretch)).alias("first"))
    spine = stretches.repartition("first").select(
        F.explode(F.sequence("first", F.least("hi", F.col("first") + stretch - step), step)).alias("b"))
    high = F.col("b") + step
    return (spine.join(hist.select("bucket_start", "session_count"), F.col("b") == F.col("bucket_start"), "left")
            .select(F.col("b").alias("bucket_start"), high.alias("bucket_end"),
                    bucket_label(F.col("b"), high).alias("bucket_label"),
                    F.coalesce("session_count", F.lit(0)).alias("session_count"))
            .orderBy("bucket_start"))


def spend_histogram_totals(spend: DataFrame) -> DataFrame:
    """A12 totals: sessions, buckets with sessions, lowest and highest bucket."""
    hist = _reaggregate(spend)
    return hist.agg(
        F.coalesce(F.sum("session_count"), F.lit(0)).alias("total_sessions"),
        F.count_if(F.col("session_count") > 0).alias("active_buckets"),
        F.min("bucket_start").alias("min_bucket"),
        F.max("bucket_start").alias("max_bucket"),
    )


def latest_per_key(df: DataFrame, key: str, order_col: str,
                   retention_s: float | None = None,
                   as_of: datetime | None = None) -> DataFrame:
    """The latest record per key, as a compacted topic keeps it; records
    older than ``as_of - retention`` are expired first. ``max`` over a struct
    led by the order column is deterministic and combines map-side, so a hot
    key never gathers its records in one task."""
    if retention_s is not None:
        df = recent(df, retention_s, as_of, order_col)
    others = [c for c in df.columns if c not in (key, order_col)]
    latest = F.max(F.struct(F.col(order_col), *[F.col(c) for c in others])).alias("_latest")
    return (df.groupBy(key).agg(latest)
            .select(key, *[F.col(f"_latest.{c}").alias(c) for c in [order_col, *others]]))

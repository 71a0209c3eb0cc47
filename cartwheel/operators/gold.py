"""Gold tables over purchase sessions: additive window totals (A6) and the
spend histogram per window (A7). Both store sums and counts, never
averages, so any range of windows can be re-aggregated (A11, A12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.columns import bucket_label
from cartwheel.params import interval

#: Doubles are rounded to this many places before they are cut to whole
#: units, so the last bits of a sum cannot flip the unit.
AMOUNT_PLACES = 6


def _per_window(sessions: DataFrame, window_s: float, keys: list[Column], **totals: Column) -> DataFrame:
    """``totals`` of the sessions that start in each tumbling window."""
    starts_in = F.window("session_start", interval(window_s))
    grouped = sessions.groupBy(starts_in, *keys).agg(*[c.alias(name) for name, c in totals.items()])
    return grouped.withColumn("window_start", F.col("window.start")).drop("window")


def gold_averages(sessions: DataFrame, window_s: float) -> DataFrame:
    """window_start, total_amount (whole units), total seconds and number
    of the purchase sessions."""
    seconds = F.unix_timestamp("session_end") - F.unix_timestamp("session_start")
    totals = _per_window(sessions, window_s, [], amount=F.sum("total_amount"),
                         total_session_duration_seconds=F.sum(seconds), session_count=F.count("*"))
    whole = F.round("amount", AMOUNT_PLACES).cast("bigint").alias("total_amount")
    return totals.select("window_start", whole, "total_session_duration_seconds", "session_count")


def gold_spend_distribution(sessions: DataFrame, window_s: float, width: int) -> DataFrame:
    """Number of sessions per window and spend bucket
    ``[k*width, (k+1)*width)``. Groups are keyed by the bucket's index k; its
    bounds and label follow from it."""
    k = F.floor(F.col("total_amount") / width).alias("k")
    counts = _per_window(sessions, window_s, [k], session_count=F.count("*"))
    low, high = F.col("k") * width, (F.col("k") + 1) * width
    return counts.select("window_start", low.alias("bucket_start"), high.alias("bucket_end"),
                         bucket_label(low, high).alias("bucket_label"), "session_count")

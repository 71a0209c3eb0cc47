"""Funnel: highest stage per user (A8), users per stage (A9), cumulated
reach with drop-off and conversion rates (A10, W1, W2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.columns import funnel_stage, pct

STAGES = (1, 2, 3, 4)


def user_stage(events: DataFrame, time_col: str = "time_generated", by: list[str] | None = None) -> DataFrame:
    """Per user (and extra keys, e.g. day) the highest stage reached (never regresses) and the
    latest event time (D4: the maximum, not the last row seen). Events
    without a user are not a funnel user (D18)."""
    return (events.where(F.col("user_id").isNotNull())
            .groupBy("user_id", *(by or []))
            .agg(F.max(funnel_stage("event_type")).cast("int").alias("highest_funnel_stage"),
                 F.max(time_col).alias("event_time")))


def stage_counts(stages: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Users per highest stage (optionally per extra keys, e.g. batch)."""
    by = by or []
    return (stages.groupBy(*by, "highest_funnel_stage")
            .agg(F.count("user_id").alias("user_count")))


def funnel_metrics(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """A10: for stages 1-4, reach = users whose highest stage is >= s (W1,
    the reverse running total), next = reach of s+1, 0 after stage 4 (W2);
    drop-off = (reach - next) / reach * 100, conversion = next / reach * 100,
    2 dp, null when reach is 0 (D16: typed columns even then). Missing
    stages count 0; stage 0 is not counted.

    Both running quantities are conditional sums in one aggregate over the
    (at most five) stage counts, unpivoted with ``stack`` — no window, no
    join, and a global aggregate still yields the four rows for an empty
    batch.
    """
    by = by or []
    stage = F.col("highest_funnel_stage")
    reach = [F.coalesce(F.sum(F.when(stage >= s, F.col("user_count"))), F.lit(0))
             .cast("bigint").alias(f"_r{s}") for s in STAGES]
    wide = counts.groupBy(*by).agg(*reach)
    last = STAGES[-1]
    rows = ", ".join(f"CAST({s} AS BIGINT), _r{s}, " + (f"_r{s + 1}" if s < last else "CAST(0 AS BIGINT)")
                     for s in STAGES)
    long = wide.select(*by, F.expr(f"stack({len(STAGES)}, {rows}) AS (funnel_stage, user_count, _next)"))
    return long.select(
        *by, "funnel_stage", "user_count",
        pct(F.col("user_count") - F.col("_next"), "user_count").alias("dropoff_rate_pct"),
        pct(F.col("_next"), "user_count").alias("conversion_rate_pct"),
    )

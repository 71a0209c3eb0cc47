"""Gap-based sessions (T2) and the session aggregates A1-A3.

Streams use Spark's ``session_window`` (state store, watermark). Batch uses an
equivalent plan in which no user's events ever meet in one task:

1. Time is cut into slices no wider than the gap. Two events of one user in
   the same slice are less than ``gap`` apart, so a slice never splits a
   session: each (user, slice) is reduced by an ordinary hash aggregate
   (first time, last time, partial aggregates) that combines map-side — a
   hot user or a hot slice is pre-aggregated before the shuffle.
2. The slice rows of a user, at most (time span / gap) of them whatever the
   event volume, are ordered by slice: a slice starts a session when it
   begins more than ``gap`` after the previous slice's last event, and every
   slice takes the start of the latest such slice at or before it.
3. The partial aggregates merge per (user, session start); the rows are
   already partitioned by user, so this needs no further shuffle.

Semantics equal ``session_window``: an event more than ``gap`` after the
previous one of the same key starts a new session (exactly ``gap`` joins);
the session ends ``gap`` after its last event; null times are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.columns import cart_product, purchase_flag
from cartwheel.params import interval

_US = 1_000_000


@dataclass(frozen=True)
class SessionAgg:
    """One session aggregate: ``how`` is sum, count, min, max or set
    (distinct non-null values, sorted)."""

    name: str
    expr: Column
    how: str

    def single(self) -> Column:
        return {
            "sum": lambda: F.sum(self.expr),
            "count": lambda: F.count(self.expr),
            "min": lambda: F.min(self.expr),
            "max": lambda: F.max(self.expr),
            "set": lambda: F.array_sort(F.collect_set(self.expr)),
        }[self.how]().alias(self.name)

    def partial(self) -> Column:
        if self.how == "set":
            return F.collect_set(self.expr).alias(self.name)
        return self.single()

    def combine(self) -> Column:
        """Session value from the partial values of its slices."""
        c = F.col(self.name)
        return {
            "sum": lambda: F.sum(c),
            "count": lambda: F.sum(c),
            "min": lambda: F.min(c),
            "max": lambda: F.max(c),
            "set": lambda: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))),
        }[self.how]().alias(self.name)

    def merge(self, first_row: Column) -> Column:
        """Combine slice partials into the session value. Slice rows are
        repeated once per item of an exploded set (see ``_batch_sessions``);
        ``first_row`` marks one copy, so sums and counts are not repeated."""
        c = F.col(self.name)
        once = F.when(first_row, c)
        return {
            "sum": lambda: F.sum(once),
            "count": lambda: F.coalesce(F.sum(once), F.lit(0)),
            "min": lambda: F.min(c),
            "max": lambda: F.max(c),
        }[self.how]().alias(self.name)


def sessionize(df: DataFrame, key: str, time_col: str, gap_s: float,
               aggs: list[SessionAgg], slice_s: float | None = None) -> DataFrame:
    """Group ``df`` into gap sessions per ``key`` and aggregate each.

    Returns ``key, session_start, session_end, <aggs>``. ``slice_s`` (batch
    only) is capped at the gap.
    """
    if df.isStreaming:
        return (df.groupBy(F.col(key), F.session_window(F.col(time_col), interval(gap_s)))
                .agg(*[a.single() for a in aggs])
                .select(key, F.col("session_window.start").alias("session_start"),
                        F.col("session_window.end").alias("session_end"),
                        *[a.name for a in aggs]))
    slice_s = gap_s if slice_s is None else min(slice_s, gap_s)
    return _batch_sessions(df, key, time_col, int(gap_s * _US), int(slice_s * _US), aggs)


def _batch_sessions(df: DataFrame, key: str, time_col: str, gap_us: int,
                    slice_us: int, aggs: list[SessionAgg]) -> DataFrame:
    us = F.unix_micros(F.col(time_col))
    # slice id = slice start in microseconds (integer arithmetic, exact)
    slice_id = us - F.pmod(us, F.lit(slice_us))
    slices = (df.where(F.col(time_col).isNotNull() & F.col(key).isNotNull())
              .groupBy(F.col(key), slice_id.alias("_slice"))
              .agg(F.min(us).alias("_first"), F.max(us).alias("_last"),
                   *[a.partial() for a in aggs]))
    by_user = Window.partitionBy(key).orderBy("_slice")
    slices = slices.withColumn("_gap", F.col("_first") - F.lag("_last").over(by_user))
    starts = F.when(F.col("_gap").isNull() | (F.col("_gap") > F.lit(gap_us)), F.col("_first"))
    tagged = slices.withColumn("_start", F.max(starts).over(
        by_user.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # A set aggregate merges by exploding the slice sets and collecting the
    # distinct items again: its state is bounded by the distinct items, not
    # by how many slices the session spans, and it combines map-side.
    sets = [a for a in aggs if a.how == "set"]
    if len(sets) > 1:
        raise ValueError("at most one set aggregate per sessionization")
    first_row = F.lit(True)
    merges = []
    if sets:
        tagged = tagged.select("*", F.posexplode_outer(sets[0].name).alias("_pos", "_item"))
        first_row = F.col("_pos").isNull() | (F.col("_pos") == 0)
        merges.append(F.array_sort(F.collect_set("_item")).alias(sets[0].name))
    merges += [a.merge(first_row) for a in aggs if a.how != "set"]
    out = tagged.groupBy(key, "_start").agg(F.max("_last").alias("_end"), *merges)
    return out.select(
        key,
        F.timestamp_micros("_start").alias("session_start"),
        F.timestamp_micros(F.col("_end") + F.lit(gap_us)).alias("session_end"),
        *[a.name for a in aggs],
    )


def stream_slices(df: DataFrame, key: str, time_col: str, gap_s: float, aggs: list[SessionAgg]) -> DataFrame:
    """First hop of streaming sessions without a hot task: ``key,
    slice_start, first, last, <partial aggs>`` per slice of the gap's width.

    A tumbling-window aggregate, so the rows of a user combine in each input
    partition, and the state of a user and slice is one row however many
    events it has. A slice is emitted once the watermark passes its end."""
    t = F.col(time_col)
    return (df.where(F.col(key).isNotNull()).groupBy(F.col(key), F.window(t, interval(gap_s)))
            .agg(F.min(t).alias("first"), F.max(t).alias("last"), *[a.partial() for a in aggs])
            .select(key, F.col("window.start").alias("slice_start"), "first", "last", *[a.name for a in aggs]))


def sessions_of_slices(slices: DataFrame, key: str, gap_s: float, aggs: list[SessionAgg]) -> DataFrame:
    """Second hop: sessions over the slice rows. A slice lasts from its first
    event to ``gap`` after its last, as a session window with a gap of its own;
    windows that meet are one session, as their events would be.

    Rows of a slice arrive at most a slice behind the latest, so a watermark of
    the gap on ``first`` loses none of them."""
    held = (F.unix_micros("last") - F.unix_micros("first") + F.lit(int(gap_s * _US))).cast("string")
    return (slices.withWatermark("first", interval(gap_s))
            .groupBy(F.col(key), F.session_window("first", F.concat(held, F.lit(" microseconds"))))
            .agg(*[a.combine() for a in aggs])
            .select(key, F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"),
                    *[a.name for a in aggs]))


def session_carts(events: DataFrame, gap_s: float, time_col: str = "time_generated",
                  slice_s: float | None = None) -> DataFrame:
    """A1: per user session, the set of added-to-cart products (sorted) and
    whether any event of the session was a purchase."""
    aggs = [SessionAgg("cart_products", cart_product("event_type", "product_id"), "set"),
            SessionAgg("has_purchased", purchase_flag("event_type"), "max")]
    return sessionize(events, "user_id", time_col, gap_s, aggs, slice_s)


def abandoned_carts(carts: DataFrame) -> DataFrame:
    """A2: sessions with a non-empty cart and no purchase; ``ts`` = session end.

    A purchase of any product in the session cancels abandonment (D7)."""
    return (carts.where((F.size("cart_products") > 0) & (F.col("has_purchased") == 0))
            .select("user_id", F.col("cart_products").alias("product_ids"),
                    F.col("session_end").alias("ts")))


def cart_messages(abandoned: DataFrame) -> DataFrame:
    """Topic records for abandoned carts: adds key = user id text and value =
    JSON ``{user_id, product_ids, ts}`` (default millisecond time format)."""
    return (abandoned
            .withColumn("key", F.col("user_id").cast("string"))
            .withColumn("value", F.to_json(F.struct("user_id", "product_ids", "ts"))))


def purchase_sessions(enriched: DataFrame, gap_s: float, time_col: str = "time_generated",
                      slice_s: float | None = None) -> DataFrame:
    """A3: per user purchase session, the summed product cost."""
    return sessionize(enriched, "user_id", time_col, gap_s, purchase_aggs(), slice_s)


def purchase_aggs() -> list[SessionAgg]:
    return [SessionAgg("total_amount", F.col("cost"), "sum")]

"""Streaming jobs P1-P5. Each takes a source DataFrame (a Kafka topic via
:mod:`cartwheel.sources.kafka`, or file envelopes for replays and tests), a
sink, a checkpoint location and :class:`~cartwheel.params.Params`, and starts
the same transforms the batch catalogue runs.

Checkpoints default to ``<spark.checkpoint.dir>/<job>`` (an error where that
is unset too); set
``spark.sql.shuffle.partitions`` before the first start, as state is
partitioned by it for the life of the checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartwheel import schemas
from cartwheel.functions.columns import funnel_stage
from cartwheel.operators import decode, events, funnel, gold, sessions, snapshots, summaries
from cartwheel.params import REFERENCE, Params, interval
from cartwheel.session import checkpoint_path
from cartwheel.sources.files import read_optional_parquet, stream_parquet
from cartwheel.streaming.funnel_state import funnel_state
from cartwheel.streaming.seen import SeenIds
from cartwheel.streaming.sinks import (
    ConsoleSink, KafkaSink, ParquetSink, Sink, Trigger, fan_out, start_foreach_batch, start_stream,
    write_batch,
)


def _ckpt(spark: SparkSession, given: str | None, name: str) -> str:
    return given or checkpoint_path(spark, name)


def decoded(envelope: DataFrame, job: str) -> DataFrame:
    """Decode the envelope and observe per-batch counts (``messages``,
    ``malformed``) in the query progress under ``<job>_decode``.

    The observation is also a plan barrier: a filter on decoded fields stays
    above it instead of being pushed into the JSON parsing, so each message
    is parsed once (the pushed filter would parse it again per field)."""
    return decode.decode_events(envelope).observe(
        f"{job}_decode", F.count(F.lit(1)).alias("messages"),
        F.count_if(F.col("event_id").isNull()).alias("malformed"))


def start_cart_abandonment(spark: SparkSession, envelope: DataFrame, sink: Sink,
                           checkpoint: str | None = None, params: Params = REFERENCE,
                           trigger: Trigger = Trigger("5 seconds"),
                           name: str = "cart_abandonment") -> StreamingQuery:
    """Sessions per user (gap), carts without a purchase -> topic records
    ``key = user id``, ``value = {user_id, product_ids, ts}``; append mode,
    each session emitted once after the watermark passes its end."""
    ev = (decoded(envelope, name)
          .withWatermark("event_time", interval(params.cart_watermark_s)))
    carts = sessions.session_carts(ev, params.session_gap_s, time_col="event_time")
    out = sessions.cart_messages(sessions.abandoned_carts(carts))
    if isinstance(sink, KafkaSink):
        out = out.select("key", "value")
    return start_stream(out, sink, _ckpt(spark, checkpoint, name), trigger, name=name)


def purchase_stream(envelope: DataFrame, params: Params,
                    watermark_s: float | None, job: str = "purchases") -> DataFrame:
    """Decoded purchases, watermarked on event time (no watermark when
    ``watermark_s`` is None).

    Filter placement decides which events advance the watermark (D19)."""
    ev = decoded(envelope, job)
    if watermark_s is not None:
        ev = ev.withWatermark("time_generated", interval(watermark_s))
    pur = events.purchases(ev, watermark_from=params.watermark_from)
    return events.dedup_events(pur) if params.dedup else pur


def enriched_stream(envelope: DataFrame, products: DataFrame, params: Params,
                    watermark_s: float | None, job: str = "purchases") -> DataFrame:
    """The purchase stream joined with the catalogue."""
    guard = "time_generated" if params.watermark_from == "all" else None
    return events.enrich_with_products(purchase_stream(envelope, params, watermark_s, job), products, guard)


def start_purchase_sessions(spark: SparkSession, envelope: DataFrame, products: DataFrame,
                            silver: ParquetSink, checkpoint: str | None = None,
                            params: Params = REFERENCE,
                            trigger: Trigger = Trigger(),
                            name: str = "purchase_sessions") -> StreamingQuery:
    """P2 (silver): purchase sessions ``user_id, session_start, session_end,
    total_amount`` into a parquet file sink (exactly-once, append).

    With ``ParquetSink(path, ("session_date",))`` the table is partitioned by
    the UTC date of the session start, so batch readers prune by date
    (readers with the declared schema get ``session_date`` appended). Off by
    default: a replay whose micro-batch spans many days would write one small
    file per task and day; :func:`~cartwheel.operators.maintenance.compact`
    produces a date-partitioned copy instead."""
    enr = enriched_stream(envelope, products, params, params.purchase_watermark_s, name)
    ps = sessions.purchase_sessions(enr, params.session_gap_s)
    out = ps.select(*schemas.PURCHASE_SESSION.fieldNames())
    if "session_date" in silver.partition_by:
        out = out.withColumn("session_date", F.to_date("session_start"))
    return start_stream(out, silver, _ckpt(spark, checkpoint, name), trigger, name=name)


def start_purchase_slices(spark: SparkSession, envelope: DataFrame, products: DataFrame, slices: ParquetSink,
                          checkpoint: str | None = None, params: Params = REFERENCE, trigger: Trigger = Trigger(),
                          name: str = "purchase_slices") -> StreamingQuery:
    """P2 without a hot task, first hop: purchase sums per user and slice of
    the session gap, into a parquet file sink."""
    enr = enriched_stream(envelope, products, params, params.purchase_watermark_s, name)
    out = sessions.stream_slices(enr, "user_id", "time_generated", params.session_gap_s, sessions.purchase_aggs())
    return start_stream(out, slices, _ckpt(spark, checkpoint, name), trigger, name=name)


def start_sliced_sessions(spark: SparkSession, slices_path: str, silver: ParquetSink, checkpoint: str | None = None,
                          params: Params = REFERENCE, trigger: Trigger = Trigger(), max_files_per_trigger: int | None = None,
                          name: str = "sliced_sessions") -> StreamingQuery:
    """P2 without a hot task, second hop: the same sessions as
    :func:`start_purchase_sessions`, from the slices of the first."""
    slices = stream_parquet(spark, schemas.PURCHASE_SLICE, slices_path, max_files_per_trigger)
    out = sessions.sessions_of_slices(slices, "user_id", params.session_gap_s, sessions.purchase_aggs())
    return start_stream(out.select(*schemas.PURCHASE_SESSION.fieldNames()), silver, _ckpt(spark, checkpoint, name), trigger, name=name)


def start_late_events(spark: SparkSession, envelope: DataFrame, late_root: str, clock_root: str, watermark_s: float, held_s: float,
                      checkpoint: str | None = None, trigger: Trigger = Trigger(), on_time_root: str | None = None,
                      name: str = "late_events") -> StreamingQuery:
    """T5: late events to ``late_root/batch_id=N``, so that none is lost
    unseen, and the others to ``on_time_root/batch_id=N`` if it is given.

    The watermark of a batch is the latest time of the batches before it less
    ``watermark_s``; an event is late where the window that it would open,
    ``held_s`` long, ends no later than that. Each batch's latest time is
    written to ``clock_root``, and only earlier batches' are read, so a replayed
    batch finds the same late events. A stateful job that reads
    ``on_time_root`` with the same delay drops nothing: its own watermark is
    never ahead of the one used here. Beside a job on the same source this
    holds every event that the job drops; Spark itself lets an event pass for
    one more batch."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        own = batch_df.sparkSession
        clock = read_optional_parquet(own, schemas.BATCH_CLOCK, clock_root)
        before = None if clock is None else clock.where(F.col("batch_id") < batch_id).agg(F.max("latest").alias("t")).first()["t"]
        batch_df.persist()
        try:
            late = F.lit(False)
            if before is not None:
                passed = F.lit(before) - F.expr(f"INTERVAL '{watermark_s}' SECOND") - F.expr(f"INTERVAL '{held_s}' SECOND")
                late = F.coalesce(F.col("time_generated") <= passed, F.lit(False))  # without a time: no window at all
            write_batch(batch_df.where(late), late_root, batch_id)
            if on_time_root:
                write_batch(batch_df.where(~late), on_time_root, batch_id)
            write_batch(batch_df.agg(F.max("time_generated").alias("latest")), clock_root, batch_id)
        finally:
            batch_df.unpersist()

    return start_foreach_batch(decoded(envelope, name), write, _ckpt(spark, checkpoint, name), trigger, name=name)


def start_product_snapshots(spark: SparkSession, envelope: DataFrame, products: DataFrame, root: str,
                            checkpoint: str | None = None, params: Params = REFERENCE, trigger: Trigger = Trigger(),
                            name: str = "product_snapshots") -> StreamingQuery:
    """P3 with both tables of a batch visible together or not at all (X3);
    read them with :func:`~cartwheel.operators.snapshots.read_published`."""
    wm = params.product_watermark_s if params.dedup else None
    pur = purchase_stream(envelope, params, wm, name)

    def write(batch_df: DataFrame, batch_id: int) -> None:
        level = summaries.product_summary(batch_df, products)
        snapshots.publish(level, root, batch_id, {"product": lambda p: p, "category": summaries.category_summary})

    return start_foreach_batch(pur, write, _ckpt(spark, checkpoint, name), trigger, name=name)


def start_product_summary(spark: SparkSession, envelope: DataFrame, products: DataFrame,
                          product_root: str, category_root: str,
                          checkpoint: str | None = None, params: Params = REFERENCE,
                          trigger: Trigger = Trigger(),
                          name: str = "product_summary") -> StreamingQuery:
    """Per micro-batch product and category summaries, fanned out from
    one persisted batch to ``<root>/batch_id=N`` (retry-safe, D11). Totals
    over all batches are a batch query on the product level (D9). No
    stateful operator follows, so the watermark is only set when dedup needs
    it (D10)."""
    wm = params.product_watermark_s if params.dedup else None
    pur = purchase_stream(envelope, params, wm, name)

    def write(batch_df: DataFrame, batch_id: int) -> None:
        fan_out(summaries.product_summary(batch_df, products), batch_id, [
            (lambda level: level, product_root),
            (summaries.category_summary, category_root),
        ])

    return start_foreach_batch(pur, write, _ckpt(spark, checkpoint, name), trigger, name=name)


def start_funnel(spark: SparkSession, envelope: DataFrame, metrics_root: str,
                 checkpoint: str | None = None, params: Params = REFERENCE,
                 trigger: Trigger = Trigger(), stages_root: str | None = None,
                 stateful: bool = True, name: str = "funnel") -> StreamingQuery:
    """Deduplicated events -> highest stage per user -> per micro-batch
    funnel metrics of the users updated in that batch (D3), written to
    ``metrics_root/batch_id=N``; optionally the user updates too.

    The highest stage and the latest time ignore copies, so the event ids
    are only kept in state when ``params.dedup`` asks for it.

    ``stateful=True`` keeps per-user state with event-time expiry (T6);
    ``False`` uses a native ``max`` aggregate in update mode (no expiry)."""
    ev = decoded(envelope, name).withWatermark("time_generated", interval(params.funnel_watermark_s))
    if params.dedup:
        ev = events.dedup_events(ev)
    if stateful:
        users = funnel_state(ev, params.funnel_timeout_s)
    else:
        users = (ev.where(F.col("user_id").isNotNull()).groupBy("user_id")
                 .agg(F.max(funnel_stage("event_type")).cast("int").alias("highest_funnel_stage"),
                      F.max("time_generated").alias("event_time")))

    def write(batch_df: DataFrame, batch_id: int) -> None:
        outputs = [(lambda b: funnel.funnel_metrics(funnel.stage_counts(b)), metrics_root)]
        if stages_root:
            outputs.append((lambda b: b, stages_root))
        fan_out(batch_df, batch_id, outputs)

    return start_foreach_batch(users, write, _ckpt(spark, checkpoint, name), trigger,
                               mode="update", name=name)


def start_funnel_windows(spark: SparkSession, envelope: DataFrame, sink: Sink, checkpoint: str | None = None,
                         params: Params = REFERENCE, trigger: Trigger = Trigger(), name: str = "funnel_windows") -> StreamingQuery:
    """P4 with expiry and without Python state (T6): the highest stage of each
    user in each window of activity, which ends ``funnel_timeout_s`` after its
    last event. A window comes out once, when the watermark passes its end,
    and its state goes with it."""
    ev = decoded(envelope, name).withWatermark("time_generated", interval(params.funnel_watermark_s)).where(F.col("user_id").isNotNull())
    out = sessions.sessionize(ev, "user_id", "time_generated", params.funnel_timeout_s,
                              [sessions.SessionAgg("highest_funnel_stage", funnel_stage("event_type"), "max")])
    return start_stream(out, sink, _ckpt(spark, checkpoint, name), trigger, name=name)


def start_exact_dedup(spark: SparkSession, envelope: DataFrame, out_root: str, seen: SeenIds, checkpoint: str | None = None,
                      trigger: Trigger = Trigger(), name: str = "exact_dedup") -> StreamingQuery:
    """T4 with no time limit: each event to ``out_root/batch_id=N`` of the
    first batch that has its id, whenever copies come."""
    return start_foreach_batch(decoded(envelope, name), lambda batch_df, batch_id: seen.write(batch_df, batch_id, out_root),
                               _ckpt(spark, checkpoint, name), trigger, name=name)


def start_user_gold(spark: SparkSession, silver_path: str, averages: ParquetSink | None,
                    spend: ParquetSink | None, checkpoint_root: str | None = None,
                    params: Params = REFERENCE, trigger: Trigger = Trigger("1 minute"),
                    max_files_per_trigger: int | None = None,
                    debug_console: bool = False, name: str = "user_gold") -> list[StreamingQuery]:
    """P5: silver sessions (file stream) -> window totals and spend
    distribution, each to a parquet file sink in append mode (T8: the silver
    directory is read through its commit log); one without a sink isn't run. ``debug_console`` adds the
    same totals to the console in complete mode (T9; keeps its own state)."""
    silver = stream_parquet(spark, schemas.PURCHASE_SESSION, silver_path, max_files_per_trigger)
    silver = silver.withWatermark("session_start", interval(params.gold_watermark_s))
    root = _ckpt(spark, checkpoint_root, name)
    queries = []
    if averages is not None:
        queries.append(start_stream(gold.gold_averages(silver, params.gold_window_s), averages,
                                    f"{root}/averages", trigger, name=f"{name}_averages"))
    if spend is not None:
        queries.append(start_stream(gold.gold_spend_distribution(silver, params.gold_window_s, params.bucket_width),
                                    spend, f"{root}/spend_distribution", trigger, name=f"{name}_spend_distribution"))
    if debug_console:
        queries.append(start_stream(gold.gold_averages(silver, params.gold_window_s), ConsoleSink(),
                                    f"{root}/averages_console", trigger, mode="complete",
                                    name=f"{name}_averages_console"))
    return queries


def start_dead_letters(spark: SparkSession, envelope: DataFrame, dlq_root: str,
                       checkpoint: str | None = None, trigger: Trigger = Trigger(),
                       valid_root: str | None = None, name: str = "dead_letters") -> StreamingQuery:
    """Classify every message once per micro-batch; dead letters
    (original text, reason, receive time) go to ``dlq_root/batch_id=N`` and,
    when ``valid_root`` is given, decoded valid events to
    ``valid_root/batch_id=N``. The routed batch is persisted before the
    split, so each message is parsed once (a filter on the reason would
    otherwise be pushed into, and repeat, the parsing)."""

    def write(batch_df: DataFrame, batch_id: int) -> None:
        outputs = [(lambda r: decode.split_routes(r)[1], dlq_root)]
        if valid_root:
            outputs.append((lambda r: decode.split_routes(r)[0], valid_root))
        fan_out(decode.route_events(batch_df), batch_id, outputs)

    return start_foreach_batch(envelope, write, _ckpt(spark, checkpoint, name), trigger, name=name)


def await_any(spark: SparkSession, timeout_s: float | None = None) -> None:
    """Block until any started query ends (or the timeout passes)."""
    spark.streams.awaitAnyTermination(timeout_s)


__all__ = [
    "start_cart_abandonment", "start_purchase_sessions", "start_product_summary",
    "start_purchase_slices", "start_sliced_sessions", "start_late_events", "start_product_snapshots",
    "start_funnel_windows", "start_exact_dedup",
    "start_funnel", "start_user_gold", "start_dead_letters", "await_any", "purchase_stream", "enriched_stream",
    "write_batch",
]

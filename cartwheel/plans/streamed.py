"""Catalogue queries that run the streaming jobs over whole test tables.

Each builder replays the ``events`` table as a clickstream with an
``availableNow`` trigger, in BATCHES micro-batches in the order of event time,
lets the job write its sink under the session's checkpoint folder
(``spark.checkpoint.dir``; a fresh local folder only in local mode when that
is unset) and returns the committed output as a DataFrame. Append-mode jobs
emit a session or window only once the watermark has passed its end, so their
output is the batch result cut at the final watermark. Outputs per micro-batch
are returned as their totals, which don't depend on the batches.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel import schemas
from cartwheel.operators import funnel, maintenance, snapshots, summaries
from cartwheel.params import HARNESS
from cartwheel.plans import faults
from cartwheel.plans.catalog import present
from cartwheel.session import STREAMING_CONF, run_root
from cartwheel.sources import harness
from cartwheel.streaming import jobs
from cartwheel.streaming.seen import SeenIds
from cartwheel.streaming.sinks import ParquetSink, Trigger

NOW = Trigger(available_now=True)
BATCHES = 4


def _job_session(spark: SparkSession) -> SparkSession:
    """A session for one catalogue stream run: it shares the SparkContext but
    not the SQL settings, so sizing it never touches the caller's session
    (also under concurrent calls). Shuffle/state partitions = the cluster's
    default parallelism, fixed for the fresh checkpoint's life; state is in
    RocksDB, so it isn't bound by the heap; all progress reports are kept."""
    child = spark.newSession()
    conf = {**STREAMING_CONF, "spark.sql.session.timeZone": "UTC",
            "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
            "spark.sql.streaming.numRecentProgressUpdates": "100000",
            "spark.sql.shuffle.partitions": str(max(1, spark.sparkContext.defaultParallelism))}
    for key, value in conf.items():
        child.conf.set(key, value)
    return child


def _sized(fn):
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(_job_session(spark), sf_dir)
    return run


def _run_dir(spark: SparkSession, name: str) -> str:
    return f"{run_root(spark)}/runs/{name}-{uuid.uuid4().hex}"


def _qname(run: str, job: str) -> str:
    """Unique query name per run, so concurrent catalogue calls never clash."""
    return f"{job}_{run.rsplit('-', 1)[-1][:12]}"


def _finish(*queries) -> None:
    for q in queries:
        q.awaitTermination()  # availableNow: ends by itself, and raises what ended it


#: Replays already written, by application, table folder and the files in it.
_replays: dict[tuple, tuple[str, int]] = {}


def _files(spark: SparkSession, sf_dir: str) -> tuple:
    """Name, size and time of the events table's files: a table that is written
    anew in one session is replayed anew."""
    meta = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    return tuple(sorted(map(tuple, meta.distinct().collect())))  # one row a file


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream in the order of event time."""
    key = (spark.sparkContext.applicationId, sf_dir, _files(spark, sf_dir))
    if key not in _replays:
        path = _run_dir(spark, "replay")
        _replays[key] = (path, harness.write_replay(spark, sf_dir, path, BATCHES))
    return harness.stream_replay(spark, *_replays[key])


def _clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harness.stream_clickstream(_rows(spark, sf_dir))


def stream_abandoned_carts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 over the whole events table."""
    run = _run_dir(spark, "carts")
    _finish(jobs.start_cart_abandonment(spark, _clicks(spark, sf_dir), ParquetSink(f"{run}/out"), f"{run}/ckpt",
                                        HARNESS, NOW, name=_qname(run, "carts")))
    return present(spark.read.parquet(f"{run}/out")
                   .select("user_id", "product_ids", "ts", "key", "value"))


def _silver(spark: SparkSession, sf_dir: str, run: str) -> str:
    _finish(jobs.start_purchase_sessions(spark, _clicks(spark, sf_dir), harness.products(spark, sf_dir),
                                         ParquetSink(f"{run}/silver"), f"{run}/ckpt/silver", HARNESS, NOW,
                                         name=_qname(run, "silver")))
    return f"{run}/silver"


def stream_purchase_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 (silver) over the whole events table."""
    silver = _silver(spark, sf_dir, _run_dir(spark, "silver"))
    df = (spark.read.schema(schemas.PURCHASE_SESSION).parquet(silver)
          .select(*schemas.PURCHASE_SESSION.fieldNames()))
    return present(df.withColumn("total_amount", F.round("total_amount", 2)))


def stream_sliced_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 by slices: partial sums per user and slice, then sessions of the
    slices, chained through storage. No task holds a user's events."""
    run = _run_dir(spark, "sliced")
    _finish(jobs.start_purchase_slices(spark, _clicks(spark, sf_dir), harness.products(spark, sf_dir), ParquetSink(f"{run}/slices"),
                                       f"{run}/ckpt/slices", HARNESS, NOW, name=_qname(run, "slices")))
    _finish(jobs.start_sliced_sessions(spark, f"{run}/slices", ParquetSink(f"{run}/silver"), f"{run}/ckpt/silver", HARNESS, NOW,
                                       name=_qname(run, "sliced")))
    df = spark.read.schema(schemas.PURCHASE_SESSION).parquet(f"{run}/silver")
    return present(df.select("user_id", "session_start", "session_end", F.round("total_amount", 2).alias("total_amount")))


def stream_restarted_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 stopped half-way and started again from its checkpoint (K12): half
    of the events have come at the first start, all at the second."""
    run = _run_dir(spark, "restarted")
    for only in (range(BATCHES // 2), range(BATCHES // 2, BATCHES)):
        files = harness.write_replay(spark, sf_dir, f"{run}/clicks", BATCHES, only)
        clicks = harness.stream_clickstream(harness.stream_replay(spark, f"{run}/clicks", files))
        _finish(jobs.start_purchase_sessions(spark, clicks, harness.products(spark, sf_dir), ParquetSink(f"{run}/silver"), f"{run}/ckpt",
                                             HARNESS, NOW, name=_qname(run, "restarted")))
    df = spark.read.schema(schemas.PURCHASE_SESSION).parquet(f"{run}/silver")
    return present(df.select("user_id", "session_start", "session_end", F.round("total_amount", 2).alias("total_amount")))


def stream_open_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold windows that the job holds in its state when it ends,
    read from the checkpoint by the state store's data source."""
    run = _run_dir(spark, "open")
    silver = _silver(spark, sf_dir, run)
    _finish(*jobs.start_user_gold(spark, silver, ParquetSink(f"{run}/out"), None, f"{run}/ckpt/gold", HARNESS, NOW, name=_qname(run, "open")))
    return present(maintenance.open_gold_windows(spark, f"{run}/ckpt/gold/averages"))


def _late_rows(spark: SparkSession, sf_dir: str, run: str) -> DataFrame:
    """A replay in which every tenth event comes with the last batch."""
    files = harness.write_replay(spark, sf_dir, f"{run}/clicks", BATCHES, late=F.col("event_id") % 10 == 3)
    return harness.stream_clickstream(harness.stream_replay(spark, f"{run}/clicks", files))


def stream_late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: the events that the cart job (P1) drops as too late."""
    run = _run_dir(spark, "late")
    _finish(jobs.start_late_events(spark, _late_rows(spark, sf_dir, run), f"{run}/late", f"{run}/clock", HARNESS.cart_watermark_s,
                                   HARNESS.session_gap_s, f"{run}/ckpt", NOW, name=_qname(run, "late")))
    return present(spark.read.parquet(f"{run}/late").select("event_id", "user_id", "event_type", "time_generated"))


def stream_snapshot_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 with snapshots (X3): totals over the product and category tables of
    all published batches."""
    run = _run_dir(spark, "snapshots")
    _finish(jobs.start_product_snapshots(spark, _clicks(spark, sf_dir), harness.products(spark, sf_dir), f"{run}/tables", f"{run}/ckpt",
                                         HARNESS, NOW, name=_qname(run, "snapshots")))
    product = snapshots.read_published(spark, f"{run}/tables", "product", schemas.PRODUCT_SUMMARY)
    category = snapshots.read_published(spark, f"{run}/tables", "category", schemas.CATEGORY_SUMMARY)
    counts = summaries.summary_totals(product)[1].select("category", "num_products")
    sums = category.groupBy("category").agg(F.sum("num_purchases").alias("num_purchases"), F.round(F.sum("revenue"), 2).alias("revenue"))
    return present(counts.join(sums, "category"))


def _gold(spark: SparkSession, sf_dir: str, which: str, schema) -> DataFrame:
    run = _run_dir(spark, which)
    silver = _silver(spark, sf_dir, run)
    sinks = {"averages": None, "spend": None, which: ParquetSink(f"{run}/out")}
    _finish(*jobs.start_user_gold(spark, silver, sinks["averages"], sinks["spend"], f"{run}/ckpt/gold", HARNESS, NOW,
                                  name=_qname(run, "gold")))
    return present(spark.read.schema(schema).parquet(f"{run}/out"))


def stream_gold_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 -> P5: silver stream, then gold stream over the silver directory."""
    return _gold(spark, sf_dir, "averages", schemas.GOLD_AVERAGES)


def stream_gold_spend_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 -> P5, the spend-distribution output."""
    return _gold(spark, sf_dir, "spend", schemas.GOLD_SPEND)


def _summaries(spark: SparkSession, sf_dir: str) -> str:
    run = _run_dir(spark, "products")
    _finish(jobs.start_product_summary(spark, _clicks(spark, sf_dir), harness.products(spark, sf_dir),
                                       f"{run}/product", f"{run}/category", f"{run}/ckpt", HARNESS, NOW,
                                       name=_qname(run, "products")))
    return run


def stream_product_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals (D9) of the product summaries written per micro-batch."""
    batches = spark.read.parquet(f"{_summaries(spark, sf_dir)}/product")
    return present(summaries.summary_totals(batches)[0])


def stream_category_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3, the category output: purchases and revenue summed over the written
    category summaries; its products, which aren't additive, from the product
    level (D9)."""
    run = _summaries(spark, sf_dir)
    totals = summaries.summary_totals(spark.read.parquet(f"{run}/product"))[1].select("category", "num_products")
    written = spark.read.parquet(f"{run}/category").groupBy("category").agg(
        F.sum("num_purchases").alias("num_purchases"), F.round(F.sum("revenue"), 2).alias("revenue"))
    return present(totals.join(written, "category"))


def _funnel(spark: SparkSession, sf_dir: str, stateful: bool) -> str:
    """The folder of a funnel run over the whole table. State isn't given up
    within it, so a user's last update is about all of the user's events."""
    run = _run_dir(spark, "funnel")
    kept = HARNESS.with_(funnel_timeout_s=10 * 366 * 24 * 3600)
    _finish(jobs.start_funnel(spark, _clicks(spark, sf_dir), f"{run}/metrics", f"{run}/ckpt", kept, NOW,
                              stages_root=f"{run}/stages", stateful=stateful, name=_qname(run, "funnel")))
    return run


def last_updates(updates: DataFrame) -> DataFrame:
    """The state of each user as its last micro-batch wrote it. Earlier updates
    don't count, so a job that loses state between batches shows it."""
    last = F.max_by(F.struct("highest_funnel_stage", "event_time"), "batch_id").alias("last")
    return updates.groupBy("user_id").agg(last).select("user_id", "last.highest_funnel_stage", "last.event_time")


def _stages(spark: SparkSession, sf_dir: str, stateful: bool) -> DataFrame:
    return last_updates(spark.read.parquet(f"{_funnel(spark, sf_dir, stateful)}/stages"))


def stream_funnel_user_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 with keyed state."""
    return present(_stages(spark, sf_dir, stateful=True))


def stream_funnel_user_stage_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 with a native ``max`` aggregate in update mode instead of keyed
    state (no expiry)."""
    return present(_stages(spark, sf_dir, stateful=False))


def stream_funnel_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The funnel snapshot of all users after the last micro-batch."""
    return present(funnel.funnel_metrics(funnel.stage_counts(_stages(spark, sf_dir, stateful=True))))


def stream_funnel_batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics that the job wrote with each micro-batch, of the users
    that had events in it."""
    written = spark.read.parquet(f"{_funnel(spark, sf_dir, stateful=True)}/metrics")
    return present(written.select(F.col("batch_id").cast("bigint"), "funnel_stage", "user_count", "dropoff_rate_pct", "conversion_rate_pct"))


def stream_funnel_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 by windows of activity (T6 with expiry, natively)."""
    run = _run_dir(spark, "windows")
    _finish(jobs.start_funnel_windows(spark, _clicks(spark, sf_dir), ParquetSink(f"{run}/out"), f"{run}/ckpt", HARNESS, NOW, name=_qname(run, "windows")))
    return present(spark.read.parquet(f"{run}/out").select("user_id", "session_start", "session_end", "highest_funnel_stage"))


def stream_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4 beyond the watermark: purchases and the events whose id ends in 7
    are all sent once more after the end of the table; the batch that passed
    each event on is the one of its first sending."""
    run = _run_dir(spark, "seen")
    files = harness.write_replay(spark, sf_dir, f"{run}/clicks", BATCHES)
    again = spark.read.schema(harness.RAW_SCHEMAS["events"]).parquet(f"{run}/clicks")
    again = again.where("event_type = 'purchase' or event_id % 10 = 7").persist()
    again.count()  # the folder it is read from is written to next
    (again.coalesce(1) if files == 1 else again.repartition(files)).write.mode("append").parquet(f"{run}/clicks")
    again.unpersist()
    clicks = harness.stream_clickstream(harness.stream_replay(spark, f"{run}/clicks", files))
    _finish(jobs.start_exact_dedup(spark, clicks, f"{run}/out", SeenIds(f"{run}/seen"), f"{run}/ckpt", NOW, name=_qname(run, "seen")))
    passed = spark.read.parquet(f"{run}/out")
    return present(passed.select("event_id", "user_id", "event_type", "product_id", "time_generated", F.col("batch_id").cast("bigint")))


def stream_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 as a stream: damaged messages with reason, text and receive time."""
    run = _run_dir(spark, "dlq")
    src = faults.map_source_events(_rows(spark, sf_dir))
    _finish(jobs.start_dead_letters(spark, faults.faulty_clickstream_envelope(src), f"{run}/dlq",
                                    f"{run}/ckpt", NOW, name=_qname(run, "dlq")))
    return present(spark.read.parquet(f"{run}/dlq").select("error_reason", "raw_value", "received_at"))


STREAM_QUERIES = {f.__name__: _sized(f) for f in (
    stream_abandoned_carts, stream_purchase_sessions, stream_sliced_sessions, stream_restarted_sessions, stream_open_windows,
    stream_late_events, stream_snapshot_categories, stream_funnel_batch_metrics, stream_gold_averages, stream_gold_spend_distribution,
    stream_product_summary, stream_category_summary, stream_funnel_user_stage, stream_funnel_user_stage_native,
    stream_funnel_metrics, stream_funnel_windows, stream_exact_dedup, stream_dead_letters)}


def _progress_summary(q) -> dict:
    progress = [p for p in q.recentProgress if p.get("numInputRows", 0) or p.get("stateOperators")]
    rows = sum(p.get("numInputRows", 0) for p in progress)
    secs = sum(p["durationMs"].get("triggerExecution", 0) for p in progress) / 1000.0
    state = {}
    for p in progress:
        for op in p.get("stateOperators", []):
            name = op.get("operatorName", "state")
            state[name] = max(state.get(name, 0), op.get("numRowsTotal", 0))
    return {"rows": rows, "sec": round(secs, 3),
            "rows_per_sec": round(rows / secs, 1) if secs else None, "state_rows": state}


def job_metrics(spark: SparkSession, sf_dir: str) -> dict:
    """Throughput and state size of the silver (P2) and funnel (P4) jobs over
    the whole events table, from the queries' progress reports."""
    out = {}
    spark = _job_session(spark)
    run = _run_dir(spark, "metrics")
    q = jobs.start_purchase_sessions(spark, _clicks(spark, sf_dir),
                                     harness.products(spark, sf_dir), ParquetSink(f"{run}/silver"),
                                     f"{run}/ckpt/silver", HARNESS, NOW)
    _finish(q)
    out["purchase_sessions"] = _progress_summary(q)
    q = jobs.start_funnel(spark, _clicks(spark, sf_dir), f"{run}/metrics",
                          f"{run}/ckpt/funnel", HARNESS, NOW, stateful=True)
    _finish(q)
    out["funnel"] = _progress_summary(q)
    return out

"""Structured Streaming jobs over file-replayed envelopes (availableNow)."""

import os

import pytest
from pyspark.sql import functions as F

from cartwheel import REFERENCE, HARNESS, schemas
from cartwheel.operators import gold, sessions
from cartwheel.plans.catalog import Chain
from cartwheel.sources import kafka_available, stream_envelopes, stream_topic
from cartwheel.sources import harness
from cartwheel.streaming import jobs
from cartwheel.streaming.sinks import MemorySink, ParquetSink, Trigger, write_batch
from conftest import EVENT_ROWS, at
from stream_util import write_envelopes, write_events

NOW = Trigger(available_now=True)


def run(q):
    q.awaitTermination(180)
    assert q.exception() is None, q.exception()
    return q


def purchase(eid, t, user=1, product=3):
    return (eid, user, "purchase", product, at(t))


def silver_rows(spark, path):
    df = spark.read.schema(schemas.PURCHASE_SESSION).parquet(path)
    return sorted((r["user_id"], r["session_start"], r["session_end"], r["total_amount"])
                  for r in df.collect())


def test_late_row_dropped_and_sessions_emitted_once(spark, scratch, fixture_products):
    src = f"{scratch}/src"
    for chunk in ([purchase(1, 0), purchase(2, 60)], [purchase(3, 400)],
                  [purchase(4, 2), purchase(5, 800)], [purchase(6, 2500)]):
        write_events(src, chunk)
    env = stream_envelopes(spark, src, max_files_per_trigger=1)
    run(jobs.start_purchase_sessions(spark, env, fixture_products, ParquetSink(f"{scratch}/silver"),
                                     f"{scratch}/ckpt", REFERENCE, NOW))
    assert silver_rows(spark, f"{scratch}/silver") == [
        (1, at(0), at(5), 4.0), (1, at(60), at(65), 4.0),
        (1, at(400), at(405), 4.0), (1, at(800), at(805), 4.0)]


def test_restart_from_checkpoint_emits_nothing_twice(spark, scratch, fixture_products):
    src, out, ck = f"{scratch}/src", f"{scratch}/silver", f"{scratch}/ckpt"
    write_events(src, [purchase(1, 0), purchase(2, 60)])
    write_events(src, [purchase(3, 400)])
    env = lambda: stream_envelopes(spark, src, max_files_per_trigger=1)
    run(jobs.start_purchase_sessions(spark, env(), fixture_products, ParquetSink(out), ck, REFERENCE, NOW))
    first = silver_rows(spark, out)
    assert first == [(1, at(0), at(5), 4.0), (1, at(60), at(65), 4.0)]
    write_events(src, [purchase(5, 800)])
    write_events(src, [purchase(6, 2500)])
    run(jobs.start_purchase_sessions(spark, env(), fixture_products, ParquetSink(out), ck, REFERENCE, NOW))
    assert silver_rows(spark, out) == [
        (1, at(0), at(5), 4.0), (1, at(60), at(65), 4.0),
        (1, at(400), at(405), 4.0), (1, at(800), at(805), 4.0)]


@pytest.mark.parametrize("mode,emitted", [("filtered", False), ("all", True)])
def test_watermark_stall_d19(spark, scratch, fixture_products, mode, emitted):
    src = f"{scratch}/src"
    write_events(src, [purchase(1, 0)])
    write_events(src, [(2, 1, "page_view", None, at(400))])
    write_events(src, [(3, 1, "page_view", None, at(500))])
    env = stream_envelopes(spark, src, max_files_per_trigger=1)
    params = REFERENCE.with_(watermark_from=mode)
    run(jobs.start_purchase_sessions(spark, env, fixture_products, ParquetSink(f"{scratch}/silver"),
                                     f"{scratch}/ckpt", params, NOW))
    got = silver_rows(spark, f"{scratch}/silver") if os.path.exists(f"{scratch}/silver") else []
    assert (got == [(1, at(0), at(5), 4.0)]) is emitted
    if not emitted:
        assert got == []


def test_cart_abandonment_stream(spark, scratch):
    src = f"{scratch}/src"
    write_events(src, EVENT_ROWS and [(e, u, t, p, at(s)) for e, u, t, p, s in EVENT_ROWS])
    env = stream_envelopes(spark, src)
    out = f"{scratch}/carts"
    run(jobs.start_cart_abandonment(spark, env, ParquetSink(out), f"{scratch}/ckpt", REFERENCE, NOW))
    rows = spark.read.parquet(out).collect()
    assert [(r["user_id"], r["product_ids"], r["ts"], r["key"]) for r in rows] == [(2, [4, 5], at(8), "2")]


def test_two_hop_silver_gold_equals_batch(spark, scratch):
    sf = "/root/testdata/sf0.001"
    ev = harness.events(spark, sf)
    pdf = harness.clickstream_envelope(ev).orderBy("timestamp").toPandas()
    src = f"{scratch}/src"
    for part in range(4):  # four files in time order
        chunk = pdf.iloc[part * len(pdf) // 4:(part + 1) * len(pdf) // 4]
        write_envelopes(src, [(k.decode(), v.decode(), t.to_pydatetime())
                              for k, v, t in zip(chunk["key"], chunk["value"], chunk["timestamp"])])
    products = harness.products(spark, sf)
    silver, ck = f"{scratch}/silver", f"{scratch}/ckpt"
    q = run(jobs.start_purchase_sessions(spark, stream_envelopes(spark, src, 1), products,
                                         ParquetSink(silver, ("session_date",)), f"{ck}/silver",
                                         HARNESS, NOW))
    wm = q.lastProgress["eventTime"]["watermark"]
    seen = sum(p["observedMetrics"]["purchase_sessions_decode"]["messages"]
               for p in q.recentProgress if "purchase_sessions_decode" in p.get("observedMetrics", {}))
    assert seen == ev.count()
    batch = Chain(spark, sf).purchase_sessions()
    closed = batch.where(F.col("session_end") <= F.lit(wm).cast("timestamp"))
    streamed = spark.read.schema(schemas.PURCHASE_SESSION).parquet(silver)
    assert streamed.count() > 0
    assert any(d.startswith("session_date=") for d in os.listdir(silver))  # date-partitioned
    cols = ["user_id", "session_start", "session_end", F.round("total_amount", 6).alias("t")]
    assert sorted(streamed.select(cols).collect()) == sorted(closed.select(cols).collect())
    # hop 2: gold from the silver directory, read through its commit log
    qs = jobs.start_user_gold(spark, silver, ParquetSink(f"{scratch}/avg"), ParquetSink(f"{scratch}/spend"),
                              f"{ck}/gold", HARNESS, NOW)
    for g in qs:
        run(g)
    gwm = qs[0].lastProgress["eventTime"].get("watermark")
    expect = gold.gold_averages(streamed, HARNESS.gold_window_s).where(
        F.col("window_start") + F.expr(f"INTERVAL {int(HARNESS.gold_window_s)} SECONDS")
        <= F.lit(gwm).cast("timestamp"))
    got = spark.read.schema(schemas.GOLD_AVERAGES).parquet(f"{scratch}/avg")
    assert got.count() > 0
    assert sorted(got.collect()) == sorted(expect.collect())


def test_funnel_stream_stateful_and_native(spark, scratch):
    src = f"{scratch}/src"
    write_events(src, [(e, u, t, p, at(s)) for e, u, t, p, s in EVENT_ROWS])
    for stateful in (True, False):
        base = f"{scratch}/{stateful}"
        run(jobs.start_funnel(spark, stream_envelopes(spark, src), f"{base}/metrics", f"{base}/ckpt",
                              REFERENCE, NOW, stages_root=f"{base}/stages", stateful=stateful))
        stages = spark.read.parquet(f"{base}/stages")
        assert sorted((r["user_id"], r["highest_funnel_stage"]) for r in stages.collect()) == [
            (1, 4), (2, 4), (3, 4), (4, 0), (5, 4)]
        m = spark.read.parquet(f"{base}/metrics").orderBy("funnel_stage").collect()
        assert [(r["funnel_stage"], r["user_count"], r["dropoff_rate_pct"], r["conversion_rate_pct"])
                for r in m] == [(1, 4, 0.0, 100.0), (2, 4, 0.0, 100.0), (3, 4, 0.0, 100.0),
                                (4, 4, 100.0, 0.0)]
        assert {r["batch_id"] for r in m} == {0}


def test_product_summary_stream_and_replay(spark, scratch, fixture_products):
    src = f"{scratch}/src"
    write_events(src, [(e, u, t, p, at(s)) for e, u, t, p, s in EVENT_ROWS])
    run(jobs.start_product_summary(spark, stream_envelopes(spark, src), fixture_products,
                                   f"{scratch}/product", f"{scratch}/category", f"{scratch}/ckpt",
                                   REFERENCE, NOW))
    prod = spark.read.parquet(f"{scratch}/product")
    # no dedup (parity): the duplicate send of event 4 counts twice
    assert sorted((r["product_id"], r["num_purchases"], r["revenue"]) for r in prod.collect()) == [
        (3, 2, 8.0), (4, 1, 100.0), (7, 1, 21.0)]
    # a replayed batch replaces its own output
    b0 = prod.where("batch_id = 0").drop("batch_id")
    write_batch(b0, f"{scratch}/product2", 0)
    write_batch(b0, f"{scratch}/product2", 0)
    assert spark.read.parquet(f"{scratch}/product2").count() == b0.count()
    cat = spark.read.parquet(f"{scratch}/category")
    assert sorted((r["category"], r["num_products"]) for r in cat.collect()) == [
        ("Electronics", 1), ("Furniture", 1), ("Home", 1)]


def test_dead_letters_stream(spark, scratch):
    src = f"{scratch}/src"
    write_envelopes(src, [("1", "not json", at(0)),
                          ("1", '{"event_id":1,"user_id":1,"event_type":"x","time_generated":"garbage"}', at(1)),
                          ("1", '{"event_id":2,"user_id":1,"event_type":"x",'
                                '"time_generated":"2026-01-01T00:00:01.000000Z"}', at(1))])
    run(jobs.start_dead_letters(spark, stream_envelopes(spark, src), f"{scratch}/dlq",
                                f"{scratch}/ckpt", NOW, valid_root=f"{scratch}/valid"))
    dl = spark.read.parquet(f"{scratch}/dlq")
    assert sorted(r["error_reason"] for r in dl.collect()) == ["bad_timestamp", "invalid_json"]
    ok = spark.read.parquet(f"{scratch}/valid").collect()
    assert [(r["event_id"], r["batch_id"]) for r in ok] == [(2, 0)]


def test_kafka_source_is_gated(spark):
    if kafka_available(spark):
        pytest.skip("Kafka connector present")
    with pytest.raises(RuntimeError, match="Kafka data source"):
        stream_topic(spark, "localhost:9092", "clickstream")
    from cartwheel.sources import read_topic
    with pytest.raises(RuntimeError, match="Kafka data source"):
        read_topic(spark, "localhost:9092", "abandoned_carts")


def test_memory_sink_for_debugging(spark, scratch):
    src = f"{scratch}/src"
    write_events(src, [(e, u, t, p, at(s)) for e, u, t, p, s in EVENT_ROWS])
    run(jobs.start_cart_abandonment(spark, stream_envelopes(spark, src), MemorySink("carts_dbg"),
                                    f"{scratch}/ckpt", REFERENCE, NOW))
    assert spark.sql("SELECT user_id FROM carts_dbg").collect()[0]["user_id"] == 2


def test_product_summary_batches_add_up_to_batch_result(spark, scratch):
    sf = "/root/testdata/sf0.001"
    pdf = harness.clickstream_envelope(harness.events(spark, sf)).orderBy("timestamp").toPandas()
    src = f"{scratch}/src"
    for part in range(3):
        chunk = pdf.iloc[part * len(pdf) // 3:(part + 1) * len(pdf) // 3]
        write_envelopes(src, [(k.decode(), v.decode(), t.to_pydatetime())
                              for k, v, t in zip(chunk["key"], chunk["value"], chunk["timestamp"])])
    products = harness.products(spark, sf)
    q = jobs.start_product_summary(spark, stream_envelopes(spark, src, 1), products,
                                   f"{scratch}/product", f"{scratch}/category", f"{scratch}/ck",
                                   HARNESS, NOW)
    run(q)
    per_batch = spark.read.parquet(f"{scratch}/product")
    assert per_batch.select("batch_id").distinct().count() == 3
    totals = per_batch.groupBy("product_id").agg(F.sum("num_purchases").alias("n"))
    expect = Chain(spark, sf).enriched().groupBy("product_id").agg(F.count("event_id").alias("n"))
    assert sorted(totals.collect()) == sorted(expect.collect())


def test_rocksdb_state_store_conf_runs(spark, scratch):
    """The deployment state-store settings work with a stateful job."""
    from cartwheel.session import STREAMING_CONF
    old = {k: spark.conf.get(k, None) for k in STREAMING_CONF}
    for k, v in STREAMING_CONF.items():
        spark.conf.set(k, v)
    try:
        src = f"{scratch}/src"
        write_events(src, [(e, u, t, p, at(s)) for e, u, t, p, s in EVENT_ROWS])
        run(jobs.start_funnel(spark, stream_envelopes(spark, src), f"{scratch}/m", f"{scratch}/ck",
                              REFERENCE, NOW, stages_root=f"{scratch}/stages"))
        assert spark.read.parquet(f"{scratch}/stages").count() == 5
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_cart_stream_over_four_files_equals_batch(spark, scratch):
    sf = "/root/testdata/sf0.001"
    pdf = harness.clickstream_envelope(harness.events(spark, sf)).orderBy("timestamp").toPandas()
    src = f"{scratch}/src"
    for part in range(4):
        chunk = pdf.iloc[part * len(pdf) // 4:(part + 1) * len(pdf) // 4]
        write_envelopes(src, [(k.decode(), v.decode(), t.to_pydatetime())
                              for k, v, t in zip(chunk["key"], chunk["value"], chunk["timestamp"])])
    out = f"{scratch}/carts"
    q = run(jobs.start_cart_abandonment(spark, stream_envelopes(spark, src, 1), ParquetSink(out),
                                        f"{scratch}/ck", HARNESS, NOW))
    wm = q.lastProgress["eventTime"]["watermark"]
    batch = sessions.abandoned_carts(Chain(spark, sf).carts()).where(
        F.col("ts") <= F.lit(wm).cast("timestamp"))
    got = spark.read.parquet(out).select("user_id", "product_ids", "ts")
    assert got.count() > 0
    assert sorted(got.collect()) == sorted(batch.collect())


def test_two_hop_restart_emits_each_gold_window_once(spark, scratch):
    sf = "/root/testdata/sf0.001"
    pdf = harness.clickstream_envelope(harness.events(spark, sf)).orderBy("timestamp").toPandas()
    chunks = [pdf.iloc[i * len(pdf) // 4:(i + 1) * len(pdf) // 4] for i in range(4)]
    products = harness.products(spark, sf)

    def feed(src, parts):
        for chunk in parts:
            write_envelopes(src, [(k.decode(), v.decode(), t.to_pydatetime())
                                  for k, v, t in zip(chunk["key"], chunk["value"], chunk["timestamp"])])

    def hop(src, root):
        run(jobs.start_purchase_sessions(spark, stream_envelopes(spark, src, 1), products,
                                         ParquetSink(f"{root}/silver"), f"{root}/ck/silver", HARNESS, NOW))
        for g in jobs.start_user_gold(spark, f"{root}/silver", ParquetSink(f"{root}/avg"),
                                      ParquetSink(f"{root}/spend"), f"{root}/ck/gold", HARNESS, NOW):
            run(g)

    # restarted: two halves, same checkpoints
    feed(f"{scratch}/a/src", chunks[:2])
    hop(f"{scratch}/a/src", f"{scratch}/a")
    feed(f"{scratch}/a/src", chunks[2:])
    hop(f"{scratch}/a/src", f"{scratch}/a")
    # uninterrupted
    feed(f"{scratch}/b/src", chunks)
    hop(f"{scratch}/b/src", f"{scratch}/b")
    a = spark.read.schema(schemas.GOLD_AVERAGES).parquet(f"{scratch}/a/avg").collect()
    b = spark.read.schema(schemas.GOLD_AVERAGES).parquet(f"{scratch}/b/avg").collect()
    assert len(a) == len({r["window_start"] for r in a}) > 0     # each window once
    assert sorted(a) == sorted(b)


DIRTY = [("1", '{"event_id":1,"user_id":1,"event_type":"purchase","time_generated":"garbage"}', at(0)),
         ("1", '{"event_id":2,"user_id":1,"event_type":"page_view","time_generated":"2026-01-01T00:00:05.000000Z"}', at(5)),
         ("2", '{"user_id":2,"event_type":"add_to_cart","time_generated":"2026-01-01T00:00:06.000000Z"}', at(6)),
         ("3", '{"event_id":"x","user_id":3,"event_type":"search","time_generated":"2026-01-01T00:00:07.000000Z"}', at(7)),
         ("4", '{"event_id":4,"user_id":4,"event_type":"product_view","time_generated":"garbage"}', at(8)),
         ("5", "not json", at(9))]


@pytest.mark.parametrize("dedup", [False, True])
def test_dirty_events_lose_no_user_in_either_funnel(spark, scratch, dedup):
    write_envelopes(f"{scratch}/src", DIRTY[:3])
    write_envelopes(f"{scratch}/src", DIRTY[3:])
    got = []
    for stateful in (True, False):
        run(jobs.start_funnel(spark, stream_envelopes(spark, f"{scratch}/src", 1), f"{scratch}/m{stateful}", f"{scratch}/ck{stateful}",
                              REFERENCE.with_(dedup=dedup), NOW, stages_root=f"{scratch}/s{stateful}", stateful=stateful))
        updates = spark.read.parquet(f"{scratch}/s{stateful}").groupBy("user_id").agg(
            F.max("highest_funnel_stage").alias("stage"), F.max("event_time").alias("time"))
        got.append(sorted((r["user_id"], r["stage"], r["time"]) for r in updates.collect()))
    assert got[0] == got[1] == [(1, 4, at(5)), (2, 3, at(6)), (3, 1, at(7)), (4, 2, None)]


def test_several_queries_and_the_console_totals_run_together(spark, scratch):
    """Gold streams and their complete-mode console query at once."""
    from cartwheel import schemas
    spark.createDataFrame([(1, at(0), at(5), 30.0), (1, at(5000), at(5005), 1.0)], schemas.PURCHASE_SESSION).write.parquet(f"{scratch}/silver")
    started = jobs.start_user_gold(spark, f"{scratch}/silver", ParquetSink(f"{scratch}/a"), ParquetSink(f"{scratch}/s"), f"{scratch}/ck",
                                   REFERENCE, NOW, debug_console=True)
    assert len(started) == 3 and started[2].name == "user_gold_averages_console"
    for q in started:
        q.awaitTermination(120)
        assert q.exception() is None
    spark.streams.resetTerminated()
    assert spark.read.schema(schemas.GOLD_AVERAGES).parquet(f"{scratch}/a").count() == 1  # the later window is still open

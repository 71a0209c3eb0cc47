"""Sliced sessions, late events, snapshots, upserts and state read from checkpoints."""

import glob
import os

import pytest
from conftest import at
from pyspark.sql import functions as F
from stream_util import write_events

from cartwheel import schemas
from cartwheel.operators import events, maintenance, sessions, snapshots
from cartwheel.params import REFERENCE
from cartwheel.plans import streamed
from cartwheel.sources.files import stream_envelopes
from cartwheel.streaming import jobs
from cartwheel.streaming.sinks import ParquetSink, Trigger

NOW = Trigger(available_now=True)
#: The jobs' settings, in a session that the other tests don't share.
P = REFERENCE.with_(purchase_watermark_s=10, cart_watermark_s=10)


@pytest.fixture
def own(spark):
    child = spark.newSession()
    child.conf.set("spark.sql.session.timeZone", "UTC")
    child.conf.set("spark.sql.shuffle.partitions", "2")
    return child


def finish(*queries):
    for q in queries:
        q.awaitTermination()
    return queries


def test_sliced_sessions_equal_session_windows(own, scratch, fixture_products):
    products = own.createDataFrame(fixture_products.collect(), schemas.PRODUCT)
    import random
    rng = random.Random(3)
    times = sorted(rng.uniform(0, 400) for _ in range(300))
    rows = [(i, rng.choice([1, 1, 1, 2, 3]), "purchase", rng.randrange(1, 11), at(round(t, 3))) for i, t in enumerate(times)]
    # events exactly a gap apart, on and beside a slice's edge
    rows += [(1000, 9, "purchase", 1, at(402)), (1001, 9, "purchase", 1, at(407)), (1002, 9, "purchase", 1, at(412.001)), (1003, 9, "purchase", 1, at(500))]
    for k in range(0, len(rows), 60):
        write_events(f"{scratch}/in", rows[k:k + 60])
    for hop, run in (("plain", "a"), ("sliced", "b")):
        clicks = stream_envelopes(own, f"{scratch}/in", 1)
        if hop == "plain":
            finish(jobs.start_purchase_sessions(own, clicks, products, ParquetSink(f"{scratch}/{run}"), f"{scratch}/ck{run}", P, NOW, name=f"t_{run}"))
        else:
            finish(jobs.start_purchase_slices(own, clicks, products, ParquetSink(f"{scratch}/slices"), f"{scratch}/cks", P, NOW, name="t_s"))
            finish(jobs.start_sliced_sessions(own, f"{scratch}/slices", ParquetSink(f"{scratch}/{run}"), f"{scratch}/ck{run}", P, NOW, 1, name=f"t_{run}"))
    cols = [F.col("user_id"), F.col("session_start"), F.col("session_end"), F.round("total_amount", 6)]
    plain, sliced = (own.read.schema(schemas.PURCHASE_SESSION).parquet(f"{scratch}/{run}").select(*cols).collect() for run in "ab")
    assert len(sliced) > 20 and set(map(tuple, sliced)) <= set(map(tuple, plain)) and len(set(map(tuple, sliced))) == len(sliced)
    # what only the one has out yet are sessions that end after the second watermark
    closed = max(r.session_end for r in sliced)
    assert {tuple(r) for r in plain if r.session_end <= closed} == set(map(tuple, sliced))
    assert (9, at(402), at(412), 20.0) in set(map(tuple, plain))


def test_a_hot_user_is_a_row_a_slice(own, scratch):
    rows = own.range(20_000).select((F.col("id") * 0 + 1).alias("user_id"), F.timestamp_micros(F.col("id") * 1000).alias("t"), F.lit(1.0).alias("cost"))
    rows.repartition(8).write.parquet(f"{scratch}/in")
    stream = own.readStream.schema(rows.schema).parquet(f"{scratch}/in").withWatermark("t", "0 seconds")
    out = sessions.stream_slices(stream, "user_id", "t", 5, sessions.purchase_aggs())
    (q,) = finish(out.writeStream.format("parquet").option("path", f"{scratch}/out").option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())
    state = max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"])
    got = own.read.parquet(f"{scratch}/out").collect()
    assert state <= 4 and sum(r.total_amount for r in got) == 15_000 and len(got) == 3  # of 20,000 events; the last slice is open


def test_lost_state_shows_in_the_last_updates(own, scratch):
    first = [(1, 1, "purchase", 3, at(0)), (2, 2, "page_view", None, at(1))]
    second = [(3, 1, "page_view", None, at(30)), (4, 2, "add_to_cart", 3, at(31))]
    kept = P.with_(funnel_timeout_s=10**6)
    for name, same in (("kept", True), ("lost", False)):
        for k, rows in enumerate((first, second)):
            write_events(f"{scratch}/{name}/in" if same else f"{scratch}/{name}/in{k}", rows)
            clicks = stream_envelopes(own, f"{scratch}/{name}/in" if same else f"{scratch}/{name}/in{k}", 1)
            finish(jobs.start_funnel(own, clicks, f"{scratch}/{name}/m", f"{scratch}/{name}/ck" if same else f"{scratch}/{name}/ck{k}", kept, NOW,
                                     stages_root=f"{scratch}/{name}/s{'' if same else k}", name=f"t_{name}{k}"))
    whole = own.read.parquet(f"{scratch}/kept/s")
    assert {(r.user_id, r.highest_funnel_stage) for r in streamed.last_updates(whole).collect()} == {(1, 4), (2, 3)}
    parts = [own.read.parquet(f"{scratch}/lost/s{k}").withColumn("batch_id", F.lit(k)) for k in (0, 1)]
    assert {(r.user_id, r.highest_funnel_stage) for r in streamed.last_updates(parts[0].unionByName(parts[1])).collect()} == {(1, 1), (2, 3)}


def test_late_emitted_and_open_events_are_all_that_were_read(own, scratch):
    batches = [[(1, 1, "add_to_cart", 3, at(0)), (2, 1, "add_to_cart", 4, at(100))],
               [(3, 2, "add_to_cart", 5, at(80)), (4, 2, "add_to_cart", 5, at(86)), (5, 2, "page_view", None, at(300))],
               [(6, 3, "add_to_cart", 6, at(20)), (7, 1, "add_to_cart", 1, at(284)), (8, 1, "add_to_cart", 1, at(286)), (9, 4, "add_to_cart", 2, at(301))]]
    for rows in batches:
        write_events(f"{scratch}/in", rows)
    finish(jobs.start_late_events(own, stream_envelopes(own, f"{scratch}/in", 1), f"{scratch}/late", f"{scratch}/clock", P.cart_watermark_s, P.session_gap_s,
                                  f"{scratch}/ckl", NOW, f"{scratch}/ontime", name="t_late"))
    late = {r.event_id for r in own.read.parquet(f"{scratch}/late").collect()}
    counted = [sessions.SessionAgg("n", F.lit(1), "count")]
    stream = own.readStream.schema(schemas.EVENT).option("maxFilesPerTrigger", "1").parquet(f"{scratch}/ontime")
    stream = stream.withWatermark("time_generated", f"{P.cart_watermark_s} seconds")
    out = sessions.sessionize(stream, "user_id", "time_generated", P.session_gap_s, counted)
    finish(out.writeStream.format("parquet").option("path", f"{scratch}/out").option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())
    emitted = sum(r.n for r in own.read.parquet(f"{scratch}/out").collect())
    held = own.read.format("statestore").load(f"{scratch}/ck")
    held = sum(r.n for r in held.select(F.explode(F.array("value.count")).alias("n")).collect())
    # 3 ends at 85 and 6 at 25, before 90 and 290; 4 ends at 91 and 7 at 289, on either side of their watermarks
    assert late == {3, 6, 7} and len(late) + emitted + held == 9


def test_a_failure_between_two_tables_shows_neither(own, scratch):
    root = f"{scratch}/tables"
    batch = own.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    both = {"ids": lambda b: b.select("id"), "names": lambda b: b.select("name")}
    snapshots.publish(batch, root, 0, both)

    def broken(b):
        raise RuntimeError("lost")
    with pytest.raises(RuntimeError):
        snapshots.publish(batch.withColumn("id", F.col("id") + 10), root, 1, {"ids": both["ids"], "names": broken})

    def ids(upto=None):
        return sorted(r.id for r in snapshots.read_published(own, root, "ids", own.createDataFrame([], "id long").schema, upto).collect())
    assert ids() == [1, 2] and len(os.listdir(f"{root}/ids")) == 2  # written, not shown
    for _ in range(2):  # the batch is run again, and once more
        snapshots.publish(batch.withColumn("id", F.col("id") + 10), root, 1, both)
    assert ids() == [1, 2, 11, 12] and ids(0) == [1, 2] and snapshots.entries(own, root).where("snapshot = 1").count() == 2
    assert snapshots.read_published(own, f"{scratch}/none", "ids", own.createDataFrame([], "id long").schema).count() == 0


def test_an_upsert_rewrites_only_touched_buckets(own, scratch):
    schema = own.createDataFrame([], "k long, v string, t long").schema
    table = snapshots.UpsertTable(own, f"{scratch}/u", schema, "k", "t", buckets=8)
    assert table.read().count() == 0 and table.snapshot() == (-1, {})
    table.upsert(own.createDataFrame([(k, "old", 1) for k in range(100)] + [(None, "x", 1)], schema))
    before = table.snapshot()[1]
    bytes_before = {p: {f: open(f, "rb").read() for f in glob.glob(f"{p}/*.parquet")} for p in before.values()}
    number = table.upsert(own.createDataFrame([(5, "new", 2), (5, "newer", 3), (5, "older", 0), (200, "first", 1)], schema))
    after = table.snapshot()[1]
    touched = {b for b in after if after[b] != before.get(b)}
    want = {r.b for r in own.createDataFrame([(5,), (200,)], "k long").select(F.pmod(F.xxhash64("k"), F.lit(8)).alias("b")).collect()}
    assert number == 1 and touched == want and len(before) == 8
    assert all({f: open(f, "rb").read() for f in glob.glob(f"{p}/*.parquet")} == bytes_before[p] for p in before.values())
    rows = {r.k: (r.v, r.t) for r in table.read().collect()}
    assert len(rows) == 101 and rows[5] == ("newer", 3) and rows[200] == ("first", 1) and rows[7] == ("old", 1)
    assert {r.v for r in table.read(0).collect()} == {"old"}  # an earlier snapshot as it was
    table.upsert(own.createDataFrame([(5, "late", 2)], schema))
    assert {r.v for r in table.read().where("k = 5").collect()} == {"newer"}


def test_state_operators_and_open_windows(own, scratch):
    rows = [(1, at(0), at(5), 10.0), (2, at(10), at(15), 2.5), (1, at(300), at(305), 7.0)]
    own.createDataFrame(rows, schemas.PURCHASE_SESSION).write.parquet(f"{scratch}/silver")
    finish(*jobs.start_user_gold(own, f"{scratch}/silver", ParquetSink(f"{scratch}/gold"), None, f"{scratch}/ck", P, NOW, name="t_gold"))
    (left,) = maintenance.open_gold_windows(own, f"{scratch}/ck/averages").collect()
    assert (left.window_start, left.amount_so_far, left.seconds_so_far, left.sessions_so_far) == (at(240), 7.0, 5, 1)
    assert own.read.schema(schemas.GOLD_AVERAGES).parquet(f"{scratch}/gold").count() == 1
    assert [r.operatorName for r in maintenance.state_operators(own, f"{scratch}/ck/averages").collect()] == ["stateStoreSave"]


def test_unknown_and_known_purchases_are_all(spark, fixture_events, fixture_products):
    pur = events.purchases(fixture_events)
    lost = events.unknown_products(pur, fixture_products).collect()
    assert [(r.product_id, r.num_purchases, r.num_users) for r in lost] == [(50, 1, 1)]
    assert sum(r.num_purchases for r in lost) + events.enrich_with_products(pur, fixture_products).count() == pur.count()

"""Decision tests and a hot-key sessionization check."""

import random
from datetime import timedelta

from pyspark.sql import functions as F

from cartwheel import REFERENCE
from cartwheel.functions.columns import pct, ratio2
from cartwheel.operators import sessions
from cartwheel.sources import stream_envelopes
from cartwheel.streaming import jobs
from cartwheel.streaming.sinks import Trigger
from conftest import EVENT_ROWS, T0, at
from stream_util import write_events

NOW = Trigger(available_now=True)


def test_d15_round_half_up(spark):
    r = spark.range(1).select(ratio2(F.lit(1), F.lit(8)).alias("a"),
                              pct(F.lit(1), F.lit(800)).alias("b")).first()
    assert (r["a"], r["b"]) == (0.13, 0.13)   # Python's round would give 0.12


def test_d2_stream_dedup_drops_duplicate_send(spark, scratch, fixture_products):
    src = f"{scratch}/src"
    write_events(src, [(e, u, t, p, at(s)) for e, u, t, p, s in EVENT_ROWS])
    q = jobs.start_product_summary(spark, stream_envelopes(spark, src), fixture_products,
                                   f"{scratch}/product", f"{scratch}/category", f"{scratch}/ck",
                                   REFERENCE.with_(dedup=True), NOW)
    q.awaitTermination(120)
    prod = spark.read.parquet(f"{scratch}/product")
    assert sorted((r["product_id"], r["num_purchases"]) for r in prod.collect()) == [(3, 1), (4, 1), (7, 1)]


def test_d1_funnel_state_expires_in_event_time(spark, scratch):
    src = f"{scratch}/src"
    write_events(src, [(1, 1, "purchase", 3, at(0))])                 # user 1 reaches stage 4
    write_events(src, [(2, 2, "page_view", None, at(5000))])          # watermark moves far ahead
    write_events(src, [(3, 2, "page_view", None, at(5001))])          # next batch: timeouts fire
    write_events(src, [(4, 1, "page_view", None, at(5002))])          # user 1 back: fresh state
    params = REFERENCE.with_(funnel_timeout_s=60)
    q = jobs.start_funnel(spark, stream_envelopes(spark, src, 1), f"{scratch}/m", f"{scratch}/ck",
                          params, NOW, stages_root=f"{scratch}/stages")
    q.awaitTermination(180)
    assert q.exception() is None
    st = spark.read.parquet(f"{scratch}/stages")
    user1 = sorted((r["batch_id"], r["highest_funnel_stage"]) for r in st.where("user_id = 1").collect())
    assert user1[0][1] == 4 and user1[-1][1] == 1


def test_users_of_one_state_bucket_expire_each_for_itself(spark, scratch, monkeypatch):
    from cartwheel.streaming import funnel_state
    monkeypatch.setattr(funnel_state, "BUCKETS", 1, raising=False)
    src = f"{scratch}/src"
    write_events(src, [(1, 1, "purchase", 3, at(0)), (2, 2, "add_to_cart", 3, at(4990)), (3, 3, "purchase", 3, at(0))])
    write_events(src, [(4, 4, "page_view", None, at(5000)), (5, 1, "search", None, at(5000))])  # watermark far ahead
    write_events(src, [(6, 4, "page_view", None, at(5001)), (7, 2, "page_view", None, at(5001))])
    write_events(src, [(8, 3, "page_view", None, at(5002)), (9, 1, "page_view", None, at(5002))])
    q = jobs.start_funnel(spark, stream_envelopes(spark, src, 1), f"{scratch}/m", f"{scratch}/ck", REFERENCE.with_(funnel_timeout_s=60),
                          NOW, stages_root=f"{scratch}/stages")
    q.awaitTermination(180)
    assert q.exception() is None
    got = [tuple(r) for r in spark.read.parquet(f"{scratch}/stages").select("batch_id", "user_id", "highest_funnel_stage", "event_time").collect()]
    by_user = {u: [(s, t) for _, x, s, t in sorted(got) if x == u] for u in (1, 2, 3, 4)}
    assert by_user == {1: [(4, at(0)), (4, at(5000)), (4, at(5002))],  # back in the batch of its timeout: kept
                       2: [(3, at(4990)), (3, at(5001))], 3: [(4, at(0)), (1, at(5002))],  # 3 timed out meanwhile
                       4: [(1, at(5000)), (1, at(5001))]}
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]) == 1


def test_hot_user_sessions_match_session_window(spark):
    rnd = random.Random(7)
    rows, eid = [], 0
    for user, n in ((0, 3000), (1, 40), (2, 40)):
        t = 0.0
        for _ in range(n):
            t += rnd.choice([0.5, 1, 2, 3, 8, 30, 400])
            eid += 1
            rows.append((eid, user, T0 + timedelta(seconds=t), rnd.randint(1, 5)))
    df = spark.createDataFrame(rows, "event_id bigint, user_id bigint, time_generated timestamp, v bigint")
    ours = sessions.sessionize(df, "user_id", "time_generated", 5,
                               [sessions.SessionAgg("total", F.col("v"), "sum")])
    ref = (df.groupBy("user_id", F.session_window("time_generated", "5 seconds"))
           .agg(F.sum("v").alias("total"))
           .select("user_id", F.col("session_window.start").alias("session_start"),
                   F.col("session_window.end").alias("session_end"), "total"))
    assert ours.count() == ref.count() > 100
    assert ours.exceptAll(ref).count() == 0


def test_d18_funnel_ignores_null_users_and_malformed_rows(spark):
    from cartwheel import schemas
    from cartwheel.operators import funnel
    rows = [(1, 1, "purchase", 3, T0, None), (2, None, "search", None, T0, None),
            (None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, schemas.EVENT)
    us = funnel.user_stage(df).collect()
    assert [(r["user_id"], r["highest_funnel_stage"]) for r in us] == [(1, 4)]


def test_state_deadline_respects_session_time_zone():
    import pandas as pd
    from cartwheel.streaming.funnel_state import epoch_ms
    wall = pd.Timestamp("2026-01-01 00:00:00")            # naive, as Arrow delivers it
    assert epoch_ms(wall, "UTC") == 1767225600000
    assert epoch_ms(wall, "America/New_York") == 1767225600000 + 5 * 3600 * 1000


def test_duplicate_send_in_a_later_batch_is_dropped(spark, scratch, fixture_products):
    src = f"{scratch}/src"
    write_events(src, [(4, 1, "purchase", 3, at(9))])
    write_events(src, [(4, 1, "purchase", 3, at(9)), (5, 1, "purchase", 3, at(12))])  # resend + new
    q = jobs.start_product_summary(spark, stream_envelopes(spark, src, 1), fixture_products,
                                   f"{scratch}/product", f"{scratch}/category", f"{scratch}/ck",
                                   REFERENCE.with_(dedup=True), NOW)
    q.awaitTermination(120)
    assert q.exception() is None
    prod = spark.read.parquet(f"{scratch}/product")
    # two batches; product 3 bought twice in total (event 4 once, event 5 once)
    assert sorted((r["batch_id"], r["num_purchases"]) for r in prod.collect()) == [(0, 1), (1, 1)]

"""The batch sessionizer equals Spark's session_window and a brute-force
model, on random events and on the driver's table."""

from datetime import timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartwheel.operators import sessions
from cartwheel.sources import harness
from conftest import T0



def aggs():
    return [sessions.SessionAgg("n", F.lit(1), "count"),
            sessions.SessionAgg("total", F.col("v"), "sum"),
            sessions.SessionAgg("top", F.col("v"), "max"),
            sessions.SessionAgg("items", F.col("item"), "set")]


def brute(events, gap):
    out = []
    by_user = {}
    for u, s, v, item in events:
        by_user.setdefault(u, []).append((s, v, item))
    for u, evs in by_user.items():
        evs.sort(key=lambda e: e[0])
        cur = None
        for s, v, item in evs:
            if cur is None or s - cur["last"] > gap:
                if cur:
                    out.append(cur)
                cur = {"u": u, "start": s, "last": s, "n": 0, "total": 0, "top": None, "items": set()}
            cur["last"] = s
            cur["n"] += 1
            cur["total"] += v
            cur["top"] = v if cur["top"] is None else max(cur["top"], v)
            if item is not None:
                cur["items"].add(item)
        out.append(cur)
    return sorted((c["u"], c["start"], c["last"] + gap, c["n"], c["total"], c["top"], sorted(c["items"]))
                  for c in out)


def as_rows(df):
    return sorted((r["user_id"], int((r["session_start"] - T0).total_seconds()),
                   int((r["session_end"] - T0).total_seconds()), r["n"], r["total"], r["top"], r["items"])
                  for r in df.collect())


event_lists = st.lists(
    st.tuples(st.integers(0, 3), st.integers(0, 400), st.integers(0, 9),
              st.one_of(st.none(), st.integers(0, 5))),
    min_size=1, max_size=60)


@settings(max_examples=25, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(events=event_lists, gap=st.sampled_from([1, 5, 17, 60]), slice_s=st.sampled_from([None, 1, 3]))
def test_random_events_match_brute_force(spark, events, gap, slice_s):
    df = spark.createDataFrame(
        [(u, T0 + timedelta(seconds=s), v, item) for u, s, v, item in events],
        "user_id bigint, time_generated timestamp, v bigint, item bigint")
    got = as_rows(sessions.sessionize(df, "user_id", "time_generated", gap, aggs(), slice_s))
    assert got == brute(events, gap)


def test_driver_table_matches_session_window(spark):
    ev = harness.events(spark, "/root/testdata/sf0.01")
    gap = 6 * 3600
    ours = sessions.session_carts(ev, gap)
    ref = (ev.groupBy("user_id", F.session_window("time_generated", f"{gap} seconds"))
           .agg(F.array_sort(F.collect_set(F.when(F.col("event_type") == "add_to_cart",
                                                  F.col("product_id")))).alias("cart_products"),
                F.max(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).alias("has_purchased"))
           .select("user_id", F.col("session_window.start").alias("session_start"),
                   F.col("session_window.end").alias("session_end"), "cart_products", "has_purchased"))
    assert ours.count() == 5725
    assert ours.exceptAll(ref).count() == 0 and ref.exceptAll(ours).count() == 0

"""Operators on the hand-written fixture (FIXTURES.md §2), 5 s gap."""

from datetime import datetime

from pyspark.sql import functions as F

from cartwheel import schemas
from cartwheel.operators import events as E
from cartwheel.operators import funnel, gold, serving, sessions, summaries
from conftest import at

GAP = 5


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def _sessions(fixture_events, fixture_products, dedup):
    ev = E.dedup_events(fixture_events) if dedup else fixture_events
    enr = E.enrich_with_products(E.purchases(ev), fixture_products)
    return sessions.purchase_sessions(enr, GAP)


def test_abandoned_carts(fixture_events):
    ab = sessions.abandoned_carts(sessions.session_carts(fixture_events, GAP))
    assert rows(ab, "user_id", "product_ids", "ts") == [(2, [4, 5], at(8))]


def test_cart_message_value(fixture_events):
    msg = sessions.cart_messages(sessions.abandoned_carts(sessions.session_carts(fixture_events, GAP)))
    (r,) = msg.collect()
    assert r["key"] == "2"
    assert r["value"] == '{"user_id":2,"product_ids":[4,5],"ts":"2026-01-01T00:00:08.000Z"}'


def test_purchase_sessions_dedup_on(fixture_events, fixture_products):
    ps = _sessions(fixture_events, fixture_products, dedup=True)
    assert rows(ps, "user_id", "session_start", "session_end", "total_amount") == [
        (1, at(9), at(14), 4.0), (2, at(20), at(25), 100.0), (5, at(2), at(7), 21.0)]


def test_purchase_sessions_dedup_off(fixture_events, fixture_products):
    ps = _sessions(fixture_events, fixture_products, dedup=False)
    assert rows(ps, "user_id", "total_amount") == [(1, 8.0), (2, 100.0), (5, 21.0)]


def test_product_and_category_summary(fixture_events, fixture_products):
    ps = summaries.product_summary(E.purchases(E.dedup_events(fixture_events)), fixture_products)
    assert rows(ps, "product_id", "name", "category", "num_purchases", "revenue") == [
        (3, "Coffee Mug", "Home", 1, 4.0), (4, "Gaming Chair", "Furniture", 1, 100.0),
        (7, "Mechanical Keyboard", "Electronics", 1, 21.0)]
    cs = summaries.category_summary(ps)
    assert cs.columns == ["category", "num_products", "num_purchases", "revenue"]
    assert rows(cs, "category", "num_products", "num_purchases", "revenue") == [
        ("Electronics", 1, 1, 21.0), ("Furniture", 1, 1, 100.0), ("Home", 1, 1, 4.0)]


def test_funnel(fixture_events):
    us = funnel.user_stage(fixture_events)
    assert rows(us, "user_id", "highest_funnel_stage") == [(1, 4), (2, 4), (3, 4), (4, 0), (5, 4)]
    m = funnel.funnel_metrics(funnel.stage_counts(us))
    assert rows(m, "funnel_stage", "user_count", "dropoff_rate_pct", "conversion_rate_pct") == [
        (1, 4, 0.0, 100.0), (2, 4, 0.0, 100.0), (3, 4, 0.0, 100.0), (4, 4, 100.0, 0.0)]


def test_funnel_event_time_is_max(fixture_events):
    us = funnel.user_stage(fixture_events)
    assert dict(rows(us, "user_id", "event_time"))[2] == at(20)


def test_gold_and_serving(fixture_events, fixture_products):
    ps = _sessions(fixture_events, fixture_products, dedup=True)
    ga = gold.gold_averages(ps, 120)
    assert rows(ga, "window_start", "total_amount", "total_session_duration_seconds",
                "session_count") == [(at(0), 125, 15, 3)]
    gs = gold.gold_spend_distribution(ps, 120, 20)
    assert rows(gs, "window_start", "bucket_start", "bucket_end", "bucket_label", "session_count") == [
        (at(0), 0, 20, "0-20", 1), (at(0), 20, 40, "20-40", 1), (at(0), 100, 120, "100-120", 1)]
    as_of = datetime(2026, 1, 1, 1, 0, 0)
    kpi = serving.kpi_averages(serving.recent(ga, 7200, as_of)).collect()[0]
    assert (kpi["average_order_value"], kpi["average_session_duration"]) == (41.67, 5.0)
    hist = serving.spend_histogram(serving.recent(gs, 7200, as_of), 20).collect()
    assert [(r["bucket_start"], r["session_count"]) for r in hist] == [
        (0, 1), (20, 1), (40, 0), (60, 0), (80, 0), (100, 1)]
    assert [r["bucket_label"] for r in hist][2] == "40-60"
    tot = serving.spend_histogram_totals(serving.recent(gs, 7200, as_of)).collect()[0]
    assert (tot["total_sessions"], tot["active_buckets"], tot["min_bucket"], tot["max_bucket"]) == (3, 3, 0, 100)


def test_no_recent_windows_gives_zero_kpis(fixture_events, fixture_products):
    ps = _sessions(fixture_events, fixture_products, dedup=True)
    ga = gold.gold_averages(ps, 120)
    kpi = serving.kpi_averages(serving.recent(ga, 7200, datetime(2026, 2, 1))).collect()[0]
    assert (kpi["average_order_value"], kpi["average_session_duration"], kpi["session_count"]) == (0.0, 0.0, 0)
    hist = serving.spend_histogram(serving.recent(gold.gold_spend_distribution(ps, 120, 20), 7200,
                                                  datetime(2026, 2, 1)), 20)
    assert hist.count() == 0


def test_purchase_flag_and_filter(fixture_events):
    fl = E.with_purchase_flag(fixture_events)
    assert dict(rows(fl, "event_id", "is_purchase"))[8] == 1
    assert dict(rows(fl, "event_id", "is_purchase"))[7] == 0
    assert E.purchases(fixture_events).count() == 5
    # D19 variant gives the same rows
    assert E.purchases(fixture_events, watermark_from="all").count() == 5


def test_unknown_product_dropped_by_join(fixture_events, fixture_products):
    enr = E.enrich_with_products(E.purchases(fixture_events), fixture_products)
    assert 50 not in [r["product_id"] for r in enr.collect()]


def test_dedup_is_deterministic(spark):
    df = spark.createDataFrame(
        [(1, 1, "a", None, at(5), None), (1, 1, "b", None, at(3), None), (2, 2, "c", None, at(1), None)],
        "event_id bigint, user_id bigint, event_type string, product_id bigint, "
        "time_generated timestamp, time_received timestamp")
    out = rows(E.dedup_events(df), "event_id", "event_type")
    assert out == [(1, "b"), (2, "c")]
    assert E.dedup_events(df).columns == df.columns


def test_latest_per_key(spark):
    df = spark.createDataFrame([(2, [1], at(10)), (2, [4, 5], at(30)), (3, [7], at(5))],
                               "user_id bigint, product_ids array<bigint>, ts timestamp")
    out = serving.latest_per_key(df, "user_id", "ts")
    assert rows(out, "user_id", "product_ids", "ts") == [(2, [4, 5], at(30)), (3, [7], at(5))]
    kept = serving.latest_per_key(df, "user_id", "ts", retention_s=10, as_of=at(35))
    assert rows(kept, "user_id", "ts") == [(2, at(30))]


def test_session_end_and_exact_gap(spark):
    df = spark.createDataFrame([(1, at(0)), (1, at(5)), (1, at(11)), (2, None)],
                               "user_id bigint, time_generated timestamp")
    out = sessions.sessionize(df, "user_id", "time_generated", 5,
                              [sessions.SessionAgg("n", F.lit(1), "sum")])
    assert rows(out, "user_id", "session_start", "session_end", "n") == [
        (1, at(0), at(10), 2), (1, at(11), at(16), 1)]


def test_lookback_defaults_to_now(spark):
    from datetime import datetime, timedelta
    from cartwheel import schemas
    now = datetime.now()  # the test process runs in UTC (conftest)
    gold_rows = [(now - timedelta(hours=1), 10, 5, 1), (now - timedelta(days=3), 99, 9, 9)]
    g = spark.createDataFrame(gold_rows, schemas.GOLD_AVERAGES)
    kept = serving.recent(g, 2 * 3600).collect()          # as_of=None -> current_timestamp()
    assert [r["total_amount"] for r in kept] == [10]


def test_lookback_accepts_an_offset_aware_as_of(spark):
    from datetime import datetime, timedelta, timezone
    from cartwheel import schemas
    g = spark.createDataFrame([(datetime(2026, 1, 1, 0, 30), 10, 5, 1),
                               (datetime(2025, 12, 31, 20, 0), 99, 9, 9)], schemas.GOLD_AVERAGES)
    aware = datetime(2026, 1, 1, 2, 0, tzinfo=timezone(timedelta(hours=1)))   # = 01:00 UTC
    kept = serving.recent(g, 3600, aware).collect()
    assert [r["total_amount"] for r in kept] == [10]


def test_summary_totals_count_a_product_once(spark):
    from cartwheel.operators import summaries
    days = spark.createDataFrame([(1, "a", "x", 2, 4.0), (1, "a", "x", 1, 2.0), (2, "b", "x", 1, 0.5)],
                                 "product_id long, name string, category string, num_purchases long, revenue double")
    whole, category = summaries.summary_totals(days)
    assert rows(whole, "product_id", "num_purchases", "revenue") == [(1, 3, 6.0), (2, 1, 0.5)]
    assert [tuple(r) for r in category.collect()] == [("x", 2, 4, 6.5)]


def test_dedup_keeps_events_without_an_id(spark):
    df = spark.createDataFrame([(None, 1, "a", None, at(1), None), (None, 2, "a", None, at(1), None), (7, 1, "a", None, at(1), None),
                                (7, 1, "a", None, at(1), None)], schemas.EVENT)
    assert rows(E.dedup_events(df).fillna(0, ["event_id"]), "event_id", "user_id") == [(0, 1), (0, 2), (7, 1)]


def test_huge_and_missing_amounts(spark):
    ps = spark.createDataFrame([(1, at(0), at(5), 3e9), (2, at(0), at(5), None), (3, at(0), at(5), 3e9 + 45)], schemas.PURCHASE_SESSION)
    spend = gold.gold_spend_distribution(ps, 120, 20)
    hist = serving.spend_histogram(spend, 20).collect()
    assert [(r["bucket_start"], r["session_count"]) for r in hist] == [(3000000000, 1), (3000000020, 0), (3000000040, 1)]


def test_histogram_spine_is_whole_over_many_stretches(spark):
    from cartwheel.operators.serving import SPINE_STRETCH
    top = 20 * (2 * SPINE_STRETCH + 3)
    spend = spark.createDataFrame([(at(0), 0, 20, "0-20", 1), (at(0), top, top + 20, "x", 2)], schemas.GOLD_SPEND)
    got = [r["bucket_start"] for r in serving.spend_histogram(spend, 20).collect()]
    assert got == list(range(0, top + 1, 20))

"""Edge fixtures (FIXTURES.md §3)."""

from pyspark.sql import functions as F

from cartwheel import schemas
from cartwheel.operators import decode, funnel


def _env(spark, values, keys=None):
    keys = keys or [None] * len(values)
    rows = [(None if k is None else k.encode(), None if v is None else v.encode(), "t", 0, i, None, 0)
            for i, (k, v) in enumerate(zip(keys, values))]
    return spark.createDataFrame(rows, schemas.ENVELOPE)


def test_malformed_events_are_permissive(spark):
    env = _env(spark, ['not json', '{"event_id":"x","user_id":2}', '{"event_id":9,"time_generated":"garbage"}'])
    out = [r.asDict() for r in decode.decode_events(env).collect()]
    assert all(v is None for v in out[0].values())
    assert out[1]["event_id"] is None and out[1]["user_id"] == 2
    assert out[2]["event_id"] == 9 and out[2]["time_generated"] is None


def test_dlq_reasons(spark):
    env = _env(spark, [
        'not json',
        '{"event_id":1,"user_id":2,"event_type":"x","time_generated":"2026-01-01T00:00:00Z"}',
        '{"event_id":1,"event_type":"x","time_generated":"2026-01-01T00:00:00Z"}',
        '{"event_id":1,"user_id":2,"event_type":"x","time_generated":"garbage"}',
        '{"event_id":"x","user_id":2,"event_type":"x","time_generated":"2026-01-01T00:00:00Z"}',
        '[1,2]',
    ])
    routed = decode.route_events(env)
    assert [r["error_reason"] for r in routed.collect()] == [
        "invalid_json", None, "missing_field:user_id", "bad_timestamp", "schema_mismatch", "invalid_json"]
    valid, dlq = decode.split_routes(routed)
    assert valid.count() == 1 and dlq.count() == 5
    assert dlq.columns == ["raw_value", "error_reason", "received_at"]


def test_dlq_keeps_kinds_of_json_apart(spark):
    good = '"event_id":1,"user_id":2,"event_type":"x","time_generated":"2026-01-01T00:00:00Z"'
    cases = {
        "{" + good + "}": None,
        "{" + good.replace(":1,", ':"1",') + "}": "schema_mismatch",
        "{" + good.replace(":1,", ":1.5,") + "}": "schema_mismatch",
        "{" + good.replace(":1,", ":true,") + "}": "schema_mismatch",
        "{" + good.replace(":1,", ":99999999999999999999,") + "}": "schema_mismatch",
        "{" + good.replace(":2,", ":null,") + "}": "missing_field:user_id",
        "{" + good + ',"product_id":null}': None,
        "{" + good + ',"product_id":"7"}': "schema_mismatch",
        "{" + good + ',"other":{"a":[1]}}': None,
        "{" + good + ',"time_received":1767225600}': None,
        "{" + good.replace('"x"', "5") + "}": None,
        "{" + good + "": "invalid_json",
        '"text"': "invalid_json", "7": "invalid_json", "null": "invalid_json", "": "invalid_json", "[{" + good + "}]": "invalid_json", " \n{" + good + "}": None, "{}": "missing_field:event_id",
    }
    rows = {r["raw_value"]: r for r in decode.route_events(_env(spark, [*cases, None])).collect()}
    assert {k: rows[k]["error_reason"] for k in cases} == cases
    assert rows[None]["error_reason"] == "invalid_json"
    by = list(cases)
    assert rows[by[10]]["event_type"] == "5" and rows[by[9]]["time_received"] == rows[by[0]]["time_generated"]
    assert rows[by[1]]["event_id"] is None and rows[by[1]]["user_id"] == 2


def test_dlq_parses_a_good_message_once(spark):
    plan = decode.route_events(_env(spark, ["{}"]))._jdf.queryExecution().executedPlan().toString().lower()
    assert plan.count("from_json(") == 2 and plan.count("then from_json(map") == 1


def test_topic_values_json_or_raw(spark):
    env = _env(spark, ['{"user_id":2,"product_ids":[4,5],"ts":"2026-01-01T00:00:08.000Z"}', "plain text"],
               keys=["2", None])
    out = decode.decode_topic(env, schemas.CART_MESSAGE).collect()
    assert out[0]["key"] == "2" and out[0]["value"]["product_ids"] == [4, 5] and out[0]["raw_value"] is None
    assert out[1]["key"] is None and out[1]["value"] is None and out[1]["raw_value"] == "plain text"


def _counts(spark, d):
    return spark.createDataFrame(list(d.items()), "highest_funnel_stage int, user_count bigint")


def test_funnel_counts_with_gaps(spark):
    m = funnel.funnel_metrics(_counts(spark, {1: 5, 3: 2, 0: 9})).orderBy("funnel_stage").collect()
    assert [r["user_count"] for r in m] == [7, 2, 2, 0]
    assert [r["dropoff_rate_pct"] for r in m] == [71.43, 0.0, 100.0, None]
    assert [r["conversion_rate_pct"] for r in m] == [28.57, 100.0, 0.0, None]


def test_funnel_only_stage_zero_is_typed(spark):
    m = funnel.funnel_metrics(_counts(spark, {0: 3}))
    assert dict(m.dtypes) == {"funnel_stage": "bigint", "user_count": "bigint",
                              "dropoff_rate_pct": "double", "conversion_rate_pct": "double"}
    out = m.collect()
    assert [r["user_count"] for r in out] == [0, 0, 0, 0]
    assert all(r["dropoff_rate_pct"] is None and r["conversion_rate_pct"] is None for r in out)


def test_funnel_empty_batch_still_four_rows(spark):
    empty = _counts(spark, {}).where(F.lit(False))
    assert funnel.funnel_metrics(empty).count() == 4


def test_funnel_per_batch(spark):
    c = spark.createDataFrame([(0, 1, 2), (0, 4, 1), (1, 2, 3)],
                              "batch_id bigint, highest_funnel_stage int, user_count bigint")
    m = funnel.funnel_metrics(c, by=["batch_id"])
    got = sorted((r["batch_id"], r["funnel_stage"], r["user_count"]) for r in m.collect())
    assert got[:4] == [(0, 1, 3), (0, 2, 1), (0, 3, 1), (0, 4, 1)]
    assert got[4:] == [(1, 1, 3), (1, 2, 3), (1, 3, 0), (1, 4, 0)]


def test_bad_time_received_is_a_bad_timestamp(spark):
    env = _env(spark, ['{"event_id":1,"user_id":2,"event_type":"x",'
                       '"time_generated":"2026-01-01T00:00:00Z","time_received":"soon"}'])
    (r,) = decode.route_events(env).collect()
    assert r["error_reason"] == "bad_timestamp" and r["event_id"] == 1


def test_tombstone_value_decodes_to_nulls(spark):
    env = _env(spark, [None], keys=["7"])
    (r,) = decode.decode_topic(env, schemas.CART_MESSAGE).collect()
    assert (r["key"], r["value"], r["raw_value"]) == ("7", None, None)

"""Independent SQL statement of every catalogue query, for DuckDB.

Written from the query semantics, not from the Spark plans: sessions use the
textbook lag-and-running-sum form, windows use epoch arithmetic. Tables
``events`` and ``part`` are views over the same parquet files.
"""

from __future__ import annotations

from cartwheel.params import HARNESS, Params


def _ctes(p: Params) -> dict[str, str]:
    gap = int(p.session_gap_s)
    win_us = int(p.gold_window_s * 1_000_000)
    width = int(p.bucket_width)
    as_of = p.as_of.strftime("%Y-%m-%d %H:%M:%S")
    look = int(p.look_back_s)
    ret = int(p.cart_retention_s)
    c: dict[str, str] = {}
    c["ev"] = """ev AS (
  SELECT CAST(event_id AS BIGINT) AS event_id, CAST(user_id AS BIGINT) AS user_id,
    CASE event_type WHEN 'view' THEN 'page_view' WHEN 'signup' THEN 'search'
      WHEN 'click' THEN 'product_view' WHEN 'error' THEN 'add_to_cart'
      WHEN 'purchase' THEN 'purchase' ELSE event_type END AS event_type,
    CASE WHEN event_type NOT IN ('view', 'signup')
      THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS product_id,
    CAST(ts AS TIMESTAMP) AS time_generated,
    CAST(NULL AS TIMESTAMP) AS time_received,
    event_type AS src_type, value AS src_value
  FROM events)"""
    c["pr"] = """pr AS (
  SELECT CAST(p_partkey AS BIGINT) AS product_id, p_name AS name, p_type AS category,
    CAST(p_retailprice AS DOUBLE) AS cost FROM part)"""
    c["enr"] = """enr AS (
  SELECT e.event_id, e.user_id, e.product_id, e.time_generated, p.name, p.category, p.cost
  FROM ev e JOIN pr p ON e.product_id = p.product_id
  WHERE e.event_type = 'purchase')"""

    def sessions(name: str, src: str, aggs: str, gap: int = gap) -> str:
        return f"""{name} AS (
  SELECT user_id, min(time_generated) AS session_start,
    max(time_generated) + INTERVAL {gap} SECOND AS session_end, {aggs}
  FROM (
    SELECT *, sum(ns) OVER (PARTITION BY user_id ORDER BY time_generated, event_id
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
    FROM (
      SELECT *, CASE WHEN time_generated - lag(time_generated) OVER (
                  PARTITION BY user_id ORDER BY time_generated, event_id)
                  <= INTERVAL {gap} SECOND THEN 0 ELSE 1 END AS ns
      FROM {src} WHERE time_generated IS NOT NULL AND user_id IS NOT NULL) a) b
  GROUP BY user_id, sid)"""

    c["carts"] = sessions("carts", "ev", """
    coalesce(array_to_string(list_sort(list_distinct(list(
      CASE WHEN event_type = 'add_to_cart' THEN product_id END))), ','), '') AS cart_products,
    max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS has_purchased""")
    c["ab"] = """ab AS (
  SELECT user_id, cart_products AS product_ids, session_end AS ts FROM carts
  WHERE cart_products <> '' AND has_purchased = 0)"""
    c["ps"] = sessions("ps", "enr", "sum(cost) AS total_amount")
    c["us"] = """us AS (
  SELECT user_id, CAST(max(CASE event_type WHEN 'search' THEN 1 WHEN 'page_view' THEN 1
      WHEN 'product_view' THEN 2 WHEN 'add_to_cart' THEN 3 WHEN 'purchase' THEN 4
      ELSE 0 END) AS INTEGER) AS highest_funnel_stage,
    max(time_generated) AS event_time
  FROM ev WHERE user_id IS NOT NULL GROUP BY user_id)"""
    c["sc"] = """sc AS (
  SELECT highest_funnel_stage, count(user_id) AS user_count FROM us
  GROUP BY highest_funnel_stage)"""
    c["fw"] = sessions("fw", "ev", """max(CASE event_type WHEN 'search' THEN 1 WHEN 'page_view' THEN 1
      WHEN 'product_view' THEN 2 WHEN 'add_to_cart' THEN 3 WHEN 'purchase' THEN 4 ELSE 0 END) AS highest_funnel_stage""",
                       int(p.funnel_timeout_s))
    c["ga"] = f"""ga AS (
  SELECT make_timestamp(CAST(floor(epoch_us(session_start) / {win_us}) * {win_us} AS BIGINT))
      AS window_start,
    CAST(trunc(round(sum(total_amount), 6)) AS BIGINT) AS total_amount,
    CAST(sum(epoch_us(session_end) // 1000000 - epoch_us(session_start) // 1000000) AS BIGINT)
      AS total_session_duration_seconds,
    count(*) AS session_count
  FROM ps GROUP BY 1)"""
    c["gs"] = f"""gs AS (
  SELECT window_start, bucket_start, CAST(bucket_start + {width} AS BIGINT) AS bucket_end,
    CAST(bucket_start AS VARCHAR) || '-' || CAST(bucket_start + {width} AS VARCHAR) AS bucket_label,
    session_count
  FROM (
    SELECT make_timestamp(CAST(floor(epoch_us(session_start) / {win_us}) * {win_us} AS BIGINT))
        AS window_start,
      CAST(floor(total_amount / {width}) * {width} AS BIGINT) AS bucket_start,
      count(*) AS session_count
    FROM ps GROUP BY 1, 2) x)"""
    c["ra"] = f"""ra AS (
  SELECT * FROM ga WHERE window_start >= TIMESTAMP '{as_of}' - INTERVAL {look} SECOND)"""
    c["rs"] = f"""rs AS (
  SELECT * FROM gs WHERE window_start >= TIMESTAMP '{as_of}' - INTERVAL {look} SECOND)"""
    c["h"] = """h AS (
  SELECT bucket_start, bucket_end, bucket_label, CAST(sum(session_count) AS BIGINT) AS session_count
  FROM rs GROUP BY 1, 2, 3)"""
    c["ret"] = f"""TIMESTAMP '{as_of}' - INTERVAL {ret} SECOND"""
    c["width"] = str(width)
    return c


def _with(c: dict[str, str], names: list[str], body: str) -> str:
    return "WITH " + ",\n".join(c[n] for n in names) + "\n" + body


EVENT_COLS = "event_id, user_id, event_type, product_id, time_generated, time_received"


def oracle_sql(p: Params = HARNESS) -> dict[str, str]:
    c = _ctes(p)
    width = c["width"]
    q: dict[str, str] = {}
    q["decode_events"] = _with(c, ["ev"], f"SELECT {EVENT_COLS}, time_generated AS event_time FROM ev")
    sent = """sent AS (
  SELECT * FROM ev0 UNION ALL
  SELECT event_id, user_id, event_type, product_id, time_generated,
    coalesce(time_received, time_generated) + INTERVAL 1 SECOND AS time_received
  FROM ev0 WHERE event_type = 'purchase' OR event_id % 10 = 7)"""
    once = f"""SELECT {EVENT_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY event_id
  ORDER BY time_received NULLS FIRST, user_id NULLS FIRST, event_type NULLS FIRST,
  product_id NULLS FIRST, time_generated NULLS FIRST) AS copy FROM sent) s
WHERE copy = 1 OR event_id IS NULL"""
    c["ev0"] = f"ev0 AS (SELECT {EVENT_COLS} FROM ev)"
    c["lost"] = f"""ev0 AS (SELECT CASE WHEN event_type <> 'add_to_cart' THEN event_id END AS event_id,
  {EVENT_COLS.split(", ", 1)[1]} FROM ev)"""
    c["sent"] = sent
    q["dedup_events"] = _with(c, ["ev", "ev0", "sent"], once)
    q["dedup_events_dirty"] = _with(c, ["ev", "lost", "sent"], once)
    q["purchase_flag"] = _with(c, ["ev"], """SELECT event_id, user_id, event_type,
  CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS is_purchase FROM ev""")
    q["purchases"] = _with(c, ["ev"], f"SELECT {EVENT_COLS} FROM ev WHERE event_type = 'purchase'")
    q["purchases_enriched"] = _with(c, ["ev", "pr", "enr"], "SELECT * FROM enr")
    q["session_carts"] = _with(c, ["ev", "carts"], """SELECT user_id, session_start, session_end,
  cart_products, has_purchased FROM carts""")
    q["abandoned_carts"] = _with(c, ["ev", "carts", "ab"], """SELECT user_id, product_ids, ts,
  CAST(user_id AS VARCHAR) AS key,
  '{"user_id":' || CAST(user_id AS VARCHAR) || ',"product_ids":[' || product_ids
    || '],"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z"}' AS value
FROM ab""")
    q["purchase_sessions"] = _with(c, ["ev", "pr", "enr", "ps"], """SELECT user_id, session_start,
  session_end, round(total_amount, 2) AS total_amount FROM ps""")
    q["purchase_sessions_dedup"] = q["purchase_sessions"]
    prod = """SELECT product_id, name, category, count(event_id) AS num_purchases,
  round(sum(cost), 2) AS revenue FROM enr GROUP BY product_id, name, category"""
    q["product_summary"] = _with(c, ["ev", "pr", "enr"], prod)
    q["category_summary"] = _with(c, ["ev", "pr", "enr"], f"""SELECT category,
  count(product_id) AS num_products, CAST(sum(num_purchases) AS BIGINT) AS num_purchases,
  round(sum(revenue), 2) AS revenue FROM ({prod}) p GROUP BY category""")
    q["funnel_user_stage"] = _with(c, ["ev", "us"], "SELECT * FROM us")
    q["summary_totals"] = q["category_summary"]
    c["ud"] = """ud AS (
  SELECT user_id, CAST(time_generated AS DATE) AS day, CAST(max(CASE event_type WHEN 'search' THEN 1
      WHEN 'page_view' THEN 1 WHEN 'product_view' THEN 2 WHEN 'add_to_cart' THEN 3 WHEN 'purchase' THEN 4
      ELSE 0 END) AS INTEGER) AS highest_funnel_stage
  FROM ev WHERE user_id IS NOT NULL GROUP BY 1, 2)"""
    q["funnel_stage_counts"] = _with(c, ["ev", "ud"], """SELECT day, highest_funnel_stage, count(user_id) AS user_count
FROM ud GROUP BY 1, 2""")
    rates = """CASE WHEN user_count = 0 THEN NULL
       ELSE round(CAST(user_count - nxt AS DOUBLE) / user_count * 100, 2) END AS dropoff_rate_pct,
  CASE WHEN user_count = 0 THEN NULL
       ELSE round(CAST(nxt AS DOUBLE) / user_count * 100, 2) END AS conversion_rate_pct"""
    q["funnel_metrics"] = _with(c, ["ev", "ud"], f"""SELECT day, funnel_stage, user_count, {rates}
FROM (
  SELECT d.day, CAST(s.funnel_stage AS BIGINT) AS funnel_stage,
    count(*) FILTER (WHERE d.highest_funnel_stage >= s.funnel_stage) AS user_count,
    count(*) FILTER (WHERE d.highest_funnel_stage > s.funnel_stage AND s.funnel_stage < 4) AS nxt
  FROM ud d, (VALUES (1), (2), (3), (4)) s(funnel_stage) GROUP BY 1, 2) t""")
    snapshot = _with(c, ["ev", "us"], """SELECT funnel_stage, user_count,
  CASE WHEN user_count = 0 THEN NULL
       ELSE round(CAST(user_count - nxt AS DOUBLE) / user_count * 100, 2) END AS dropoff_rate_pct,
  CASE WHEN user_count = 0 THEN NULL
       ELSE round(CAST(nxt AS DOUBLE) / user_count * 100, 2) END AS conversion_rate_pct
FROM (
  SELECT CAST(s.funnel_stage AS BIGINT) AS funnel_stage,
    CAST((SELECT count(*) FROM us WHERE highest_funnel_stage >= s.funnel_stage) AS BIGINT) AS user_count,
    CAST((SELECT count(*) FROM us WHERE highest_funnel_stage >= s.funnel_stage + 1
          AND s.funnel_stage < 4) AS BIGINT) AS nxt
  FROM (VALUES (1), (2), (3), (4)) s(funnel_stage)) t""")
    base = ["ev", "pr", "enr", "ps"]
    q["gold_averages"] = _with(c, base + ["ga"], "SELECT * FROM ga")
    q["gold_spend_distribution"] = _with(c, base + ["gs"], "SELECT * FROM gs")
    q["recent_averages"] = _with(c, base + ["ga", "ra"], "SELECT * FROM ra")
    q["kpi_averages"] = _with(c, base + ["ga", "ra"], """SELECT
  coalesce(round(CAST(sum(total_amount) AS DOUBLE) / sum(session_count), 2), 0.0) AS average_order_value,
  coalesce(round(CAST(sum(total_session_duration_seconds) AS DOUBLE) / sum(session_count), 2), 0.0)
    AS average_session_duration,
  CAST(coalesce(sum(session_count), 0) AS BIGINT) AS session_count
FROM ra""")
    q["spend_histogram"] = _with(c, base + ["gs", "rs", "h"], f"""SELECT CAST(s.b AS BIGINT) AS bucket_start,
  CAST(s.b + {width} AS BIGINT) AS bucket_end,
  CAST(s.b AS VARCHAR) || '-' || CAST(s.b + {width} AS VARCHAR) AS bucket_label,
  CAST(coalesce(h.session_count, 0) AS BIGINT) AS session_count
FROM (SELECT unnest(generate_series(lo, hi, {width})) AS b
      FROM (SELECT min(bucket_start) AS lo, max(bucket_start) AS hi FROM h) m) s
LEFT JOIN h ON h.bucket_start = s.b
ORDER BY bucket_start""")
    q["stored_kpi_averages"], q["stored_spend_histogram"] = q["kpi_averages"], q["spend_histogram"]
    q["spend_histogram_totals"] = _with(c, base + ["gs", "rs", "h"], """SELECT
  CAST(coalesce(sum(session_count), 0) AS BIGINT) AS total_sessions,
  count(*) FILTER (WHERE session_count > 0) AS active_buckets,
  min(bucket_start) AS min_bucket, max(bucket_start) AS max_bucket
FROM h""")
    q["latest_abandoned_cart"] = _with(c, ["ev", "carts", "ab"], f"""SELECT user_id, max(ts) AS ts,
  arg_max(product_ids, ts) AS product_ids
FROM ab WHERE ts >= {c['ret']} GROUP BY user_id""")
    q["decode_topic"] = _with(c, ["ev", "carts", "ab"], """SELECT CAST(user_id AS VARCHAR) AS key,
  user_id, product_ids, date_trunc('millisecond', ts) AS ts, CAST(NULL AS VARCHAR) AS raw_value,
  CAST(user_id % 3 AS INTEGER) AS partition,
  CAST(user_id * 1000000007 + epoch_us(ts) // 1000000 AS BIGINT) AS "offset"
FROM ab""")
    c["msg"] = """msg AS (
  SELECT *, CASE r WHEN 'invalid_json' THEN left(clean, length(clean) - 1)
      WHEN 'bad_timestamp' THEN regexp_replace(clean, '"time_generated":"[^"]*"', '"time_generated":"garbage"')
      WHEN 'missing_field:user_id' THEN regexp_replace(clean, '"user_id":[0-9]+,', '')
      WHEN 'schema_mismatch' THEN regexp_replace(clean, '"event_id":[0-9]+', '"event_id":"x"')
      ELSE clean END AS raw_value
  FROM (SELECT *, '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"'
      || coalesce(',"product_id":' || product_id, '')
      || ',"time_generated":"' || strftime(time_generated, '%Y-%m-%dT%H:%M:%S.%f') || 'Z"}' AS clean,
    CASE WHEN src_type = 'error' THEN 'invalid_json'
         WHEN src_value < 1 THEN 'bad_timestamp'
         WHEN src_value < 2 THEN 'missing_field:user_id'
         WHEN src_value < 3 THEN 'schema_mismatch' END AS r
    FROM ev) x)"""
    q["dlq_route"] = _with(c, ["ev", "msg"], """SELECT
  CASE WHEN r IN ('invalid_json', 'schema_mismatch') THEN NULL ELSE event_id END AS event_id,
  CASE WHEN r IN ('invalid_json', 'missing_field:user_id') THEN NULL ELSE user_id END AS user_id,
  CASE WHEN r = 'invalid_json' THEN NULL ELSE event_type END AS event_type,
  CASE WHEN r = 'invalid_json' THEN NULL ELSE product_id END AS product_id,
  CASE WHEN r IN ('invalid_json', 'bad_timestamp') THEN NULL ELSE time_generated END AS time_generated,
  time_received, raw_value, time_generated AS received_at, r AS error_reason
FROM msg""")
    q["evolved_events"] = _with(c, ["ev"], f"SELECT {EVENT_COLS} FROM ev")
    q["compacted_events"] = _with(c, ["ev"], f"SELECT {EVENT_COLS}, CAST(time_generated AS DATE) AS event_date FROM ev")
    q["clustered_events"] = q["evolved_events"]
    known = "event_id % 10 < 9"
    q["versioned_events"] = _with(c, ["ev"], f"""SELECT
  CASE WHEN {known} THEN event_id END AS event_id, CASE WHEN {known} THEN user_id END AS user_id,
  CASE WHEN {known} THEN event_type END AS event_type, CASE WHEN {known} THEN time_generated END AS time_generated,
  CASE WHEN event_id % 10 BETWEEN 4 AND 8 THEN product_id END AS product_id,
  CASE WHEN event_id % 10 < 7 THEN 'web' WHEN {known} THEN 'app' END AS channel,
  CAST(CASE WHEN event_id % 10 < 4 THEN 1 WHEN event_id % 10 < 7 THEN 2 WHEN {known} THEN 3 ELSE 4 END AS BIGINT) AS schema_version,
  CASE WHEN {known} THEN NULL ELSE 'unknown_version' END AS error_reason FROM ev""")
    q["products_csv"] = _with(c, ["pr"], "SELECT * FROM pr")
    # Streamed keys: append-mode output = batch result cut at the final
    # watermark (max event time seen by the watermark node minus the delay).
    cart_wm = f"(SELECT max(time_generated) FROM ev) - INTERVAL {int(p.cart_watermark_s)} SECOND"
    pur_wm = (f"(SELECT max(time_generated) FROM ev WHERE event_type = 'purchase' "
              f"AND product_id IS NOT NULL) - INTERVAL {int(p.purchase_watermark_s)} SECOND")
    q["stream_abandoned_carts"] = q["abandoned_carts"] + f"\nWHERE ts <= {cart_wm}"
    q["stream_purchase_sessions"] = _with(c, ["ev", "pr", "enr", "ps"], f"""SELECT user_id, session_start,
  session_end, round(total_amount, 2) AS total_amount FROM ps WHERE session_end <= {pur_wm}""")
    q["stream_restarted_sessions"] = q["stream_purchase_sessions"]
    # Sliced sessions: slices come out once the watermark passes their end, and
    # the second watermark is a slice behind the latest first event of these.
    gap_us = int(p.session_gap_s) * 1_000_000
    q["stream_sliced_sessions"] = _with(c, ["ev", "pr", "enr", "ps"], f""", sl AS (
  SELECT user_id, epoch_us(time_generated) // {gap_us} AS slice, min(time_generated) AS first FROM enr
  WHERE user_id IS NOT NULL AND time_generated IS NOT NULL GROUP BY 1, 2),
closed AS (SELECT max(first) AS latest FROM sl WHERE make_timestamp((slice + 1) * {gap_us}) <= {pur_wm})
SELECT user_id, session_start, session_end, round(total_amount, 2) AS total_amount FROM ps
WHERE session_end <= (SELECT latest FROM closed) - INTERVAL {int(p.session_gap_s)} SECOND""")
    # Batches of the replay: quarters of the events' time span.
    c["bat"] = """bat AS (
  SELECT ev.*, CAST((SELECT count(*) FROM (VALUES (1), (2), (3)) s(k)
    WHERE epoch_us(time_generated) >= lo + k * round_even((hi - lo) / 4.0, 0)) AS BIGINT) AS batch_id
  FROM ev, (SELECT epoch_us(min(time_generated)) AS lo, epoch_us(max(time_generated)) AS hi FROM ev) b)"""
    q["stream_late_events"] = _with(c, ["ev", "bat"], f"""SELECT event_id, user_id, event_type, time_generated
FROM bat WHERE event_id % 10 = 3 AND time_generated + INTERVAL {int(p.session_gap_s)} SECOND <=
  (SELECT max(time_generated) FROM bat WHERE event_id % 10 <> 3 AND batch_id < 3) - INTERVAL {int(p.cart_watermark_s)} SECOND""")
    q["stream_exact_dedup"] = _with(c, ["ev", "bat"], """SELECT event_id, user_id, event_type, product_id, time_generated, batch_id
FROM bat""")
    fun_wm = f"(SELECT max(time_generated) FROM ev) - INTERVAL {int(p.funnel_watermark_s)} SECOND"
    q["stream_funnel_windows"] = _with(c, ["ev", "fw"], f"""SELECT user_id, session_start, session_end, highest_funnel_stage
FROM fw WHERE session_end <= {fun_wm}""")
    stage = """CASE event_type WHEN 'search' THEN 1 WHEN 'page_view' THEN 1 WHEN 'product_view' THEN 2
      WHEN 'add_to_cart' THEN 3 WHEN 'purchase' THEN 4 ELSE 0 END"""
    q["stream_funnel_batch_metrics"] = _with(c, ["ev", "bat"], f""", seen AS (
  SELECT DISTINCT batch_id, user_id FROM bat WHERE user_id IS NOT NULL),
st AS (SELECT s.batch_id, s.user_id, max({stage}) AS stage
  FROM seen s JOIN bat b ON b.user_id = s.user_id AND b.batch_id <= s.batch_id GROUP BY 1, 2)
SELECT batch_id, funnel_stage, user_count, {rates}
FROM (SELECT batch_id, CAST(f.funnel_stage AS BIGINT) AS funnel_stage,
    count(*) FILTER (WHERE stage >= f.funnel_stage) AS user_count,
    count(*) FILTER (WHERE stage > f.funnel_stage AND f.funnel_stage < 4) AS nxt
  FROM st, (VALUES (1), (2), (3), (4)) f(funnel_stage) GROUP BY 1, 2) t""")
    q["upserted_carts"] = _with(c, ["ev", "carts", "ab"], """SELECT user_id, arg_max(product_ids, ts) AS product_ids, max(ts) AS ts
FROM ab GROUP BY user_id""")
    q["unknown_products"] = _with(c, ["ev", "pr"], """SELECT product_id, count(*) AS num_purchases, count(DISTINCT user_id) AS num_users,
  min(time_generated) AS first_seen, max(time_generated) AS last_seen
FROM ev WHERE event_type = 'purchase' AND (product_id IS NULL OR product_id NOT IN (SELECT product_id FROM pr WHERE product_id % 7 <> 0))
GROUP BY product_id""")
    win_s = int(p.gold_window_s)
    win_us = win_s * 1_000_000
    q["stream_open_windows"] = _with(c, ["ev", "pr", "enr", "ps"], f""", s AS (
  SELECT * FROM ps WHERE session_end <= {pur_wm}),
g AS (
  SELECT make_timestamp(CAST(floor(epoch_us(session_start) / {win_us}) * {win_us} AS BIGINT)) AS window_start,
    round(sum(total_amount), 2) AS amount_so_far,
    CAST(sum(epoch_us(session_end) // 1000000 - epoch_us(session_start) // 1000000) AS BIGINT) AS seconds_so_far,
    count(*) AS sessions_so_far
  FROM s GROUP BY 1)
SELECT * FROM g WHERE window_start + INTERVAL {win_s} SECOND
  > (SELECT max(session_start) FROM s) - INTERVAL {int(p.gold_watermark_s)} SECOND""")
    q["stream_gold_averages"] = _with(c, ["ev", "pr", "enr", "ps"], f""", s AS (
  SELECT * FROM ps WHERE session_end <= {pur_wm}),
g AS (
  SELECT make_timestamp(CAST(floor(epoch_us(session_start) / {win_us}) * {win_us} AS BIGINT))
      AS window_start,
    CAST(trunc(round(sum(total_amount), 6)) AS BIGINT) AS total_amount,
    CAST(sum(epoch_us(session_end) // 1000000 - epoch_us(session_start) // 1000000) AS BIGINT)
      AS total_session_duration_seconds,
    count(*) AS session_count
  FROM s GROUP BY 1)
SELECT * FROM g WHERE window_start + INTERVAL {win_s} SECOND
  <= (SELECT max(session_start) FROM s) - INTERVAL {int(p.gold_watermark_s)} SECOND""")
    gold_s = f""", s AS (
  SELECT * FROM ps WHERE session_end <= {pur_wm})"""
    closed = (f"window_start + INTERVAL {win_s} SECOND <= (SELECT max(session_start) FROM s) "
              f"- INTERVAL {int(p.gold_watermark_s)} SECOND")
    q["stream_gold_spend_distribution"] = _with(c, ["ev", "pr", "enr", "ps"], gold_s + f""",
g AS (
  SELECT window_start, bucket_start, CAST(bucket_start + {width} AS BIGINT) AS bucket_end,
    CAST(bucket_start AS VARCHAR) || '-' || CAST(bucket_start + {width} AS VARCHAR) AS bucket_label,
    session_count
  FROM (
    SELECT make_timestamp(CAST(floor(epoch_us(session_start) / {win_us}) * {win_us} AS BIGINT))
        AS window_start,
      CAST(floor(total_amount / {width}) * {width} AS BIGINT) AS bucket_start,
      count(*) AS session_count
    FROM s GROUP BY 1, 2) x)
SELECT * FROM g WHERE {closed}""")
    q["stream_funnel_metrics"] = snapshot
    q["stream_dead_letters"] = _with(c, ["ev", "msg"], """SELECT r AS error_reason, raw_value, time_generated AS received_at
FROM msg WHERE r IS NOT NULL""")
    q["stream_product_summary"] = q["product_summary"]
    q["stream_snapshot_categories"] = q["category_summary"]
    q["stream_category_summary"] = q["category_summary"]
    q["stream_funnel_user_stage"] = q["funnel_user_stage"]
    q["stream_funnel_user_stage_native"] = q["stream_funnel_user_stage"]
    return q

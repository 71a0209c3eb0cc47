"""Command-line runner for the streaming jobs and the serving queries.

    python -m cartwheel.cli purchase-sessions --kafka broker:9092 \\
        --products products.csv --out s3://bucket/silver
    python -m cartwheel.cli user-gold --silver s3://bucket/silver \\
        --averages s3://bucket/gold/averages --spend s3://bucket/gold/spend
    python -m cartwheel.cli kpis --averages s3://bucket/gold/averages \\
        --spend s3://bucket/gold/spend
    python -m cartwheel.cli topic-dump --kafka broker:9092 --limit 20

Sources: ``--kafka SERVERS`` (topic ``--topic``, default clickstream) or
``--envelopes DIR`` (parquet files with the Kafka envelope schema).
``--once`` processes what is available and stops (``availableNow``).
"""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import fields
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from cartwheel import schemas
from cartwheel.params import HARNESS, REFERENCE, Params
from cartwheel.session import STREAMING_CONF, build_session, checkpoint_path
from cartwheel.sources import read_optional_parquet, read_products_csv, stream_envelopes, stream_topic
from cartwheel.streaming import jobs
from cartwheel.streaming.sinks import ConsoleSink, KafkaSink, ParquetSink, Trigger

PRESETS = {"reference": REFERENCE, "harness": HARNESS}


def _source(spark: SparkSession, a: argparse.Namespace, p: Params) -> DataFrame:
    if a.envelopes:
        return stream_envelopes(spark, a.envelopes, a.max_files_per_trigger)
    if a.kafka:
        # The cart job reads the topic from the beginning on first start,
        # the other jobs from the latest offsets, unless told otherwise
        first = a.starting_offsets or ("earliest" if a.job == "cart-abandonment" else p.starting_offsets)
        return stream_topic(spark, a.kafka, a.topic, first, a.max_offsets_per_trigger)
    raise SystemExit("give --kafka SERVERS or --envelopes DIR")


def _trigger(a: argparse.Namespace, default: str | None) -> Trigger:
    return Trigger(available_now=True) if a.once else Trigger(a.trigger or default)


def _convert(field: str, text: str):
    """Parse ``--set field=text`` by the type of the field's current value."""
    current = getattr(REFERENCE, field)
    if text.lower() in ("none", "null"):
        return None
    if field == "as_of":
        return datetime.fromisoformat(text)
    if isinstance(current, bool):
        return text.lower() in ("1", "true", "yes")
    if isinstance(current, int) and not isinstance(current, bool):
        return int(text)
    if isinstance(current, float) or current is None:
        return float(text)
    return text


def _params(a: argparse.Namespace) -> Params:
    p = PRESETS[a.preset]
    if getattr(a, "dedup", False):
        p = p.with_(dedup=True)
    if getattr(a, "as_of", None):
        p = p.with_(as_of=datetime.fromisoformat(a.as_of))
    names = {f.name for f in fields(Params)}
    for item in getattr(a, "set", None) or []:
        key, _, value = item.partition("=")
        if key not in names:
            raise SystemExit(f"unknown parameter {key!r}; one of {sorted(names)}")
        p = p.with_(**{key: _convert(key, value)})
    return p


def run(argv: list[str] | None = None, spark: SparkSession | None = None) -> list:
    ap = argparse.ArgumentParser(prog="cartwheel")
    ap.add_argument("job", choices=["cart-abandonment", "purchase-sessions", "product-summary",
                                    "funnel", "user-gold", "dead-letters", "kpis", "topic-dump"])
    ap.add_argument("--preset", choices=sorted(PRESETS), default="reference")
    ap.add_argument("--kafka")
    ap.add_argument("--topic", default="clickstream")
    ap.add_argument("--starting-offsets", choices=["earliest", "latest"])
    ap.add_argument("--envelopes")
    ap.add_argument("--max-files-per-trigger", type=int)
    ap.add_argument("--max-offsets-per-trigger", type=int)
    ap.add_argument("--products")
    ap.add_argument("--out")
    ap.add_argument("--out-topic", default="abandoned_carts")
    ap.add_argument("--category-out")
    ap.add_argument("--stages-out")
    ap.add_argument("--valid-out")
    ap.add_argument("--silver")
    ap.add_argument("--averages")
    ap.add_argument("--spend")
    ap.add_argument("--checkpoint")
    ap.add_argument("--trigger")
    ap.add_argument("--once", action="store_true")
    ap.add_argument("--dedup", action="store_true")
    ap.add_argument("--as-of")
    ap.add_argument("--set", action="append", metavar="PARAM=VALUE",
                    help="override any pipeline parameter, e.g. session_gap_s=300")
    ap.add_argument("--console", action="store_true", help="also print results (debug)")
    ap.add_argument("--limit", type=int, help="topic-dump: print this many records instead of writing all to --out")
    a = ap.parse_args(argv)
    spark = spark or build_session(app=f"cartwheel-{a.job}",
                                   extra=None if a.job == "kpis" else STREAMING_CONF)
    p = _params(a)

    if a.job == "kpis":
        return [_kpis(spark, a, p)]
    if a.job == "topic-dump":
        return [_topic_dump(spark, a)]
    if a.job == "user-gold":
        return jobs.start_user_gold(spark, a.silver, ParquetSink(a.averages), ParquetSink(a.spend),
                                    a.checkpoint, p, _trigger(a, "1 minute"), a.max_files_per_trigger,
                                    debug_console=a.console)
    src = _source(spark, a, p)
    if a.job == "cart-abandonment":
        sink = KafkaSink(a.kafka, a.out_topic) if a.kafka and not a.out else ParquetSink(a.out)
        started = [jobs.start_cart_abandonment(spark, src, sink, a.checkpoint, p,
                                               _trigger(a, "5 seconds"))]
        if a.console:  # K2: an independent debug query with its own state
            started.append(jobs.start_cart_abandonment(
                spark, _source(spark, a, p), ConsoleSink(),
                f"{a.checkpoint}-console" if a.checkpoint else checkpoint_path(spark, "cart_console"),
                p, _trigger(a, "5 seconds"), name="cart_abandonment_console"))
        return started
    if a.job == "dead-letters":
        return [jobs.start_dead_letters(spark, src, a.out, a.checkpoint, _trigger(a, None),
                                        valid_root=a.valid_out)]
    if a.job == "funnel":
        return [jobs.start_funnel(spark, src, a.out, a.checkpoint, p, _trigger(a, None),
                                  stages_root=a.stages_out)]
    products = read_products_csv(spark, a.products)
    if a.job == "purchase-sessions":
        return [jobs.start_purchase_sessions(spark, src, products, ParquetSink(a.out), a.checkpoint, p,
                                             _trigger(a, None))]
    return [jobs.start_product_summary(spark, src, products, a.out, a.category_out, a.checkpoint, p,
                                       _trigger(a, None))]


#: Buckets of a histogram that is read back to be printed.
PRINTED_BUCKETS = 10_000


def _kpis(spark: SparkSession, a: argparse.Namespace, p: Params) -> dict:
    """KPIs and the dense histogram over the look-back, as one JSON object.
    With ``--out`` the histogram is written there as Parquet; without it, it
    must have no more than PRINTED_BUCKETS buckets."""
    from cartwheel.operators import serving

    out: dict = {"average_order_value": 0.0, "average_session_duration": 0.0, "histogram": []}
    avg = read_optional_parquet(spark, schemas.GOLD_AVERAGES, a.averages) if a.averages else None
    if avg is not None:
        k = serving.kpi_averages(serving.recent(avg, p.look_back_s, p.as_of)).first()
        out.update(average_order_value=k["average_order_value"],
                   average_session_duration=k["average_session_duration"])
    spend = read_optional_parquet(spark, schemas.GOLD_SPEND, a.spend) if a.spend else None
    if spend is not None:
        recent = serving.recent(spend, p.look_back_s, p.as_of)
        t = serving.spend_histogram_totals(recent).first()
        out.update(total_sessions=t["total_sessions"], active_buckets=t["active_buckets"])
        histogram = serving.spend_histogram(recent, p.bucket_width)
        # one outlying amount makes the dense histogram as long as it is large
        buckets = 0 if t["max_bucket"] is None else (t["max_bucket"] - t["min_bucket"]) // int(p.bucket_width) + 1
        if a.out:
            histogram.write.mode("overwrite").parquet(a.out)
            out["histogram"] = a.out
        elif buckets <= PRINTED_BUCKETS:
            out["histogram"] = [r.asDict() for r in histogram.collect()]
        else:
            raise SystemExit(f"kpis: {buckets} buckets are too many to print, give --out")
    return out


def _topic_dump(spark: SparkSession, a: argparse.Namespace) -> dict:
    """The records of the abandoned-cart topic (Kafka from the
    earliest offsets, or envelope files), decoded: key text, value as JSON
    when it is a JSON object, else raw text. All are written to ``--out`` as
    Parquet; ``--limit`` prints the first ones instead."""
    from cartwheel.operators import decode
    from cartwheel.sources import read_topic

    env = (read_topic(spark, a.kafka, a.out_topic) if a.kafka
           else spark.read.schema(schemas.ENVELOPE).parquet(a.envelopes))
    decoded = decode.decode_topic(env, schemas.CART_MESSAGE)
    if a.limit is None:
        if not a.out:
            raise SystemExit("topic-dump: give --out or --limit")
        decoded.write.mode("overwrite").parquet(a.out)
        return {"out": a.out}
    rows = decoded.limit(a.limit).collect()
    return {"records": [{"key": r["key"], "value": r["value"].asDict() if r["value"] else None,
                         "raw_value": r["raw_value"], "partition": r["partition"],
                         "offset": r["offset"]} for r in rows]}


def main() -> None:
    started = run(sys.argv[1:])
    if started and isinstance(started[0], dict):
        print(json.dumps(started[0], default=str))
        return
    for q in started:
        q.awaitTermination()


if __name__ == "__main__":
    main()

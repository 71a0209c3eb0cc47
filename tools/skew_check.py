"""Hot-key check: one user holds a third of all events.

Derives a skewed clickstream from the events table (every third event is
re-assigned to user 0), sessionizes it with the batch slice plan and with
Spark's ``session_window``, and reports the largest number of shuffle records
any single task had to read, from each run's event log.

    python tools/skew_check.py [sf_dir] [scratch_dir]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from cartwheel.operators import sessions  # noqa: E402
from cartwheel.params import HARNESS, interval  # noqa: E402
from cartwheel.session import build_session  # noqa: E402
from cartwheel.sources import harness  # noqa: E402


def max_task_shuffle_read(log_dir: str) -> tuple[int, int]:
    """(largest shuffle records read by one task, total shuffle records read)."""
    import zstandard
    biggest = total = 0
    for f in glob.glob(f"{log_dir}/*/events_*") + glob.glob(f"{log_dir}/*.zstd"):
        raw = zstandard.ZstdDecompressor().stream_reader(open(f, "rb"))
        for line in io.TextIOWrapper(raw, encoding="utf-8"):
            ev = json.loads(line)
            if ev.get("Event") != "SparkListenerTaskEnd":
                continue
            n = ev.get("Task Metrics", {}).get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
            biggest, total = max(biggest, n), total + n
    return biggest, total


def run(plan: str, sf_dir: str, scratch: str) -> dict:
    log_dir = os.path.join(scratch, f"log-{plan}")
    os.makedirs(log_dir, exist_ok=True)
    spark = build_session("local[8]", app=f"skew-{plan}", extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}",
        # keep every shuffle partition visible (no coalescing) for the count
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    ev = harness.events(spark, sf_dir)
    hot = ev.withColumn("user_id", F.when(F.pmod("event_id", F.lit(3)) == 0, F.lit(0))
                        .otherwise(F.col("user_id")))
    gap = HARNESS.session_gap_s
    if plan == "slices":
        out = sessions.session_carts(hot, gap)
    else:
        out = (hot.groupBy("user_id", F.session_window("time_generated", interval(gap)))
               .agg(F.array_sort(F.collect_set(F.when(F.col("event_type") == "add_to_cart",
                                                     F.col("product_id")))).alias("cart_products"),
                    F.max(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).alias("has_purchased")))
    rows = out.count()
    events = hot.count()
    hot_rows = hot.where("user_id = 0").count()
    spark.stop()
    biggest, total = max_task_shuffle_read(log_dir)
    return {"plan": plan, "events": events, "hot_user_events": hot_rows, "sessions": rows,
            "max_task_shuffle_records": biggest, "total_shuffle_records": total}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="skew-")
    for plan in ("slices", "session_window"):
        print(json.dumps(run(plan, sf, scratch)))


if __name__ == "__main__":
    main()

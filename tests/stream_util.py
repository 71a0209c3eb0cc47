"""Helpers: write Kafka-envelope parquet files that a file stream replays."""

import json
import os
import time
import uuid
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.parquet as pq

ENVELOPE_ARROW = pa.schema([
    ("key", pa.binary()), ("value", pa.binary()), ("topic", pa.string()),
    ("partition", pa.int32()), ("offset", pa.int64()),
    ("timestamp", pa.timestamp("us", tz="UTC")), ("timestampType", pa.int32()),
])


def iso(t: datetime) -> str:
    return t.strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def event_json(event_id, user_id, event_type, product_id, t: datetime) -> str:
    d = {"event_id": event_id, "user_id": user_id, "event_type": event_type,
         "time_generated": iso(t)}
    if product_id is not None:
        d["product_id"] = product_id
    return json.dumps(d)


_last_mtime = [0.0]


def write_envelopes(directory: str, messages):
    """messages: iterable of (key text | None, value text | None, datetime)."""
    os.makedirs(directory, exist_ok=True)
    rows = list(messages)
    table = pa.table({
        "key": [None if k is None else k.encode() for k, _, _ in rows],
        "value": [None if v is None else v.encode() for _, v, _ in rows],
        "topic": ["clickstream"] * len(rows),
        "partition": [0] * len(rows),
        "offset": list(range(len(rows))),
        "timestamp": [t.replace(tzinfo=timezone.utc) for _, _, t in rows],
        "timestampType": [0] * len(rows),
    }, schema=ENVELOPE_ARROW)
    path = os.path.join(directory, f"part-{uuid.uuid4().hex}.parquet")
    tmp = os.path.join(os.path.dirname(directory.rstrip("/")), f".tmp-{uuid.uuid4().hex}.parquet")
    pq.write_table(table, tmp)
    # The file source replays new files in modification-time order (ms
    # resolution): give each file a strictly later time than the previous.
    mtime = max(time.time(), _last_mtime[0] + 1.0)
    _last_mtime[0] = mtime
    os.utime(tmp, (mtime, mtime))
    os.replace(tmp, path)  # appear atomically to the file source
    return path


def write_events(directory: str, events):
    """events: (event_id, user_id, type, product_id, datetime)."""
    return write_envelopes(directory, [
        (str(u), event_json(e, u, ty, p, t), t) for e, u, ty, p, t in events])

"""Clustered tables, message versions, ids kept beyond the watermark, funnel windows."""

import json
import os
import random

import pytest
from conftest import at
from pyspark.sql import functions as F
from pyspark.sql import types as T
from stream_util import write_events

from cartwheel import schemas
from cartwheel.operators import layout, versions
from cartwheel.params import REFERENCE
from cartwheel.sources.files import stream_envelopes
from cartwheel.streaming import jobs
from cartwheel.streaming.seen import SeenIds
from cartwheel.streaming.sinks import ParquetSink, Trigger

NOW = Trigger(available_now=True)
POINT = T.StructType().add("user_id", "long").add("t", "timestamp").add("v", "string")


@pytest.fixture
def own(spark):
    child = spark.newSession()
    child.conf.set("spark.sql.session.timeZone", "UTC")
    child.conf.set("spark.sql.shuffle.partitions", "2")
    return child


def points(spark, n, seed, hot=0.33):
    """Rows of random users and times, a third of them of user 7; a few nulls."""
    r = [F.rand(seed + k) for k in range(3)]
    user = F.when(r[0] < hot, 7).when(r[0] > 0.99, None).otherwise((r[1] * 1000).cast("long")).cast("long")
    return spark.range(n).select(user.alias("user_id"), F.timestamp_seconds((r[2] * 1_000_000).cast("long")).alias("t"),
                                 F.sha2(F.concat_ws("-", F.lit(seed), "id"), 256).alias("v"))


def values(df):
    return sorted(r.v for r in df.select("v").collect())


def test_compaction_rewrites_small_files_only_and_prunes(own, scratch):
    table = layout.ClusteredTable(own, f"{scratch}/t", POINT, ["user_id", "t"], target_bytes=100_000, small_bytes=20_000)
    assert table.read().count() == 0 and table.compact() is None and table.files()[0] == -1
    for k in range(3):
        table.append(points(own, 4000, 10 * k).repartition(20))
    before, whole = table.files()[1].collect(), values(table.read())
    assert len(before) == 60 and len(whole) == 12_000
    number = table.compact()
    first = table.files()[1].collect()
    assert number == 3 and 4 <= len(first) < 15 and all(f.bytes >= 20_000 for f in first)
    assert values(table.read()) == whole and values(table.read(upto=2)) == whole
    assert max(f.rows for f in first) < 3 * 12_000 / len(first)  # the hot user's rows are spread
    # a range of users is in fewer files than before, and its rows are all there
    assert len(table.read(user_id=(900, 950)).inputFiles()) < len(first) and len(table.read(2, user_id=(900, 950)).inputFiles()) == 60
    assert values(table.read(user_id=(900, 950))) == values(table.read().where("user_id between 900 and 950"))
    both = dict(user_id=(100, 400), t=(at(0).replace(year=1970), at(3 * 86400).replace(year=1970)))
    assert values(table.read(**both)) == values(table.read(2, **both)) and len(table.read(**both).inputFiles()) < len(first)
    # more small files come: the large ones stay as they are
    stamps = {f.path: os.stat(f.path.removeprefix("file://").removeprefix("file:")).st_mtime_ns for f in first}
    table.append(points(own, 1000, 99).repartition(5))
    assert table.compact() == 5
    last = {f.path for f in table.files()[1].collect()}
    assert set(stamps) < last and all(os.stat(p.removeprefix("file://").removeprefix("file:")).st_mtime_ns == s for p, s in stamps.items())
    assert table.read().count() == 13_000 and len(last) - len(first) < 5


def test_a_failed_append_shows_nothing_and_odd_columns_are_refused(own, scratch):
    table = layout.ClusteredTable(own, f"{scratch}/t", POINT, ["user_id"], target_bytes=1000)
    table.append(points(own, 50, 1))
    broken = points(own, 50, 2).withColumn("v", F.when(F.col("user_id") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        table.append(broken)
    assert table.read().count() == 50 and table.files()[0] == 0
    table.append(points(own, 0, 3))  # no rows, no files
    assert table.read().count() == 50
    with pytest.raises(ValueError):
        layout.ClusteredTable(own, f"{scratch}/u", POINT, ["v"])


def test_a_column_of_nulls_or_one_value_is_compacted(own, scratch):
    table = layout.ClusteredTable(own, f"{scratch}/t", POINT, ["user_id", "t"], target_bytes=10_000, small_bytes=10_000)
    rows = points(own, 400, 5).withColumn("user_id", F.lit(None).cast("long")).withColumn("t", F.lit(at(0)))
    table.append(rows.repartition(4))
    assert table.compact() == 1 and table.read().count() == 400 and table.read(user_id=(0, 10)).count() == 0


def test_z_order_takes_bits_in_turn(own):
    got = own.createDataFrame([(a, b) for a in range(4) for b in range(4)], "a int, b int").select("a", "b", layout.z_order([F.col("a"), F.col("b")], 2).alias("z"))
    assert {(r.a, r.b): r.z for r in got.collect()} == {(a, b): (a & 1) | (b & 1) << 1 | (a >> 1) << 2 | (b >> 1) << 3 for a in range(4) for b in range(4)}


V1 = T.StructType([T.StructField("id", T.IntegerType(), False), T.StructField("name", T.StringType())])
V2 = T.StructType([*V1.fields, T.StructField("channel", T.StringType(), False, {"default": "web"})])
V3 = T.StructType([T.StructField("id", T.LongType(), False), *V2.fields[1:], T.StructField("tags", T.ArrayType(T.IntegerType()))])


def message(version, payload):
    return b"\x00" + version.to_bytes(4, "big") + (payload if isinstance(payload, bytes) else json.dumps(payload).encode())


def test_versions_are_checked_before_they_are_let_in(own, scratch):
    log = versions.SchemaLog(own, f"{scratch}/log", "backward")
    assert log.versions() == {} and [log.register(s) for s in (V1, V2, V3, V2)] == [1, 2, 3, 2]
    assert log.versions() == {1: V1, 2: V2, 3: V3}
    required = T.StructType([*V3.fields, T.StructField("price", T.DoubleType(), False)])
    with pytest.raises(versions.IncompatibleSchema, match="price: required"):
        log.register(required)
    narrow = T.StructType([T.StructField("id", T.IntegerType(), False)])
    with pytest.raises(versions.IncompatibleSchema, match="version 3: id: bigint"):
        log.register(narrow)  # reads versions 1 and 2, not 3
    strict = T.StructType([T.StructField("name", T.StringType(), False)])
    with pytest.raises(versions.IncompatibleSchema, match="may be null"):
        log.register(strict)
    assert sorted(log.versions()) == [1, 2, 3]
    full = versions.SchemaLog(own, f"{scratch}/full", "full")
    assert full.register(V1) == 1 and full.register(V2) == 2
    with pytest.raises(versions.IncompatibleSchema):
        full.register(V3)  # a reader of version 1 can't take a long id
    forward = versions.SchemaLog(own, f"{scratch}/forward", "forward")
    assert forward.register(V2) == 1 and forward.register(V1) == 2  # the reader has a default for channel
    assert versions.problems(T.StructType().add("s", V3), T.StructType().add("s", T.StructType().add("id", "string", False))) == [
        "s.id: string can't be read as bigint"]
    with pytest.raises(ValueError):
        versions.SchemaLog(own, scratch, "sideways")


def test_messages_are_read_by_their_own_version(own):
    sent = [message(1, {"id": 1, "name": "a", "tags": [9]}), message(2, {"id": 2, "channel": "app"}), message(3, {"id": 2**40, "name": "c", "channel": "x", "tags": [1, 2]}),
            message(7, {"id": 4}), message(2, b'{"id": 5'), b"{}", None, b"", message(1, b""), message(3, {"id": "x"})]
    env = own.createDataFrame([(m,) for m in sent], "value binary")
    known = {1: V1, 2: V2, 3: V3}
    new = {bytes(r.raw_value) if r.raw_value is not None else None: r for r in versions.decode_versions(env, known, V3).collect()}
    assert len(new) == len(sent)
    assert [tuple(new[m])[:4] for m in sent[:3]] == [(1, "a", "web", None), (2, None, "app", None), (2**40, "c", "x", [1, 2])]
    assert [new[m].error_reason for m in sent] == [None, None, None, "unknown_version", "invalid_json", "no_version", "no_version", "no_version", "invalid_json", "invalid_json"]
    old = [(*tuple(r)[:3], r.error_reason) for r in versions.decode_versions(env, known, V1).collect()][:3]
    assert old == [(1, "a", 1, None), (2, None, 2, None), (None, "c", 3, "out_of_range:id")]


def test_encoded_versions_are_as_the_header_says(own):
    got = own.createDataFrame([(1, "{}"), (300, "é")], "n int, t string").select(versions.encode_version(F.col("n"), F.col("t")).alias("m")).collect()
    assert [bytes(r.m) for r in got] == [message(1, b"{}"), message(300, "é".encode())]


@pytest.mark.parametrize("blocks,hashes", [(64, 4), (1, 1)])
def test_copies_are_dropped_however_late(own, scratch, blocks, hashes):
    rng = random.Random(blocks)
    first = [(k, k % 5, "page_view", None, at(k)) for k in range(400)]
    second = [(k, k % 5, "page_view", None, at(k)) for k in range(400, 600)] + [(3, 3, "page_view", None, at(3))] * 2
    third = rng.sample(first, 100) + [(k, 1, "purchase", 2, at(10**6 + k)) for k in range(600, 700)]
    batches = [first + first[:50], second, third, []]
    for rows in batches:
        write_events(f"{scratch}/in", rows)
    seen = SeenIds(f"{scratch}/seen", blocks=blocks, hashes=hashes, buckets=4)
    jobs.start_exact_dedup(own, stream_envelopes(own, f"{scratch}/in", 1), f"{scratch}/out", seen, f"{scratch}/ck", NOW, "t_seen").awaitTermination()
    got = {(r.event_id, r.batch_id) for r in own.read.parquet(f"{scratch}/out").collect()}
    want = {(k, 0 if k < 400 else 1 if k < 600 else 2) for k in range(700)}
    assert got == want and own.read.parquet(f"{scratch}/out").count() == 700
    # a batch that is run again, here the second, finds what it found before
    again = own.createDataFrame([(*r, None) for r in second], schemas.EVENT).withColumn("event_time", F.col("time_generated"))
    seen.write(again, 1, f"{scratch}/out")
    assert {(r.event_id, r.batch_id) for r in own.read.parquet(f"{scratch}/out").collect()} == want


def test_the_filter_has_all_ids_and_few_others(own, scratch):
    seen = SeenIds(f"{scratch}/seen", blocks=4)
    ids = own.range(10_000).select(F.col("id").alias("event_id"))
    seen.add(ids, 0)
    seen.add(own.createDataFrame([(10_000,), (None,)], "event_id long"), 1)
    assert seen.filter_before(own, 0) is None and seen.filter_before(own, 2).count() == 4
    probe = own.range(20_000).select(F.col("id").alias("event_id"))
    hits = seen.maybe_seen(probe, seen.filter_before(own, 2)).where("_maybe")
    assert hits.where("event_id <= 10000").count() == 10_001 and hits.count() < 10_001 + 300
    lost = own.createDataFrame([(None,), (None,), (5,)], "event_id long")
    assert [r.event_id for r in seen.fresh(lost, 2).collect()] == [None, None]  # without an id no copy of one another


def test_funnel_windows_forget_idle_users(own, scratch):
    p = REFERENCE.with_(funnel_timeout_s=60, funnel_watermark_s=10)
    for rows in ([(1, 1, "purchase", 3, at(0)), (2, 2, "page_view", None, at(1)), (3, None, "purchase", 1, at(1))],
                 [(4, 2, "add_to_cart", 3, at(50)), (5, 1, "search", None, at(200))], [(6, 3, "page_view", None, at(1000))]):
        write_events(f"{scratch}/in", rows)
    clicks = stream_envelopes(own, f"{scratch}/in", 1)
    q = jobs.start_funnel_windows(own, clicks, ParquetSink(f"{scratch}/out"), f"{scratch}/ck", p, NOW, "t_windows")
    q.awaitTermination()
    got = {tuple(r) for r in own.read.parquet(f"{scratch}/out").select("user_id", "session_start", "session_end", "highest_funnel_stage").collect()}
    assert got == {(1, at(0), at(60), 4), (2, at(1), at(110), 3), (1, at(200), at(260), 1)}
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] == 1

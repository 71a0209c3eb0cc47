"""Highest funnel stage per user as arbitrary keyed state.

``applyInPandasWithState`` keeps ``(highest_funnel_stage, event_time)`` per
user, emits one row per user per micro-batch in which the user had events,
and drops a user's state after ``timeout`` of event-time inactivity (D1: the
intended 30 minutes, as a parameter; event time, so it also ends under an
``availableNow`` trigger). The event time is the maximum seen (D4).

Spark calls the state function, and moves a state through Arrow, once a key
and batch, which costs about 2 ms of Python whatever there is to do. So users
share keys: a key is one of BUCKETS hash buckets, its state the list of its
users, each with a deadline of its own, and a batch advances all users of a
bucket with numpy. The bucket wakes at its users' earliest deadline.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cartwheel import schemas
from cartwheel.functions.columns import funnel_stage

# Imported by the Python worker with the state function: silence a pandas
# deprecation notice raised inside PySpark's own state serializer.
warnings.filterwarnings("ignore", category=FutureWarning, module="pyspark.sql.pandas.serializers")


# Keys of the state, fixed for the checkpoint's life; a million users are 250 a bucket.
BUCKETS = 4096

#: No event time: what numpy takes for NaT.
NONE = np.iinfo(np.int64).min


def epoch_ms(t, tz: str) -> int:
    """Epoch milliseconds of a naive pandas timestamp that Arrow delivered as
    wall-clock time in the session time zone ``tz``."""
    ts = pd.Timestamp(t)
    if ts.tzinfo is None:
        ts = ts.tz_localize(tz)
    return int(ts.value // 1_000_000)


def epochs_ms(wall: np.ndarray, tz: str) -> np.ndarray:
    """:func:`epoch_ms` of many wall-clock times, given in nanoseconds."""
    return pd.DatetimeIndex(wall.view("datetime64[ns]")).tz_localize(tz).asi8 // 1_000_000


def highest(users: np.ndarray, stage: np.ndarray, latest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One row a user, ascending: the highest stage and the latest time."""
    order = np.argsort(users, kind="stable")
    users = users[order]
    first = np.flatnonzero(np.concatenate(([True], users[1:] != users[:-1])))
    return users[first], np.maximum.reduceat(stage[order], first), np.maximum.reduceat(latest[order], first)


def make_state_fn(timeout_s: float, tz: str = "UTC"):
    timeout_ms = int(timeout_s * 1000)

    def advance(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState):
        now = state.getCurrentWatermarkMs()
        users, stage, latest, deadline = (np.array(x, np.int64) for x in (state.get if state.exists else ([], [], [], [])))
        found = [] if state.hasTimedOut else [
            highest(pdf["user_id"].to_numpy(np.int64), pdf["stage"].to_numpy(np.int64), pdf["time_generated"].to_numpy("datetime64[ns]").view(np.int64))
            for pdf in chunks if not pdf.empty]
        active = np.unique(np.concatenate([u for u, _, _ in found])) if found else np.zeros(0, np.int64)
        kept = (deadline >= now) | np.isin(users, active)  # an event comes before the timeout of its batch
        held = [x[kept] for x in (users, stage, latest, deadline)]
        if found:
            had = np.isin(held[0], active)
            active, stage, latest = highest(*(np.concatenate(x) for x in zip([x[had] for x in held[:3]], *found)))
            timed = latest != NONE
            last_ms = np.full(len(active), now)  # an event without a time counts for the stage; until one has a time, the watermark is the user's clock
            last_ms[timed] = epochs_ms(latest[timed], tz)
            new = active, stage, latest, np.maximum(last_ms + timeout_ms, now + 1)
            held = [np.concatenate((x[~had], y)) for x, y in zip(held, new)]
        if len(held[0]):
            state.update(tuple(x.tolist() for x in held))
            state.setTimeoutTimestamp(int(held[3].min()))
        else:
            state.remove()
        if found:
            yield pd.DataFrame({"user_id": active, "highest_funnel_stage": stage.astype(np.int32), "event_time": latest.view("datetime64[ns]")})

    return advance


def funnel_state(events: DataFrame, timeout_s: float) -> DataFrame:
    """Per-user stage updates from a watermarked event stream (update mode)."""
    tz = events.sparkSession.conf.get("spark.sql.session.timeZone")
    return (events.where(events["user_id"].isNotNull())
            .select(F.pmod(F.xxhash64("user_id"), F.lit(BUCKETS)).alias("bucket"), "user_id", funnel_stage("event_type").alias("stage"), "time_generated")
            .groupBy("bucket")
            .applyInPandasWithState(make_state_fn(timeout_s, tz), schemas.FUNNEL_UPDATE,
                                    schemas.FUNNEL_STATE, "update",
                                    GroupStateTimeout.EventTimeTimeout))

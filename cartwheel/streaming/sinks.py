"""Streaming sinks.

Exactly-once paths: the parquet file sink (its ``_spark_metadata`` log
commits each batch once, and file-stream readers of the directory read only
committed files), and ``foreachBatch`` writers that overwrite one
``batch_id=N`` directory per micro-batch, so a replayed batch replaces its own
output instead of appending a second copy.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


@dataclass(frozen=True)
class Trigger:
    """``processing_time`` ("5 seconds"), or ``available_now`` for replays
    and tests (process what is there, then stop)."""

    processing_time: str | None = None
    available_now: bool = False

    def apply(self, w: DataStreamWriter) -> DataStreamWriter:
        if self.available_now:
            return w.trigger(availableNow=True)
        if self.processing_time:
            return w.trigger(processingTime=self.processing_time)
        return w


@dataclass(frozen=True)
class ParquetSink:
    path: str
    partition_by: tuple[str, ...] = ()


@dataclass(frozen=True)
class KafkaSink:
    servers: str
    topic: str


@dataclass(frozen=True)
class ConsoleSink:
    """Debug only (K2/K9)."""

    truncate: bool = False


@dataclass(frozen=True)
class MemorySink:
    """In-memory table for tests and notebooks."""

    name: str


Sink = ParquetSink | KafkaSink | ConsoleSink | MemorySink


def start_stream(df: DataFrame, sink: Sink, checkpoint: str | None, trigger: Trigger,
                 mode: str = "append", name: str | None = None) -> StreamingQuery:
    """Start ``df`` into ``sink``."""
    w = df.writeStream.outputMode(mode)
    if name:
        w = w.queryName(name)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    w = trigger.apply(w)
    if isinstance(sink, ParquetSink):
        if sink.partition_by:
            w = w.partitionBy(*sink.partition_by)
        return w.format("parquet").option("path", sink.path).start()
    if isinstance(sink, KafkaSink):
        return (w.format("kafka").option("kafka.bootstrap.servers", sink.servers)
                .option("topic", sink.topic).start())
    if isinstance(sink, ConsoleSink):
        return w.format("console").option("truncate", str(sink.truncate).lower()).start()
    if isinstance(sink, MemorySink):
        return w.format("memory").queryName(sink.name).start()
    raise TypeError(f"unknown sink {sink!r}")


def start_foreach_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                        trigger: Trigger, mode: str = "append",
                        name: str | None = None) -> StreamingQuery:
    """K4: run ``fn(batch_df, batch_id)`` per micro-batch."""
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    return trigger.apply(w).foreachBatch(fn).start()


def batch_path(root: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/batch_id={batch_id}"


def write_batch(df: DataFrame, root: str, batch_id: int) -> None:
    """Write one micro-batch's rows to ``root/batch_id=N``, replacing any
    earlier attempt of the same batch. Read back with
    ``spark.read.parquet(root)``; ``batch_id`` appears as a column."""
    df.write.mode("overwrite").parquet(batch_path(root, batch_id))


def fan_out(batch_df: DataFrame, batch_id: int,
            outputs: list[tuple[Callable[[DataFrame], DataFrame], str]],
            skip_empty: bool = True) -> None:
    """K6: derive several tables from one micro-batch. The batch is
    persisted once, so neither the emptiness test nor any output re-runs the
    micro-batch plan (its source read, dedup or state update); each output is
    written with :func:`write_batch`. An empty batch writes nothing."""
    batch_df.persist()
    try:
        if skip_empty and batch_df.isEmpty():
            return
        for derive, root in outputs:
            write_batch(derive(batch_df), root, batch_id)
    finally:
        batch_df.unpersist()

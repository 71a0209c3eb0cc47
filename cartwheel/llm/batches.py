"""Numpy work on the texts of Arrow batches, other columns passed through."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cartwheel.llm.vectors import chunks

ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(),
         "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
         "array<float>": pa.list_(pa.float32())}


def to_arrow(values, kind: str) -> pa.Array:
    if isinstance(values, np.ndarray) and values.ndim == 2:  # one list per row
        ends = np.arange(0, values.size + 1, max(1, values.shape[1]), dtype=np.int32)
        return pa.ListArray.from_arrays(ends, pa.array(values.ravel(), ARROW[kind].value_type))
    return pa.array(values, ARROW[kind])


def map_texts(df: DataFrame, keep: list[str], fields: dict[str, str],
              work: Callable[[list[bytes]], dict], text: str = "text") -> DataFrame:
    """Columns ``keep`` of ``df`` beside ``work(texts)``'s ``fields``, one row
    per row. ``work`` gets the texts as UTF-8 (null: empty) in chunks of
    bounded size and returns a sequence for each field."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, encoded in chunks(batch.column(text).to_pylist()):
                got = work(encoded)
                kept = [batch.column(k).slice(first, len(encoded)) for k in keep]
                yield pa.RecordBatch.from_arrays(
                    kept + [to_arrow(got[f], kind) for f, kind in fields.items()], names=[*keep, *fields])

    kinds = dict(df.dtypes)
    schema = ", ".join([f"`{k}` {kinds[k]}" for k in keep] + [f"`{f}` {kind}" for f, kind in fields.items()])
    return df.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)

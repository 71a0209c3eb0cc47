"""Whitening of embeddings by a bidiagonal qd solver.

Vectors are made whole numbers, and the distinct ones are the fit list. Each
task reduces its centred rows to a triangular factor, block by block (QR of the
factor so far on top of the next block), and factors are stacked and reduced in
groups until few are left: the R of all centred rows, whose size is that of the
dimensions alone. Householder reflections make R bidiagonal, dqds finds its
singular values, twisted factorisations its singular vectors; these project
rows on components of unit variance.

Defined results: a row without a vector, or whose vector is empty, has a null
or non-finite entry or one beyond 2**50, is left out; so is a vector that isn't
as long as most are (of several lengths the longest). Repeated rows stand each
for themselves and count once in the fit. Components whose variance is nothing
but rounding don't exist: a table of equal vectors gives no rows, nor does an
empty one. A deviation beyond 64 bits is null. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import materialise, of_columns
from cartwheel.llm.svd import directions

SCALE, SHIFT = 64, 1_000_000
LARGEST = 2.0 ** 50
COMPONENTS = 16
#: Rows of a block, and factors that are stacked in one task.
BLOCK, FAN = 4096, 64


def whole(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x): the remaining rows, entries as whole numbers."""
    e = of_columns(embeddings, "vec_id", "embedding").select("vec_id", F.col("embedding").cast("array<double>").alias("c"))
    good = F.forall("c", lambda v: v.isNotNull() & ~F.isnan(F.coalesce(v, F.lit(0.0))) & (F.abs(F.coalesce(v, F.lit(0.0))) < LARGEST))
    e = e.where("c is not null and size(c) > 0").where(good)
    return e.select("vec_id", F.transform("c", lambda v: F.floor(v * SCALE).cast("long") + SHIFT).alias("x"))


def matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def sums(fit: DataFrame, d: int) -> tuple[int, np.ndarray]:
    """(n, sums of each dimension), exact."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for batch in batches:
            x = matrix(batch.column("x"), d)
            n += len(x)
            # of halves of 32 bits, so that no sum can overflow
            high, low = (x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)
            total = [t + (int(h) << 32) + int(v) for t, h, v in zip(total, high, low)]
        yield pa.RecordBatch.from_pydict({"n": [n] * d, "k": list(range(d)), "total": [str(t) for t in total]})
    got = fit.select("x").mapInArrow(run, "n long, k long, total string").groupBy("k").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).orderBy("k").collect()  # one row a dimension
    return (got[0]["n"], np.array([int(r["total"]) for r in got], dtype=object)) if got else (0, np.zeros(0, object))


def centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """n*x - S, exact: as 64-bit numbers where these hold it, else as Python's."""
    most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * n + max((abs(int(t)) for t in total), default=0)
    return x * np.int64(n) - total.astype(np.int64) if most < 2**62 else x.astype(object) * n - total


def stacked(blocks: Iterator[np.ndarray], d: int) -> np.ndarray:
    """R of all ``blocks``, one on top of the other; at most d rows."""
    r = np.zeros((0, d))
    for block in blocks:
        r = np.linalg.qr(np.concatenate([r, block]), mode="r")
    return r


def factor(fit: DataFrame, n: int, total: np.ndarray) -> np.ndarray:
    """R of the centred fit list over the root of n: at most d rows of d."""
    d = len(total)

    def out(r: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"r": [r.tobytes()]})

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks() -> Iterator[np.ndarray]:
            for batch in batches:
                x = matrix(batch.column("x"), d)
                for k in range(0, len(x), BLOCK):
                    yield centred(x[k:k + BLOCK], n, total).astype(float) / (n * np.sqrt(n))
        r = stacked(blocks(), d)
        if len(r):
            yield out(r)

    def reduce_factors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = stacked((np.frombuffer(v.as_py()).reshape(-1, d) for batch in batches for v in batch.column("r")), d)
        if len(r):
            yield out(r)
    parts = materialise(fit.select("x").mapInArrow(reduce_rows, "r binary"))
    while (count := parts.count()) > FAN:
        parts = materialise(parts.repartition(-(-count // FAN)).mapInArrow(reduce_factors, "r binary"))
    return stacked((np.frombuffer(row["r"]).reshape(-1, d) for row in parts.orderBy("r").collect()), d)  # at most FAN factors


@dataclass
class Model:
    n: int
    total: np.ndarray
    values: np.ndarray  # of the components
    vectors: np.ndarray
    trace: float

    def project(self, dev: np.ndarray) -> np.ndarray:
        """Whitened rows of n*x - S."""
        return (dev.astype(float) / self.n) @ self.vectors / np.sqrt(self.values)


def fit_list(rows: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(rows as long as most, the distinct vectors of these, their length)."""
    rows = materialise(rows)
    common = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = common["d"] if common else 0
    rows = rows.where(F.size("x") == d)
    return rows, materialise(rows.select("x").distinct()), d


def learn(fit: DataFrame, d: int, components: int = COMPONENTS) -> Model:
    n, total = sums(fit, d)
    if not n:
        return Model(0, total, np.zeros(0), np.zeros((0, 0)), 0.0)
    r = factor(fit, n, total)
    values, vectors = directions(np.concatenate([r, np.zeros((max(0, d - len(r)), d))]), components)
    return Model(n, total, values, vectors, float((r * r).sum()))


def identity_error(fit: DataFrame, model: Model) -> float:
    """Largest entry by which the covariance of the whitened fit list differs from the identity."""
    k, d = len(model.values), len(model.total)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square, once = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            w = model.project(centred(matrix(batch.column("x"), d), model.n, model.total))
            square, once = square + w.T @ w, once + w.sum(0)
        yield pa.RecordBatch.from_pydict({"place": list(range(k * k + k)), "part": [*square.ravel(), *once]})
    got = fit.select("x").mapInArrow(run, "place long, part double").groupBy("place").agg(F.sum("part").alias("part")).collect()  # k * (k + 1) rows
    flat = np.zeros(k * k + k)
    for row in got:
        flat[row["place"]] = row["part"]
    mean = flat[k * k:] / model.n
    return float(np.abs(flat[:k * k].reshape(k, k) / model.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error."""
    kind = dict(embeddings.dtypes)["vec_id"]
    rows, fit, d = fit_list(whole(embeddings))
    model = learn(fit, d, components)
    k = len(model.values)
    error = identity_error(fit, model) if k else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), d)
            for at in range(0, len(x) if k else 0, BLOCK):
                dev = centred(x[at:at + BLOCK], model.n, model.total)
                m = len(dev)
                exact = dev.dtype != object and np.abs(dev).max(initial=0) < (2**62 / d) ** 0.5
                square = (dev * dev).sum(1) if exact else [s if s < 2**63 else None for s in (dev.astype(object) ** 2).sum(1)]
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays([
                    batch.column("vec_id").slice(at, m).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n)), pa.array(square, pa.int64()).take(each), pa.array(model.project(dev).ravel()),
                    pa.array(np.tile(model.values / model.trace, m)), pa.array(np.full(m * k, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return rows.mapInArrow(run, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")

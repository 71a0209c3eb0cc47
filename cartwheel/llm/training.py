"""Labelled rows for the classifiers: a bounded sample, and the held-out rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOLD_OUT_MOD = 5
#: Most sets of label values that a sample is taken of; more are an error.
MAX_KINDS = 16


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves no remainder by five."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HOLD_OUT_MOD == 0, F.lit(False))


def training_rows(documents: DataFrame, labels: DataFrame, by: list[str], bound: int,
                  learn_from_held_out: bool = False) -> DataFrame:
    """``documents`` joined to at most ``bound`` labelled rows for each set of
    values of ``by`` (label columns), those with the smallest hash of doc_id.
    Rows with a null label teach nothing; of several labels of a document the
    largest counts."""
    known = labels.select("doc_id", *by).where(" and ".join(f"{c} is not null" for c in ["doc_id", *by]))
    known = known.groupBy("doc_id").agg(*[F.max(c).alias(c) for c in by])
    if not learn_from_held_out:
        known = known.where(~held_out(F.col("doc_id")))
    kinds = known.groupBy(*by).count().orderBy(*by).limit(MAX_KINDS + 1).collect()  # label values: a handful
    if len(kinds) > MAX_KINDS:
        raise ValueError(f"more than {MAX_KINDS} values of the labels {by}")
    taken = None
    for kind in kinds:
        rows = known.where(" and ".join(f"{c} = {kind[c]}" for c in by)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
        taken = rows if taken is None else taken.unionByName(rows)
    if taken is None:
        taken = known.limit(0)
    return documents.join(F.broadcast(taken), "doc_id")  # at most MAX_KINDS x bound rows of ids and labels

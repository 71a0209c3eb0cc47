"""Ranks of rows without a task that sees a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import materialise


def ranked(rows: DataFrame, order: list[Column], by: str | None = None) -> DataFrame:
    """``rows``, written, with ``_rank``: 0, 1, ... by ``order``, within each
    value of the column ``by`` if there is one (null is a value).

    Rows are dealt to tasks by ranges of (by, order), so a group of any size
    is spread over as many tasks as its share needs. A row's number in its
    task, plus the rows of its group in the tasks before, is its rank: the
    only window runs over one row per task and group."""
    keys = [F.col(by)] if by else []
    total = [*([F.col(by).asc_nulls_first()] if by else []), *order]
    dealt = materialise(rows.repartitionByRange(*total).sortWithinPartitions(*total).withColumn("_at", F.monotonically_increasing_id()))
    task = F.shiftright("_at", 33)  # documented layout of the id: task above 33 bits of row number
    groups = dealt.groupBy(*keys, task.alias("_task")).agg(F.min("_at").alias("_from"), F.count("*").alias("_rows"))
    before = (Window.partitionBy(*keys) if by else Window.partitionBy()).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = groups.select(*([F.col(by).alias("_by")] if by else []), "_task", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_from")).alias("_shift"))
    on = task == F.col("_task")
    on = on & F.col(by).eqNullSafe(F.col("_by")) if by else on
    return dealt.join(firsts, on).withColumn("_rank", F.col("_at") + F.col("_shift")).drop("_at", "_shift", "_task", "_by")

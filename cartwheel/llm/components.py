"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cartwheel.llm.common import materialise


def components(edges: DataFrame, by: str | None = None) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: longs) but the
    components' smallest, which names them. With ``by``, a column of
    ``edges``, the graphs of its values are solved together and apart, and the
    column is returned too. Each step pre-aggregates a node's least neighbour,
    writes its edges, and counts them as they are written; it ends when a step
    leaves them as they were."""
    keys = [by] if by else []
    on = [*keys, "a"]

    def least_of(e: DataFrame) -> DataFrame:
        return e.groupBy(*on).agg(F.min("b").alias("m"))
    e = edges.where("a <> b").select(*keys, F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    known, e = None, materialise(e.distinct(), few=True)
    while True:
        both = e.unionByName(e.select(*keys, F.col("b").alias("a"), F.col("a").alias("b")))
        least = least_of(both).select(*on, F.least("a", "m").alias("m"))
        large = both.join(least, on).where("b > a").select(*keys, F.col("b").alias("a"), F.col("m").alias("b"))
        least = least_of(large)
        small = large.join(least, on).where("b <> m").select(*keys, F.col("b").alias("a"), F.col("m").alias("b"))
        step = small.unionByName(least.select(*on, F.col("m").alias("b"))).distinct()
        seen = Observation()
        # decimal: the sum of hashes must not overflow
        e = materialise(step.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64(*on, "b").cast("decimal(38,0)")).alias("hashes")), few=True)
        now = seen.get
        if now == known:
            return e.select(*keys, F.col("a").alias("node"), F.col("b").alias("component"))
        known = now

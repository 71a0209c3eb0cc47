"""Merkle manifest of a dataset, with proofs by pointer jumping.

A row is a leaf; a source's leaves, in the order of doc_id, are hashed in runs
of FAN, level by level, to its subroot, and the subroots, in the order of
sources, likewise to the root. Levels are aggregates over a node's place
divided by FAN. Every node holds the siblings of its run as a segment towards
its parent. Self-joins then double the distance: a node's segment is followed
by that of the node it has reached, until all have reached the root. After k
rounds only nodes above 2**k levels are looked up, FAN**2**k times fewer than
leaves, so the looked-up side soon is small enough to be sent to every task.

Defined results: nulls are hashed as ``-``; a null doc_id is a leaf before the
others, a null source a source before the others; rows of one doc_id are
ordered by their leaf; an empty table gives no rows and has no root; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import bind, materialise, of_columns
from cartwheel.llm.ranks import ranked

FAN = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Looked-up nodes that are sent to every task, with the segments that they hold (64 bytes a level).
BROADCAST_NODES = 20_000
#: The tree of the subroots, beside those of the sources 0, 1, ...
TOP = -1


def field(value: Column) -> Column:
    """A value with its length in bytes, so that no two rows concatenate alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns.values()]), 256)


def leaves(documents: DataFrame, tampered: Column | None = None, changed: Column | None = None) -> DataFrame:
    """(doc_id, source, leaf, changed) of every row: its digest, and that with
    ``changed`` for its text where ``tampered`` holds (null elsewhere)."""
    d = of_columns(documents, *FIELDS)
    own = {c: F.col(c) for c in FIELDS}
    other = F.lit(None).cast("string") if tampered is None else F.when(tampered, leaf(own | {"text": changed}))
    return d.select("doc_id", "source", F.unhex(leaf(own)).alias("leaf"), F.unhex(other).alias("changed"))


def hexed(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def levels(nodes: DataFrame, counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(all nodes: tree, level, place, digest, n; the trees' roots: tree,
    level, digest). ``nodes`` (tree, place, digest) are the lowest level and
    ``counts`` (tree, n) their numbers; a level is written before the next."""
    level = nodes.join(counts, "tree").select("tree", F.lit(0).alias("level"), "place", "digest", "n")
    whole = level
    while True:
        run = level.where("n > 1").groupBy("tree", "level", "n", F.floor(F.col("place") / FAN).alias("above")).agg(
            F.array_sort(F.collect_list(F.struct("place", "digest"))).alias("run"))  # at most FAN
        digest = F.unhex(F.sha2(F.concat_ws("", F.transform("run", lambda r: hexed(r["digest"]))), 256))
        level = materialise(run.select("tree", (F.col("level") + 1).alias("level"), F.col("above").alias("place"), digest.alias("digest"),
                                       F.ceil(F.col("n") / FAN).alias("n")))
        if level.isEmpty():
            return whole, whole.where("n = 1").select("tree", "level", "digest")
        whole = whole.unionByName(level)


def segments(nodes: DataFrame) -> DataFrame:
    """(tree, level, place, way): the siblings left and right of every node
    that has a parent, as a way of one step."""
    run = nodes.where("n > 1").groupBy("tree", "level", F.floor(F.col("place") / FAN).alias("above")).agg(
        F.array_sort(F.collect_list(F.struct("place", "digest"))).alias("run"))

    def side(part: Column) -> Column:
        return F.unhex(F.concat_ws("", F.transform(part, lambda r: F.hex(r["digest"]))))
    at = run.select("tree", "level", "run", F.explode("run").alias("own"))
    left, right = (F.filter("run", lambda r: keep(r["place"], F.col("own.place"))) for keep in (lambda a, b: a < b, lambda a, b: a > b))
    return at.select("tree", "level", "own.place", F.array(F.struct(side(left).alias("left"), side(right).alias("right"))).alias("way"))


def jump(steps: DataFrame, depth: int) -> DataFrame:
    """(tree, level, place, way): the whole way to the root. ``steps`` has the
    first step of every node (with to_tree, to_level, to_place, its parent,
    and ``height`` above the leaves at most); ``depth`` is the longest way."""
    ways, distance = materialise(steps), 1
    while distance < depth:
        # whoever is reached after `distance` steps lies that many levels up, at least
        reached = ways.where(F.col("height") >= distance).select(
            *[F.col(c).alias(f"_{c}") for c in ("tree", "level", "place", "to_tree", "to_level", "to_place", "way")])
        if reached.count() <= BROADCAST_NODES:
            reached = F.broadcast(reached)
        on = [F.col(f"to_{c}") == F.col(f"_{c}") for c in ("tree", "level", "place")]
        both = ways.join(reached, on, "left")
        further = F.col("_tree").isNotNull()  # the root has no way on
        ways = materialise(both.select(
            "tree", "level", "place", "height",
            *[F.when(further, F.col(f"_to_{c}")).otherwise(F.col(f"to_{c}")).alias(f"to_{c}") for c in ("tree", "level", "place")],
            F.when(further, F.concat("way", "_way")).otherwise(F.col("way")).alias("way")))
        distance *= 2
    return ways.select("tree", "level", "place", "way")


def fold(digest: Column, way: Column) -> Column:
    """The root that a leaf's digest (hex) and its way lead to."""
    return F.aggregate(way, digest, lambda acc, s: F.sha2(F.concat(hexed(s["left"]), acc, hexed(s["right"])), 256))


def manifest(documents: DataFrame, tampered: Column | None = None, changed: Column | None = None) -> DataFrame:
    """doc_id, source, leaf, changed, subroot, root (digests in hex) and way
    (siblings to the left and right, from the leaf to the root) of every row."""
    spark = documents.sparkSession
    rows = ranked(leaves(documents, tampered, changed), [F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("changed")], by="source")
    trees = materialise(ranked(rows.groupBy("source").agg(F.count("*").alias("n")), [F.col("source").asc_nulls_first()]).select(
        F.col("_rank").alias("tree"), "source", "n"))
    total = trees.count()
    numbered = trees.withColumnRenamed("source", "_source").drop("n")
    if total <= BROADCAST_NODES:
        numbered = F.broadcast(numbered)
    rows = materialise(rows.join(numbered, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "source", "tree", F.col("_rank").alias("place"), "leaf", "changed"))
    nodes, roots = levels(rows.select("tree", "place", F.col("leaf").alias("digest")), trees.select("tree", "n"))
    roots = materialise(roots)
    counts = spark.range(1).select(F.lit(TOP).cast("long").alias("tree"), F.lit(total).cast("long").alias("n"))
    top, root = levels(roots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("place"), "digest"), counts)
    whole = [r["digest"] for r in root.collect()]  # one row, none of an empty table
    parent = [F.col("tree").alias("to_tree"), (F.col("level") + 1).alias("to_level"), F.floor(F.col("place") / FAN).alias("to_place")]
    subs = roots.select(F.col("tree").alias("of"), F.col("level").alias("last"))
    subs = F.broadcast(subs) if total <= BROADCAST_NODES else subs
    first = segments(nodes).select("*", *parent).join(subs, F.col("tree") == F.col("of"))
    at_root = F.col("to_level") == F.col("last")  # a subroot is a leaf of the top tree
    first = first.select("tree", "level", "place", F.col("level").alias("height"), F.when(at_root, F.lit(TOP)).otherwise(F.col("to_tree")).cast("long").alias("to_tree"),
                         F.when(at_root, 0).otherwise(F.col("to_level")).alias("to_level"),
                         F.when(at_root, F.col("tree")).otherwise(F.col("to_place")).alias("to_place"), "way")
    # the least height of a top node is that of the lowest source's tree: any node of it may be reached in one step
    deep = roots.agg(F.max("level").alias("d")).first()["d"] or 0
    above = root.agg(F.max("level").alias("d")).first()["d"] or 0
    first = first.unionByName(segments(top).select("tree", "level", "place", F.lit(deep + above + 1).alias("height"), *parent, "way"))
    ways = jump(first, deep + above)
    way = ways.where("level = 0").select(F.col("tree").alias("_tree"), F.col("place").alias("_place"), "way")
    lone = ways.where(F.col("tree") == TOP).where("level = 0").select(F.col("place").alias("_sub"), F.col("way").alias("sub_way"))
    subroots = roots.select(F.col("tree").alias("_of"), hexed(F.col("digest")).alias("subroot"), F.col("level").alias("last"))
    subroots = subroots.join(lone, F.col("_of") == F.col("_sub"), "left")  # a lone leaf's way is its subroot's
    subroots = F.broadcast(subroots) if total <= BROADCAST_NODES else subroots
    none = F.array().cast("array<struct<left:binary,right:binary>>")
    out = rows.join(way, (F.col("tree") == F.col("_tree")) & (F.col("place") == F.col("_place")), "left").join(subroots, F.col("tree") == F.col("_of"))
    return out.select("doc_id", "source", hexed(F.col("leaf")).alias("leaf"), hexed(F.col("changed")).alias("changed"), "subroot",
                      F.lit(whole[0] if whole else None).cast("binary").alias("root"),
                      F.coalesce(F.when(F.col("last") == 0, F.col("sub_way")).otherwise(F.col("way")), none).alias("way")).withColumn("root", hexed(F.col("root")))


def proofs(documents: DataFrame, tampered: Column, changed: Column) -> DataFrame:
    """The manifest's digests, and whether each row, its text ``changed``
    where ``tampered`` holds, still proves to belong to the root."""
    m = manifest(documents, tampered, changed)
    siblings = F.concat_ws("", F.transform("way", lambda s: F.concat(hexed(s["left"]), hexed(s["right"]))))
    folded = fold(F.coalesce("changed", "leaf"), F.col("way"))
    return m.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))

"""Near duplicates by fast similarity sketching, banding and exact checks.

1. Each text's set of distinct five-word shingles gets a sketch of T
   coordinates: round by round every shingle is hashed to a bin, a bin keeps
   the least value of the first round that reaches it, and the last T rounds
   place every shingle in one given bin each, so that every coordinate fills.
   Coordinates of two sketches agree with the probability of the sets'
   similarity, with the concentration of independent draws.
2. Texts of equal sets are one class, whose smallest doc_id stands for it.
3. BANDS keys of ROWS coordinates make buckets. At a similarity of 0.75 two
   texts miss each other in all 36 bands with probability 6e-5. All texts of
   a bucket are checked against its smallest id, on the full sets.
4. What may still be linked without being connected lies in one family (texts
   joined through buckets) and different components: these are compared in
   blocks of bounded size, first by sketch - at 5 standard errors below the
   threshold - then on the full sets, and only links that connect are kept.

Groups are cut to BLOCK texts a task and no pair list is ever made, so a text
with copies in a third of all rows costs one shuffle of its short row.

Defined results: texts without words have no shingles and no links; rows of
one doc_id with different texts stand each for themselves, under that id; a null doc_id is linked with nothing, has no
component and is kept; an empty table gives no rows; other columns are ignored
(``deduplicate`` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.batches import map_texts
from cartwheel.llm.common import materialise, of_columns
from cartwheel.llm.components import components
from cartwheel.llm.vectors import Words, chunks, mix, windows

SHINGLE = 5
ROWS, BANDS = 5, 36
T = ROWS * BANDS
SIMILARITY = 0.75
#: Five standard errors of a sketch below SIMILARITY.
LEAST_ESTIMATE = SIMILARITY - 5 * (SIMILARITY * (1 - SIMILARITY) / T) ** 0.5
BLOCK = 256
#: Rows of (group, doc_id) that are sent to every task; beyond it the texts are shuffled.
BROADCAST_ROWS = 500_000
EMPTY = np.uint64(2**64 - 1)


def shingles(encoded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text index, shingle) of the distinct shingles, sorted by both."""
    w = Words(encoded)
    at, h = windows(w.hash, w.doc, SHINGLE)
    doc = w.doc[at]
    short = np.flatnonzero((w.n > 0) & (w.n < SHINGLE))
    if len(short):  # the whole sequence as one shingle
        whole = np.zeros(len(short), np.uint64)
        for j in range(SHINGLE - 1):
            there = w.n[short] > j
            whole[there] = mix(whole[there] + w.hash[w.first[short[there]] + j] * np.uint64(2 * j + 101))
        doc, h = np.concatenate([doc, short]), np.concatenate([h, mix(whole + w.n[short].astype(np.uint64))])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    return doc[new], h[new]


def sketch(doc: np.ndarray, h: np.ndarray, texts: int) -> np.ndarray:
    """One row of T coordinates per text; EMPTY for a text without shingles."""
    out = np.full((texts, T), EMPTY)
    flat = out.reshape(-1)
    for i in range(2 * T):
        if not len(doc):
            break
        x = mix(h + np.uint64(i * 0xD6E8FEB86659FD93 % 2**64))
        # earlier rounds are smaller; within a round the hash decides
        value = (x >> np.uint64(9)) | (np.uint64(i) << np.uint64(55))
        place = (x % np.uint64(T)).astype(np.int64) if i < T else np.full(len(x), i - T)
        np.minimum.at(flat, doc * T + place, value)
        open_ = (out == EMPTY).any(1)[doc]
        doc, h = doc[open_], h[open_]
    return out


def sketch_rows(encoded: list[bytes]) -> dict:
    doc, h = shingles(encoded)
    n = np.bincount(doc, minlength=len(encoded))
    first = np.concatenate(([0], np.cumsum(n)))

    def total(x: np.ndarray) -> np.ndarray:
        upto = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)))
        return (upto[first[1:]] - upto[first[:-1]]).view(np.int64)
    s = sketch(doc, h, len(encoded)).reshape(len(encoded), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), s.shape[:2])
    for j in range(ROWS):
        key = mix(key + s[:, :, j] * np.uint64(2 * j + 7))
    return {"n": n, "set1": total(mix(h)), "set2": total(mix(h ^ np.uint64(0xA5A5A5A55A5A5A5A))), "bands": key.view(np.int64)}


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= round(100 * SIMILARITY) * (len(a) + len(b) - both)


def group_links(ids: list[int], parts: list[int], side: np.ndarray, texts: list[str | None]) -> list[tuple[int, int]]:
    """Links that connect different ``parts``: of texts of side 0 to those of
    side 1, or among all texts where all are of side 0."""
    sets: list[np.ndarray] = []
    rows: list[np.ndarray] = []
    for _, encoded in chunks(texts):
        doc, h = shingles(encoded)
        sets += np.split(h, np.searchsorted(doc, np.arange(1, len(encoded))))
        rows.append(sketch(doc, h, len(encoded)))
    s = np.concatenate(rows)
    size = np.array([len(x) for x in sets])
    part = {p: p for p in parts}

    def root(p: int) -> int:
        while part[p] != p:
            part[p] = part[part[p]]
            p = part[p]
        return p
    mixed = side.any()
    links = []
    for i in np.flatnonzero(side == 0):
        others = np.flatnonzero(side == 1) if mixed else np.arange(i + 1, len(ids))
        low, high = np.minimum(size[i], size[others]), np.maximum(size[i], size[others])
        others = others[(low > 0) & (100 * low >= round(100 * SIMILARITY) * high)]
        others = others[(s[others] == s[i]).mean(1) >= LEAST_ESTIMATE]
        for j in others:
            a, b = root(parts[i]), root(parts[j])
            if a != b and similar(sets[i], sets[j]):
                part[max(a, b)] = min(a, b)
                links.append((ids[i], ids[j]))
    return links


def links_of_groups(groups: DataFrame, documents: DataFrame) -> DataFrame:
    """(a, b): links found in ``groups`` (group, side, id, part), whose texts
    are fetched from ``documents``."""
    n = groups.count()
    docs = documents.select(F.col("doc_id").alias("id"), "text").where("id is not null")
    rows = docs.join(F.broadcast(groups) if n <= BROADCAST_ROWS else groups, "id")
    rows = rows.repartition("group").sortWithinPartitions("group", "side", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def out(found: list[tuple]) -> pa.RecordBatch:
            got = group_links([r[2] for r in found], [r[3] for r in found], np.array([r[1] for r in found]), [r[4] for r in found])
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in got], pa.int64()) for k in (0, 1)], names=["a", "b"])
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("group", "side", "id", "part", "text")]):
                if held and held[0][0] != row[0]:
                    yield out(held)
                    held = []
                held.append(row)
        if held:
            yield out(held)

    return rows.select("group", "side", "id", "part", "text").mapInArrow(run, "a long, b long")


def star_groups(stars: DataFrame) -> DataFrame:
    """Groups of a bucket's smallest id (side 0) and at most about BLOCK others."""
    salts = stars.groupBy("center").agg(F.ceil(F.count("*") / BLOCK).alias("salts"))
    dealt = stars.join(salts, "center").select("center", "id", F.pmod(F.xxhash64("id"), F.col("salts")).alias("salt"))
    group = F.concat_ws(":", "center", "salt").alias("group")
    others = dealt.select(group, F.lit(1).alias("side"), "id", F.col("id").alias("part"))
    centers = dealt.select(group, F.lit(0).alias("side"), F.col("center").alias("id"), F.col("center").alias("part")).distinct()
    return others.unionByName(centers)


def block_groups(families: DataFrame) -> DataFrame:
    """Groups for ``families`` (family, id, part): every two blocks of a
    family but those of one large part, each block of about BLOCK texts."""
    parts = families.groupBy("family", "part").agg(F.count("*").alias("size"))
    whole = parts.groupBy("family").agg(F.sum("size").alias("texts"), F.count("*").alias("parts"),
                                        F.sum(F.when(F.col("size") < BLOCK, F.col("size")).otherwise(0)).alias("rest"))
    whole = whole.where("parts > 1 and texts > 2")  # two texts have been checked as a star
    r = families.join(parts, ["family", "part"]).join(whole, "family")
    large = F.col("size") >= BLOCK
    own = F.concat_ws(":", "part", F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / BLOCK)))
    rest = F.concat_ws(":", F.lit("rest"), F.pmod(F.xxhash64("part"), F.ceil(F.col("rest") / BLOCK)))
    r = r.select("family", "id", "part", F.when(large, own).otherwise(rest).alias("block"),
                 F.when(large, F.col("part")).alias("of"))
    b = r.select("family", "block", "of").distinct()
    x, y = b.alias("x"), b.alias("y")
    pairs = x.join(y, "family").where("x.block <= y.block and (x.of is null or y.of is null or x.of <> y.of)").select(
        "family", F.col("x.block").alias("first"), F.col("y.block").alias("second"))
    group = F.concat_ws("/", "family", "first", "second").alias("group")
    sides = pairs.select("family", group, F.col("first").alias("block"), F.lit(0).alias("side")).unionByName(
        pairs.where("first <> second").select("family", group, F.col("second").alias("block"), F.lit(1).alias("side")))
    return r.join(sides, ["family", "block"]).select("group", "side", "id", "part")


def labelled(nodes: DataFrame, found: DataFrame, column: str, name: str) -> DataFrame:
    """``nodes`` with the component of ``column`` (itself where it has none)."""
    f = found.withColumnRenamed("node", "_node")
    return nodes.join(f, nodes[column] == f["_node"], "left").select(
        *[nodes[c] for c in nodes.columns], F.coalesce("component", nodes[column]).alias(name))


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    return judged(of_columns(documents, "doc_id", "text"), ["doc_id"]).select("doc_id", "n_shingles", "component_id", "kept")


def judged(docs: DataFrame, own: list[str]) -> DataFrame:
    """Columns ``own`` of every row of ``docs`` (doc_id, text and maybe more)
    with n_shingles, its shingle set's set1 and set2, component_id and kept."""
    fields = {"n": "long", "set1": "long", "set2": "long", "bands": "array<long>"}
    rows = materialise(map_texts(docs, own, fields, sketch_rows))
    same = ["set1", "set2", "n"]
    classes = materialise(rows.where("n > 0 and doc_id is not null").groupBy(*same).agg(
        F.min("doc_id").alias("id"), F.count("*").alias("copies"), F.first("bands").alias("bands")), few=True)
    keys = classes.select("id", F.explode("bands").alias("key"))
    buckets = keys.groupBy("key").agg(F.min("id").alias("center"), F.count("*").alias("n")).where("n > 1").select("key", "center")
    stars = materialise(keys.join(buckets, "key").where("id <> center").select("id", "center").distinct(), few=True)
    first = links_of_groups(materialise(star_groups(stars), few=True), docs).withColumn("graph", F.lit("links"))
    joined = stars.select(F.col("id").alias("a"), F.col("center").alias("b"), F.lit("buckets").alias("graph"))
    found = components(first.unionByName(joined), by="graph")  # both graphs in the same steps
    parts, families = (found.where(F.col("graph") == g).drop("graph") for g in ("links", "buckets"))
    # every bucket's smallest id, and what lies with it in one
    nodes = stars.select("id").unionByName(stars.select(F.col("center").alias("id"))).distinct()
    members = labelled(labelled(nodes, families, "id", "family"), parts, "id", "part")
    second = links_of_groups(materialise(block_groups(materialise(members, few=True)), few=True), docs)
    ends = labelled(labelled(second, parts, "a", "x"), parts, "b", "y").select(F.col("x").alias("a"), F.col("y").alias("b"))
    merged = components(ends)
    final = labelled(labelled(nodes, parts, "id", "part"), merged, "part", "component_id")
    # only classes with copies or links can differ from their own rows' ids
    known = classes.select(*same, "id", "copies").join(final.where("id <> component_id").select("id", "component_id"), "id", "left") \
        .where("copies > 1 or component_id is not null").select(*same, F.coalesce("component_id", "id").alias("component_id"))
    out = rows.select(*own, *same).join(known, same, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select(*own, F.col("n").alias("n_shingles"), "set1", "set2", component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def deduplicate(documents: DataFrame) -> DataFrame:
    """``documents`` with one document of each component left. Rows of one
    doc_id are told apart by text; of those with one shingle set (without any:
    one text) the row of the least hash is left."""
    docs = of_columns(documents, "doc_id", "text").withColumn("text_hash", F.xxhash64("text"))
    found = judged(docs, ["doc_id", "text_hash"]).where("doc_id is not null")
    wordless = F.when(F.col("n_shingles") == 0, F.col("text_hash")).alias("wordless")
    same = found.groupBy("doc_id", "n_shingles", "set1", "set2", wordless).agg(
        F.min("kept").alias("kept"), F.count("*").alias("n"), F.collect_set("text_hash").alias("hashes"), F.min("text_hash").alias("first"))
    marks = materialise(same.where("not kept or n > 1").select(
        F.col("doc_id").alias("_id"), F.explode("hashes").alias("_hash"), "kept", F.col("first").alias("_first")), few=True)
    on = (documents["doc_id"] == marks["_id"]) & (F.xxhash64(documents["text"]) == marks["_hash"])
    left = documents.join(marks.select("_id", "_hash"), on, "left_anti")
    if marks.where("kept").isEmpty():
        return left
    cols = [documents[c] for c in documents.columns]
    repeated = documents.join(marks.where("kept"), on).groupBy("_id", "_first").agg(
        F.min_by(F.struct(*cols), F.xxhash64(*cols)).alias("row")).select("row.*")
    return left.unionByName(repeated)

"""License scan by diagonal voting.

All rolling K-word hashes of a text are joined to the places of the same
hashes in the license templates. A hit votes for its diagonal (place in the
text less place in the template); neighbouring diagonals (a word put in or
left out) are merged into candidate spans, and a span that covers enough of the
template's K-grams is verified on the words themselves: a notice by the longest
sequence of its words that stands there in order, a phrase, which lies on one
diagonal, word by word. Templates of fewer than TITLE words, as titles, must
stand there whole, and of notices that overlap only those that fit best stay.

Only the spans go to the texts, as a broadcast up to BROADCAST_TEXTS texts with
candidates; beyond it texts and spans are shuffled once.

Defined results: null and wordless texts have no words and no labels; equal
rows get equal results each; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.llm.batches import map_texts
from cartwheel.llm.common import bind, materialise, of_columns
from cartwheel.llm.vectors import IS_NOT_ALNUM, Words, chunks, windows

K = 3
#: Diagonals this close may belong to one span.
NEAR = 4
#: Share of a template's K-grams that makes a candidate, and of its words that makes a label.
COVERED = 0.6
#: Template places sent to every task; beyond it they are shuffled.
BROADCAST_PLACES = 200_000
#: Texts with candidates, and candidates, that are sent to every task; beyond it they are shuffled.
BROADCAST_TEXTS = 50_000
TITLE = 10

# The phrases of the query and their labels.
PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
# Notices that the licenses prescribe, texts and titles of licenses, and their labels.
NOTICES = [
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction", "mit"),
    ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
     "with the License", "apache-2"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
     "License as published by the Free Software Foundation", "gpl"),
    ("GNU General Public License version 2", "gpl-2"),
    ("GNU General Public License version 3", "gpl-3"),
    ("GNU Lesser General Public License version 3", "lgpl-3"),
    ("GNU Affero General Public License version 3", "agpl-3"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
     "following conditions are met", "bsd"),
    ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
     "derived from this software without specific prior written permission", "bsd-3"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
     "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "
     "\"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
     "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
     "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
     "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE", "isc"),
    ("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
     "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
     "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
     "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
     "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE", "mit"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mpl-2"),
]


def default_templates(spark: SparkSession) -> DataFrame:
    rows = [(text, label, True) for text, label in PHRASES] + [(text, label, False) for text, label in NOTICES]
    return spark.createDataFrame(rows, "text string, label string, phrase boolean")


def rolling(encoded: list[bytes]) -> dict:
    """n_words and the hashes of all runs of K words of each text."""
    w = Words(encoded, IS_NOT_ALNUM)
    at, h = windows(w.hash, w.doc, K)
    ends = np.searchsorted(w.doc[at], np.arange(1, len(encoded)))
    return {"n_words": w.n, "hashes": np.split(h.view(np.int64), ends)}


FIELDS = {"n_words": "long", "hashes": "array<long>"}


def template_places(templates: DataFrame) -> DataFrame:
    """(hash, place, template, grams, label, phrase): one row per K-gram."""
    t = of_columns(templates, "text", "label", "phrase").distinct().withColumn("template", F.xxhash64("text", "label", "phrase"))
    hashed = map_texts(t, ["template", "label", "phrase"], FIELDS, rolling)
    return hashed.select("template", "label", "phrase", F.size("hashes").alias("grams"), F.posexplode("hashes").alias("place", "hash"))


def votes(documents: DataFrame, templates: DataFrame) -> DataFrame:
    """(of, of_hash, template, grams, label, phrase, diagonal, places): the
    K-grams of each text that lie on a diagonal of a template."""
    where = materialise(template_places(templates))
    n = where.count()
    d = of_columns(documents, "doc_id", "text").select(F.col("doc_id").alias("of"), F.xxhash64("text").alias("of_hash"), "text")
    hashed = map_texts(d, ["of", "of_hash"], {"hashes": "array<long>"}, rolling)
    hit = hashed.select("of", "of_hash", F.posexplode("hashes").alias("at", "hash")).join(
        F.broadcast(where) if n <= BROADCAST_PLACES else where, "hash")
    return (hit.groupBy("of", "of_hash", "template", "grams", "label", "phrase", (F.col("at") - F.col("place")).alias("diagonal"))
            .agg(F.array_sort(F.collect_set("place")).alias("places")))  # no more than the template has


def candidates(documents: DataFrame, templates: DataFrame) -> DataFrame:
    """(of, of_hash, template, label, phrase, start, end): spans of words
    [start, end) by their hashes. For a phrase one row per place."""
    v = votes(documents, templates)
    whole = v.where("phrase and size(places) = grams").select(
        "of", "of_hash", "template", "label", "phrase", F.col("diagonal").alias("start"),
        (F.col("diagonal") + F.col("grams") + K - 1).alias("end"))
    # neighbouring diagonals of one text and template, in order: one that is further off begins a group
    one = ["of", "of_hash", "template"]
    order = Window.partitionBy(*one).orderBy("diagonal")
    apart = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(order) > NEAR).cast("int"), F.lit(0))
    dealt = v.where("not phrase").withColumn("apart", apart).withColumn("group", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = dealt.groupBy(*one, "group", "grams", "label", "phrase").agg(
        F.array_distinct(F.flatten(F.collect_set("places"))).alias("places"),  # no more than the template has a diagonal
        F.min(F.col("diagonal") + F.array_min("places")).alias("start"), F.max(F.col("diagonal") + F.array_max("places") + K).alias("end"))
    covered = merged.where(F.size("places") / F.col("grams") >= COVERED)
    return whole.unionByName(covered.select("of", "of_hash", "template", "label", "phrase", "start", "end"))


def words_of(w: Words, first: int, last: int) -> list[bytes]:
    return [w.data[s:e].tobytes() for s, e in zip(w.start[first:last].tolist(), w.end[first:last].tolist())]


def common(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest common subsequence, one bit per word of ``a``."""
    places: dict[bytes, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    all_ = open_ = (1 << len(a)) - 1
    for x in b:
        met = open_ & places.get(x, 0)
        open_ = ((open_ + met) | (open_ - met)) & all_
    return len(a) - open_.bit_count()


def verified(there: list[bytes], wording: list[bytes], phrase: bool) -> float:
    """Share of words in common, of the longer of template and span; of a phrase all or none."""
    if phrase:
        return float(there == wording)
    share = common(wording, there) / max(len(wording), len(there))
    return share if share >= (COVERED if len(wording) >= TITLE else 1) else 0.0


def best(spans: list[tuple]) -> list[tuple]:
    """Sorted ``spans`` without notices that overlap a better one."""
    lost: set[int] = set()
    notices = [i for i, x in enumerate(spans) if not x[3]]
    for n, i in enumerate(notices):
        for j in notices[n + 1:]:
            if spans[j][0] >= spans[i][1]:
                break
            if spans[i][4] != spans[j][4]:
                lost.add(min(i, j, key=lambda k: spans[k][4]))
    return [x for i, x in enumerate(spans) if i not in lost]


SPANS = "array<struct<start:int,end:int,label:string,phrase:boolean,coverage:double>>"
ARROW_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("label", pa.string()),
                                  ("phrase", pa.bool_()), ("coverage", pa.float64())]))


def scan(documents: DataFrame, templates: DataFrame) -> DataFrame:
    """Every row's doc_id with n_words and its sorted, verified spans (label,
    phrase, start, end, coverage); null spans where there are none."""
    one = ["of", "of_hash"]
    found = candidates(documents, templates).groupBy(*one, "template", "label", "phrase").agg(
        F.collect_set(F.struct("start", "end")).alias("places"))
    wordings = of_columns(templates, "text", "label", "phrase").distinct().select(
        F.xxhash64("text", "label", "phrase").alias("template"), F.col("text").alias("wording"))
    found = materialise(found.join(wordings, "template").groupBy(*one).agg(
        F.collect_list(F.struct("wording", "label", "phrase", "places")).alias("found")))
    sent = found.agg(F.count("*").alias("texts"), F.sum(F.aggregate("found", F.lit(0), lambda n, f: n + F.size(f["places"]))).alias("places")).first()
    if max(sent["texts"], sent["places"] or 0) <= BROADCAST_TEXTS:
        found = F.broadcast(found)
    d = of_columns(documents, "doc_id", "text").withColumn("text_hash", F.xxhash64("text"))
    d = d.join(found, d["doc_id"].eqNullSafe(found["of"]) & (d["text_hash"] == found["of_hash"]), "left").select("doc_id", "text", "found")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[bytes]] = {}

        def spans_of(w: Words, doc: int, all_: list[dict]) -> list[dict] | None:
            out = []
            for f in all_:
                if f["wording"] not in known:
                    t = Words([f["wording"].encode("utf-8", "surrogatepass")], IS_NOT_ALNUM)
                    known[f["wording"]] = words_of(t, 0, len(t.start))
                for p in f["places"]:
                    first = int(w.first[doc])
                    share = verified(words_of(w, first + p["start"], first + p["end"]), known[f["wording"]], f["phrase"])
                    if share:
                        out.append((p["start"], p["end"], f["label"], f["phrase"], share))
            return [dict(zip(("start", "end", "label", "phrase", "coverage"), x)) for x in best(sorted(out))] or None

        for batch in batches:
            hits = batch.column("found")
            for first, encoded in chunks(batch.column("text").to_pylist()):
                w = Words(encoded, IS_NOT_ALNUM)
                spans = [spans_of(w, k, hits[first + k].as_py()) if hits[first + k].is_valid else None for k in range(len(encoded))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, len(encoded)), pa.array(w.n, pa.int64()), pa.array(spans, ARROW_SPANS)],
                    names=["doc_id", "n_words", "spans"])

    return d.mapInArrow(run, f"doc_id {dict(d.dtypes)['doc_id']}, n_words long, spans {SPANS}")


def labels_of(found: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(found, lambda s: s["label"])))


def summary(scanned: DataFrame) -> DataFrame:
    """The digest columns of a scan."""
    def digest(all_: Column) -> Column:
        base = F.filter(all_, lambda s: s["phrase"])
        starts = F.transform(base, lambda s: s["start"].cast("long"))
        return F.struct(
            F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
            F.concat_ws(",", labels_of(base)).alias("base_labels"), F.concat_ws(",", labels_of(all_)).alias("labels"),
            F.coalesce(F.array_max(F.transform(all_, lambda s: s["coverage"])), F.lit(0.0)).alias("score"))
    none = F.array().cast(SPANS)
    return scanned.select("doc_id", "n_words", bind(F.coalesce("spans", none), digest).alias("s")).select("doc_id", "n_words", "s.*")

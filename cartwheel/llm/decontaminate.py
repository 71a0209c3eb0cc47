"""Benchmark decontamination by windows of consecutive words.

Every window of ``size`` words of a benchmark item (a shorter item is one
window of its own length) goes into a hash set, which is broadcast behind a
check of its row count and shuffled beyond it. All windows of all documents
are probed; hits are then confirmed word by word on the document's own words.
DataFrame functions only.

Defined results: null and wordless texts have no words and no windows; equal
rows get equal results, each on its own row; an empty benchmark or table hits
nothing; other columns are ignored. Works on (doc_id, text) and
(item_id, text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import NOT_ALNUM, NOT_ALNUM_CASED, ascii_lower, bind, materialise, of_columns, scan, words

SIZE = 10
#: Most benchmark windows that are sent to every task: with their ten words and items about 50 MB.
BROADCAST_WINDOWS = 100_000


def norm_words(text: Column) -> Column:
    return words(ascii_lower(text), NOT_ALNUM)


def windows_of(probe: DataFrame, size: int, *carried: str) -> DataFrame:
    """``carried`` columns with (at, hash) of each run of ``size`` words of the
    column ``hashes`` (a hash a word); rows of null where a text has none. The
    outer explode keeps a filter on its input away, for which words and hashes
    would be computed again; slices are hashed behind it, in the generated loop."""
    count = F.size("hashes") - size + 1
    places = F.when(count > 0, F.sequence(F.lit(0), count - 1))
    at = probe.select(*carried, "hashes", F.explode_outer(places).alias("at"))
    return at.select(*carried, "at", F.xxhash64(F.slice("hashes", F.col("at") + 1, size)).alias("hash")).where(F.col("at").isNotNull())


def benchmark_windows(benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """(item_id, window, n, hash): distinct windows with their words."""
    w = of_columns(benchmark, "item_id", "text").select("item_id", norm_words(F.col("text")).alias("w"))
    n = F.least(F.lit(size), F.size("w"))
    places = w.where(F.size("w") > 0).select(
        "item_id", "w", n.alias("n"), F.explode(F.sequence(F.lit(1), F.size("w") - n + 1)).alias("at"))
    found = places.select("item_id", "n", F.slice("w", F.col("at"), F.col("n")).alias("window")).distinct()
    return found.withColumn("hash", F.xxhash64(F.transform("window", lambda x: F.xxhash64(x))))


def hits(documents: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """(of, of_hash, spans, items): for documents with any, by doc_id and hash
    of the text, the words [start, end) of confirmed windows and their items."""
    windows = materialise(benchmark_windows(benchmark, size).groupBy("n", "hash", "window").agg(
        F.collect_set("item_id").alias("items")), few=True)
    shape = windows.agg(F.count("*").alias("rows"), F.collect_set("n").alias("sizes")).first()  # at most `size` sizes
    w = of_columns(documents, "doc_id", "text").select(
        F.col("doc_id").alias("of"), F.xxhash64("text").alias("of_hash"), norm_words(F.col("text")).alias("w"))
    probe = w.withColumn("hashes", F.transform("w", lambda x: F.xxhash64(x)))
    confirmed = []
    for n in sorted(shape["sizes"]):
        some = windows.where(F.col("n") == n).drop("n")
        if shape["rows"] <= BROADCAST_WINDOWS:
            # words are compared where hashes are equal only: a plain equality would become a second key, cut for every place
            same = F.slice("w", F.col("at") + 1, n).between(F.col("window"), F.col("window"))
            found = windows_of(probe, n, "of", "of_hash", "w").join(
                F.broadcast(some), "hash").where(same)
        else:
            # too many to send to every task: shuffle the hashes, then the words of the documents that hit
            at = windows_of(probe, n, "of", "of_hash").join(
                some.select("hash").distinct(), "hash").withColumnsRenamed({"of": "id", "of_hash": "id_hash"})
            found = w.join(at, w["of"].eqNullSafe(at["id"]) & (w["of_hash"] == at["id_hash"])).select(
                "of", "of_hash", "at", F.slice("w", F.col("at") + 1, n).alias("window")).join(some.drop("hash"), "window")
        confirmed.append(found.select("of", "of_hash", F.struct(F.col("at").alias("start"), (F.col("at") + n).alias("end")).alias("span"), "items"))
    if not confirmed:  # an empty benchmark
        confirmed = [w.where(F.lit(False)).select("of", "of_hash", F.struct(F.lit(0).alias("start"), F.lit(0).alias("end")).alias("span"),
                                                  F.array(F.lit(0).cast("long")).alias("items"))]
    found = confirmed[0]
    for more in confirmed[1:]:
        found = found.unionByName(more)
    return found.groupBy("of", "of_hash").agg(  # sets within one document
        F.array_sort(F.collect_set("span")).alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))


def union_length(spans: Column) -> Column:
    """Places covered by sorted [start, end) spans."""
    zero = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(spans, zero, lambda acc, s: F.struct(
        F.greatest(acc["upto"], s["end"]).alias("upto"),
        (acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(acc["upto"], s["start"]))).alias("n")))["n"]


def judge(documents: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """Every row's doc_id with n_words, n_hit, spans and items."""
    docs = of_columns(documents, "doc_id", "text").select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.size(norm_words(F.col("text"))).cast("long").alias("n_words"))
    h = hits(documents, benchmark, size)
    return docs.join(h, docs["doc_id"].eqNullSafe(h["of"]) & (docs["text_hash"] == h["of_hash"]), "left").select(
        "doc_id", "n_words", F.coalesce(union_length(F.col("spans")), F.lit(0)).alias("n_hit"), "spans", "items")


def clean_text(text: Column, spans: Column) -> Column:
    """``text`` without the words of ``spans`` (sorted) and the separators
    after them; all else stays as it was. In time linear in words and spans."""
    own = words(text, NOT_ALNUM_CASED)  # in number and order those of norm_words
    between = F.split(text, f"[^{NOT_ALNUM_CASED[1:]}", -1)  # one more than words

    def cut(hit: Column, gaps: Column) -> Column:
        upto = scan(F.transform(hit, lambda s: s["end"]), lambda a, b: F.greatest(a, b), F.lit(0))
        marked = F.zip_with(hit, upto, lambda s, m: F.struct(m.alias("from"), s["start"].alias("to")))
        clean = F.filter(marked, lambda r: r["to"] > r["from"])  # words between what overlaps or touches
        last = F.struct(F.array_max(F.transform(hit, lambda s: s["end"])).alias("from"), F.size(own).alias("to"))
        pieces = bind(F.transform(own, lambda w, i: F.concat(w, F.get(gaps, i + 1))), lambda all_: F.transform(
            F.concat(clean, F.array(last)), lambda r: F.array_join(F.slice(all_, r["from"] + 1, r["to"] - r["from"]), "")))
        return F.concat(F.get(gaps, F.lit(0)), F.array_join(pieces, ""))
    return F.when(spans.isNull(), text).otherwise(bind(spans, lambda hit: bind(between, lambda gaps: cut(hit, gaps))))


def decontaminate(documents: DataFrame, benchmark: DataFrame, size: int = SIZE, remove: str = "spans") -> DataFrame:
    """Documents without benchmark words: their spans cut out, or
    (``remove="documents"``) whole documents with a hit left out."""
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove: {remove!r}")
    h = hits(documents, benchmark, size)
    on = documents["doc_id"].eqNullSafe(h["of"]) & (F.xxhash64(documents["text"]) == h["of_hash"])
    if remove == "documents":
        return documents.join(h, on, "left_anti")
    cols = [clean_text(documents["text"], h["spans"]).alias("text") if c == "text" else documents[c]
            for c in documents.columns]
    return documents.join(h, on, "left").select(*cols)

"""Small tables and brute-force versions for the text operators."""

from __future__ import annotations

import itertools
import random
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
CASED = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Names that operators use inside; as columns of the input they must not clash.
CLASHES = ["n", "hash", "of", "of_hash", "id", "text_hash", "score", "spans", "key", "host", "rank", "length", "component_id", "kept", "label",
           "a", "b", "w", "salt", "base", "items", "rule", "start", "end"]
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" + rng.choice(["", "", "", ".", ","]) for _ in range(n))


def documents(spark, texts, clash: bool = False):
    """Rows (doc_id, text) as a documents table; ``texts`` are pairs or texts."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in rows], DOCUMENT)
    for name in CLASHES if clash else []:
        from pyspark.sql import functions as F
        df = df.withColumn(name, F.lit("x"))
    return df


def words(text: str | None, pattern=WORD, lower: bool = True) -> list[str]:
    text = text or ""
    return pattern.findall(text.translate(LOWER) if lower else text)


def shingles(text: str | None) -> frozenset:
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset({tuple(w)})


def component_ids(rows) -> dict:
    """Brute force: smallest id reachable by links, per doc_id."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for x, y in itertools.combinations(sets, 2):
        both = len(sets[x] & sets[y])
        if both and 100 * both >= 75 * len(sets[x] | sets[y]):
            x, y = root(x), root(y)
            parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in sets}

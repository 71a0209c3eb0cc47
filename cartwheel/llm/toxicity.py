"""Toxicity by a classifier chain of linear models.

The categories are scored one after the other; each model sees the text's
features and the log odds of all earlier categories. For training, those are
out-of-fold predictions, so that a later model learns from odds as uncertain
as the ones it will get.

Features are the presence of hashed words and of hashed word beginnings and
inner n-grams. Per category the SELECTED ones that speak most surely for it are
kept. The models are fitted on at most MAX_TRAIN labelled documents of each
class (smallest hash of doc_id); scoring takes every word of every text.

The labels know one kind of toxicity; the default categories are that label
within English, within all other languages, and as a whole. ``lang`` and the
labels are used for training targets only.

Defined results: null and empty texts get the scores of a text without
features; repeated rows get equal scores each; a category without both
classes scores its smoothed prior; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.batches import map_texts
from cartwheel.llm.common import of_columns
from cartwheel.llm.training import training_rows
from cartwheel.llm.vectors import IS_NOT_ALNUM, Words

#: Name and training target (SQL over the columns of documents and labels).
CATEGORIES = {"toxic_english": "toxic = 1 and coalesce(lang, '') = 'en'",
              "toxic_other": "toxic = 1 and coalesce(lang, '') <> 'en'", "toxic": "toxic = 1"}
BITS = 31
#: Features in fewer training texts than this are left out.
LEAST_TEXTS = 4
PREFIXES = (4, 5, 6)
NGRAMS = (5,)
MAX_TRAIN = 1_500
SELECTED = 600
#: A feature must speak for its category by this many standard errors of its log odds.
SURENESS = 3.5
#: ... and be this much more frequent with it than without, or it would only tell languages apart.
RATIO = 8.0
FOLDS = 5
THRESHOLD = 0.4


def slots(encoded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text index, feature) with repeats: words, beginnings and inner n-grams of words."""
    w = Words(encoded, IS_NOT_ALNUM)
    size = w.end - w.start
    docs, features = [w.doc], [w.hash >> np.uint64(64 - BITS)]
    for k in PREFIXES:
        some = size > k
        docs.append(w.doc[some])
        features.append((w.of_range(w.start[some], w.start[some] + k) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS))
    for k in NGRAMS:
        per = np.maximum(size - k, 0)  # starts after the first byte
        word = np.repeat(np.arange(len(size)), per)
        at = w.start[word] + 1 + np.arange(len(word)) - np.repeat(np.cumsum(per) - per, per)
        docs.append(w.doc[word])
        features.append((w.of_range(at, at + k) * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - BITS))
    return np.concatenate(docs), np.concatenate(features).astype(np.int64)


def distinct(doc: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique((doc << BITS) | feature)
    return both >> BITS, both & ((1 << BITS) - 1)


@dataclass
class Link:
    """A category: its features, weights over these and over the earlier
    categories' log odds, and the intercept."""
    name: str
    features: np.ndarray
    weights: np.ndarray
    chained: np.ndarray
    intercept: float


def log_odds(p: np.ndarray) -> np.ndarray:
    return np.log(np.clip(p, 1e-4, 1 - 1e-4) / np.clip(1 - p, 1e-4, 1 - 1e-4))


def fit_linear(x: np.ndarray, y: np.ndarray, steps: int = 120, l2: float = 2e-4) -> tuple[np.ndarray, float]:
    """Logistic regression by accelerated gradient; the intercept is free."""
    x = np.concatenate([x, np.ones((len(x), 1), np.float32)], 1)
    w = np.zeros(x.shape[1], np.float32)
    look, t = w, 1.0
    v = np.ones(x.shape[1], np.float32)  # largest eigenvalue by power iteration
    for _ in range(8):
        v = x.T @ (x @ v)
        v /= max(float(np.linalg.norm(v)), 1e-9)
    rate = 1 / (0.25 * float(np.linalg.norm(x @ v)) ** 2 / len(y) * 1.1 + l2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(x @ look)))
        g = x.T @ (p - y) / len(y)
        g[:-1] += l2 * look[:-1]
        new = look - rate * g
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return w[:-1], float(w[-1])


def select(doc: np.ndarray, feature: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """The SELECTED of ``n`` features with the surest log odds for ``y`` = 1."""
    yes, all_ = np.bincount(feature[y[doc] > 0], minlength=n), np.bincount(feature, minlength=n)
    no = all_ - yes
    p, q = (yes + 0.5) / (y.sum() + 1), (no + 0.5) / ((1 - y).sum() + 1)
    z = np.log(p / q) / np.sqrt(1 / (yes + 0.5) + 1 / (no + 0.5))
    z = np.where(p > RATIO * q, z, -np.inf)
    best = np.argsort(-z, kind="stable")[:SELECTED]
    return np.sort(best[z[best] > SURENESS])


def matrix(doc: np.ndarray, feature: np.ndarray, chosen: np.ndarray, docs: int, n: int) -> np.ndarray:
    at = np.full(n, -1)
    at[chosen] = np.arange(len(chosen))
    kept = at[feature] >= 0
    x = np.zeros((docs, len(chosen)), np.float32)
    x[doc[kept], at[feature[kept]]] = 1
    return x


def fit_chain(doc: np.ndarray, feature: np.ndarray, targets: dict[str, np.ndarray], fold: np.ndarray) -> list[Link]:
    """One link per category; ``fold`` (0..FOLDS-1) of each training text."""
    known, texts = np.unique(feature, return_counts=True)
    known = known[texts >= LEAST_TEXTS]
    n = len(known)
    at = np.minimum(np.searchsorted(known, feature), max(n - 1, 0)).astype(np.int32)
    often = known[at] == feature if n else np.zeros(len(feature), bool)
    doc, feature = doc[often].astype(np.int32), at[often]
    earlier = np.zeros((len(fold), 0), np.float32)
    links = []
    for name, y in targets.items():
        if len(y) < 2 * FOLDS or y.min() == y.max():
            odds = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
            links.append(Link(name, np.zeros(0, np.int64), np.zeros(0, np.float32), np.zeros(earlier.shape[1], np.float32), odds))
            earlier = np.concatenate([earlier, np.full((len(y), 1), odds, np.float32)], 1)
            continue

        def train(rows: np.ndarray) -> Link:
            of = np.full(len(y), -1)
            of[rows] = np.arange(len(rows))
            there = of[doc] >= 0
            d, f = of[doc[there]], feature[there]
            chosen = select(d, f, y[rows], n)
            x = np.concatenate([matrix(d, f, chosen, len(rows), n), earlier[rows]], 1)
            w, b = fit_linear(x, y[rows])
            return Link(name, chosen, w[:len(chosen)], w[len(chosen):], b)
        out_of_fold = np.zeros(len(y))
        for k in range(FOLDS):
            rows = np.flatnonzero(fold != k)
            rest = np.flatnonzero(fold == k)
            if not len(rest) or y[rows].min() == y[rows].max():
                out_of_fold[rest] = y[rows].mean() if len(rows) else y.mean()
                continue
            link = train(rows)
            x = matrix(doc, feature, link.features, len(y), n)[rest]
            out_of_fold[rest] = 1 / (1 + np.exp(-(x @ link.weights + earlier[rest] @ link.chained + link.intercept)))
        link = train(np.arange(len(y)))
        link.features = known[link.features].astype(np.int64)
        links.append(link)
        earlier = np.concatenate([earlier, log_odds(out_of_fold)[:, None].astype(np.float32)], 1)
    return links


def fit(documents: DataFrame, labels: DataFrame, categories: dict[str, str] | None = None, bound: int = MAX_TRAIN) -> list[Link]:
    categories = categories or CATEGORIES
    rows = training_rows(of_columns(documents, "doc_id", "text", "lang"), labels, ["toxic"], bound, learn_from_held_out=True)
    targets = [F.coalesce(F.expr(sql), F.lit(False)).cast("int").alias(f"y{k}") for k, sql in enumerate(categories.values())]
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("fold")
    rows = rows.select("doc_id", "text", fold, *targets)

    def work(encoded: list[bytes]) -> dict:
        doc, feature = distinct(*slots(encoded))
        return {"features": np.split(feature.astype(np.int32), np.searchsorted(doc, np.arange(1, len(encoded))))}

    kept = ["doc_id", "fold", *[f"y{k}" for k in range(len(categories))]]
    got = map_texts(rows, kept, {"features": "array<int>"}, work).toPandas().sort_values(kept)
    lists = list(got.pop("features"))
    doc = np.repeat(np.arange(len(lists), dtype=np.int32), [len(x) for x in lists])
    feature = np.concatenate(lists) if lists else np.zeros(0, np.int32)
    del lists
    return fit_chain(doc, feature, {name: got[f"y{k}"].to_numpy(np.float32) for k, name in enumerate(categories)}, got["fold"].to_numpy())


def score(documents: DataFrame, links: list[Link], keep: list[str]) -> DataFrame:
    """Columns ``keep`` with one probability p_<category> per link."""
    chosen = np.unique(np.concatenate([k.features for k in links]))
    near = np.zeros(1 << 16, bool)
    near[chosen & 0xFFFF] = True
    weights = [np.zeros(len(chosen)) for _ in links]
    for link, weight in zip(links, weights):
        weight[np.searchsorted(chosen, link.features)] = link.weights

    def work(encoded: list[bytes]) -> dict:
        doc, feature = slots(encoded)
        some = near[feature & 0xFFFF]  # most features are no model's: drop them cheaply
        doc, feature = doc[some], feature[some]
        at = np.searchsorted(chosen, feature)
        some = chosen[np.minimum(at, len(chosen) - 1)] == feature if len(chosen) else np.zeros(0, bool)
        doc, at = distinct(doc[some], at[some])
        odds: list[np.ndarray] = []
        for link, weight in zip(links, weights):
            total = np.bincount(doc, weight[at], len(encoded)) + link.intercept
            odds.append(total + sum(w * log_odds(1 / (1 + np.exp(-o))) for w, o in zip(link.chained, odds)))
        return {f"p_{link.name}": 1 / (1 + np.exp(-o)) for link, o in zip(links, odds)}

    return map_texts(documents, keep, {f"p_{link.name}": "double" for link in links}, work)

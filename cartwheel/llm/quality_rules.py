"""Quality rules: exact base rules, and boosted trees over document statistics.

The trees are fitted on at most MAX_TRAIN labelled documents of each class
(those with the smallest hash of doc_id, held-out ids left out), with the
score never rising in the shares of symbols, repeated lines, repeated windows
and exclamation marks. Scoring runs the flat node arrays over whole batches.

Defined results: a null or empty text has no words and fails the base rule;
repeated rows get equal results each; without labels of both classes the
verdict is the smoothed prior; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from cartwheel.llm import trees
from cartwheel.llm.batches import map_texts
from cartwheel.llm.common import of_columns
from cartwheel.llm.stats import FEATURES, base_counts, features
from cartwheel.llm.training import training_rows
from cartwheel.llm.vectors import Words

MAX_TRAIN = 6_000
THRESHOLD = 0.3
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def fit(documents: DataFrame, labels: DataFrame, bound: int = MAX_TRAIN) -> trees.Forest:
    def work(encoded: list[bytes]) -> dict:
        w = Words(encoded, lower=False)
        return dict(zip(FEATURES, features(w, base_counts(w)).T))

    rows = training_rows(of_columns(documents, "doc_id", "text"), labels, ["quality"], bound)
    got = map_texts(rows, ["doc_id", "quality"], dict.fromkeys(FEATURES, "double"), work).toPandas()
    got = got.sort_values(["doc_id", *FEATURES])
    return trees.fit(got[list(FEATURES)].to_numpy(float), (got["quality"].to_numpy() > 0).astype(float),
                     np.array(list(FEATURES.values())))


def judge(documents: DataFrame, forest: trees.Forest, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, the base counts, base_failed, score, kept."""
    def work(encoded: list[bytes]) -> dict:
        w = Words(encoded, lower=False)
        base = base_counts(w)
        score = forest.score(features(w, base))
        n, repeats = base["n_words"], base["n_repeat_words"]
        failed = (n < 20) | (100 * repeats > 30 * n)
        return {c: base[c] for c in COUNTS} | {
            "base_failed": failed, "score": score, "kept": ~failed & (score >= threshold)}

    fields = dict.fromkeys(COUNTS, "long") | {"base_failed": "boolean", "score": "double", "kept": "boolean"}
    return map_texts(of_columns(documents, "doc_id", "text"), ["doc_id"], fields, work)

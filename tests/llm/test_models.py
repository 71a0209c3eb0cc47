"""Classifiers: held-out accuracy, exact parts and edge cases."""

import random

import numpy as np
import pytest
from llm_util import documents, prose
from pyspark.sql import functions as F

from cartwheel.llm import mil, quality_rules, toxicity, trees
from cartwheel.llm.training import held_out, training_rows

EDGES = [(900, None), (901, ""), (902, " \n"), (None, "no id"), (903, "same"), (903, "same"), (904, "w1 w2 " * 60_000), (905, "é😀")]
RUDE = ["zorgish", "blatful", "mugwump"]


def corpus(n=400, seed=1):
    """Texts with (quality, toxic): noise symbols mark low quality, words with one of a few beginnings toxicity."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = prose(rng, rng.randrange(30, 300)).split()
        quality, toxic = int(rng.random() > 0.3), int(rng.random() < 0.25)
        if not quality:
            words = [w + rng.choice(["###", "$$$", "%%%"]) for w in words]
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(RUDE) + rng.choice(["", "ly", "ness", "est"])
        out.append((i, " ".join(words), quality, toxic))
    return out


@pytest.fixture(scope="module")
def tables(spark):
    rows = corpus()
    docs = documents(spark, [(i, t) for i, t, _, _ in rows] + EDGES, clash=True)
    labels = spark.createDataFrame([(i, q, t) for i, _, q, t in rows] + [(5, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    return docs, labels, rows


def test_quality_classifier_on_held_out_rows(spark, tables):
    docs, labels, rows = tables
    model = mil.fit(docs, labels)
    got = mil.score(docs, model, ["doc_id"]).withColumn("held_out", held_out(F.col("doc_id"))).collect()
    quality = {i: q for i, _, q, _ in rows}
    held = [r for r in got if r.held_out and r.doc_id in quality]
    assert len(got) == len(rows) + len(EDGES) and len(held) > 40
    assert sum(r.predicted == quality[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert len({r.score for r in got if r.doc_id == 903}) == 1


def test_attention_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    x, bag, y = rng.standard_normal((7, 5)), np.array([0, 0, 0, 1, 2, 2, 2]), np.array([1.0, 0.0, 1.0])
    p = {"encode": rng.standard_normal((5, 4)), "encode0": rng.standard_normal(4), "tanh": rng.standard_normal((4, 3)),
         "gate": rng.standard_normal((4, 3)), "weigh": rng.standard_normal(3), "out": rng.standard_normal(4), "out0": np.zeros(1)}

    def loss():
        z = mil.forward(p, x, bag)["logit"]
        return float(np.mean(np.log1p(np.exp(z)) - y * z))
    grads = mil.gradients(p, x, bag, y)
    for name, a in p.items():
        for at in list(np.ndindex(a.shape))[:6]:
            keep, eps = a[at], 1e-5
            a[at] = keep + eps
            up = loss()
            a[at] = keep - eps
            down = loss()
            a[at] = keep
            assert abs((up - down) / (2 * eps) - grads[name][at]) < 1e-5, name


def test_passages_cover_the_whole_text_and_ignore_the_batch():
    texts = [(" ".join(f"w{i}" for i in range(n))).encode() for n in (0, 1, 128, 129, 1000)]
    x, bag = mil.encode(texts)
    assert np.bincount(bag).tolist() == [1, 1, 1, 2, 8]
    for k, t in enumerate(texts):
        assert np.allclose(mil.encode([t])[0], x[bag == k])


def test_toxicity_chain_finds_toxic_and_leaves_clean(spark, tables):
    docs, labels, rows = tables
    known = labels.where(F.pmod("doc_id", F.lit(4)) != 0)
    links = toxicity.fit(docs, known)
    assert [k.name for k in links] == list(toxicity.CATEGORIES) and [len(k.chained) for k in links] == [0, 1, 2]
    got = {r.doc_id: r.p_toxic for r in toxicity.score(docs, links, ["doc_id"]).collect()}
    unseen = [(got[i] >= toxicity.THRESHOLD, bool(t)) for i, _, _, t in rows if i % 4 == 0]
    assert sum(a == b for a, b in unseen) >= 0.97 * len(unseen)
    assert all(got[i] < toxicity.THRESHOLD for i in (900, 901, 902, 903, 904, 905, None))


def test_quality_trees(spark, tables):
    docs, labels, rows = tables
    forest = quality_rules.fit(docs, labels)
    got = quality_rules.judge(docs, forest).collect()
    quality = {i: q for i, _, q, _ in rows}
    held = [r for r in got if r.doc_id in quality]
    assert sum(r.kept == bool(quality[r.doc_id]) for r in held) >= 0.97 * len(held)
    by = {r.doc_id: r for r in got}
    assert all(by[i].base_failed and not by[i].kept for i in (900, 901, 902, 903, 904, 905))


def test_trees_fit_and_keep_their_constraints():
    rng = np.random.default_rng(3)
    x = rng.random((2_000, 3))
    y = ((x[:, 0] < 0.5) ^ (rng.random(2_000) < 0.1)).astype(float)
    forest = trees.fit(x, y, np.array([-1, 0, 1]))
    assert ((forest.score(x) >= 0.5) == (x[:, 0] < 0.5)).mean() > 0.97
    grid = np.tile(rng.random((50, 3)), (1, 1))
    for j, sign in ((0, -1), (2, 1)):
        steps = []
        for v in np.linspace(0, 1, 41):
            g = grid.copy()
            g[:, j] = v
            steps.append(forest.score(g))
        assert (sign * np.diff(np.stack(steps), axis=0) >= -1e-12).all()

    def walk(n, row):  # a plain walk gives the vectorised score
        while forest.left[n] != n:
            n = forest.left[n] if row[forest.feature[n]] <= forest.threshold[n] else forest.right[n]
        return forest.value[n]
    want = [forest.base + sum(walk(r, row) for r in forest.roots) for row in grid]
    assert np.allclose(forest.score(grid), 1 / (1 + np.exp(-np.array(want))))


def test_without_labels_scores_are_the_prior(spark):
    docs = documents(spark, EDGES)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(903, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, one):
        assert {round(r.score, 6) for r in mil.score(docs, mil.fit(docs, labels), ["doc_id"]).collect()} <= {0.5, 0.666667, 0.75}
        assert quality_rules.judge(docs, quality_rules.fit(docs, labels)).count() == len(EDGES)
        assert toxicity.score(docs, toxicity.fit(docs, labels), ["doc_id"]).count() == len(EDGES)
    empty = documents(spark, [])
    assert mil.score(empty, mil.fit(docs, none), ["doc_id"]).count() == 0


def test_training_rows_are_bounded_and_leave_out_held_out(spark, tables):
    docs, labels, _ = tables
    got = training_rows(docs, labels, ["quality"], 20).withColumn("out", held_out(F.col("doc_id"))).collect()
    assert len(got) == 40 and not any(r.out for r in got) and sum(r.quality for r in got) == 20

"""Mixing, the Merkle manifest and whitening against brute force."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from llm_util import DOCUMENT, documents, prose, words
from pyspark.sql import functions as F

from cartwheel.llm import merkle, mixing, svd, whitening


# mixing

def wanted_targets(sizes):
    """{source: target}: the excess of capped sources reshared by weight, step by step."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, todo, left = {}, set(order), 1.5 * sum(sizes.values())
    while todo:
        level = left / sum(weight[s] for s in todo)
        over = {s for s in todo if weight[s] * level > 2 * sizes[s]}
        for s in over or todo:
            target[s] = 2.0 * sizes[s] if over else weight[s] * level
        left -= sum(target[s] for s in over)
        todo = todo - over if over else set()
    return target


def wanted_taken(rows, target, total):
    """In the order of places, a document is taken if it still fits; rows of one place together."""
    whole = math.floor(target / max(1, total))
    left, extra = target - whole * total, set()
    by = {}
    for doc_id, size in rows:
        place = int(hashlib.md5(("-" if doc_id is None else str(doc_id)).encode()).hexdigest()[:15], 16)
        by.setdefault(place, []).append((doc_id, size))
    for place in sorted(by):
        if left <= 0.001 * target:
            break
        fit = [x for x in by[place] if 0 < x[1] <= left]
        if fit and sum(s for _, s in fit) <= left:
            left -= sum(s for _, s in fit)
            extra |= set(fit)
    return {x: x[1] * (whole + (x in extra)) for x in rows}


@pytest.mark.parametrize("limit", [50_000, 0])
def test_mixing_matches_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", limit)
    rng = random.Random(5)
    sources = ["a", "B", "é", "", "zz", None, "hot"]
    rows = [(i, prose(rng, rng.choice([0, 1, 3, 10, 40, 300])), "en", rng.choice(sources + ["hot"] * 4), 1) for i in range(260)]
    rows += [(7, "again and again", None, "hot", 1)] * 2 + [(500, None, None, "only", None), (None, "no id", None, "a", None), (501, " \t\n", "en", None, 3),
                                                          (502, "x " * 5000, "en", "tiny", 1), (503, "y", "en", "tiny", 1)]
    docs = spark.createDataFrame(rows, DOCUMENT).withColumn("size", F.lit("x")).withColumn("place", F.lit(1)).withColumn("target", F.lit(None).cast("string"))
    got = mixing.mix(docs).collect()
    sizes, by = {}, {}
    for doc_id, text, _, source, _ in rows:
        n = len(words(text))
        sizes[source] = sizes.get(source, 0) + n
        by.setdefault(source, []).append((doc_id, n))
    target = wanted_targets(sizes)
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, target[r.source], rel_tol=1e-12, abs_tol=1e-9)
        assert r.taken == wanted_taken(by[r.source], r.target, sizes[r.source])[r.doc_id, r["size"]] <= 2 * r["size"]
    assert sorted(map(str, mixing.mix(docs.repartition(7)).collect())) == sorted(map(str, got))
    taken = {s: sum(r.taken for r in got if r.source == s) for s in sizes}
    assert abs(taken["hot"] - target["hot"]) <= 0.002 * target["hot"]


def test_mixing_of_nothing(spark):
    assert mixing.mix(documents(spark, [])).count() == 0
    got = mixing.mix(documents(spark, [None, "", " "])).collect()
    assert [(r["size"], r.source_size, r.target, r.taken) for r in got] == [(0, 0, 0.0, 0)] * 3


# merkle

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(digests):
    """(top, per digest its [(left, right)] on the way)."""
    ways = [[] for _ in digests]
    under = [[k] for k in range(len(digests))]
    while len(digests) > 1:
        runs = [range(k, min(k + 3, len(digests))) for k in range(0, len(digests), 3)]
        for run in runs:
            for k in run:
                for leaf in under[k]:
                    ways[leaf].append(("".join(digests[run.start:k]), "".join(digests[k + 1:run.stop])))
        digests, under = [H(*[digests[k] for k in run]) for run in runs], [[x for k in run for x in under[k]] for run in runs]
    return digests[0], ways


@pytest.mark.parametrize("limit", [20_000, 0])
def test_manifest_matches_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(merkle, "BROADCAST_NODES", limit)
    rng = random.Random(8)
    rows = [(i, rng.choice([None, "", "line\nline", "plain é\n\n", prose(rng, 5)]), rng.choice(["en", None]), rng.choice(["hot"] * 8 + ["a", "b", None, "é"]),
             rng.choice([None, 3])) for i in rng.sample(range(10_000), 110)]
    rows += [(3, "lone\n", "en", "lone", 1), (None, "x\n", None, "a", None), (20_000, "same\n", "en", "b", 1), (20_000, "same\n", "en", "b", 1), (20_000, "other", "en", "b", 1)]
    docs = spark.createDataFrame(rows, DOCUMENT).withColumn("leaf", F.lit("x")).withColumn("tree", F.lit(1)).withColumn("root", F.lit(2))
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    got = merkle.proofs(docs, even, F.replace(F.col("text"), F.lit("\n"))).collect()
    by = {}
    for d, text, lang, source, n in rows:
        changed = text if d is None or text is None or zlib.crc32(str(d).encode()) % 2 else text.replace("\n", "")
        by.setdefault(source, []).append((d, encoded((d, source, lang, n, text)), encoded((d, source, lang, n, changed))))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for leaves in by.values():
        leaves.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = {s: climb([leaf for _, leaf, _ in by[s]]) for s in order}
    root, above = climb([trees[s][0] for s in order])
    want = []
    for k, s in enumerate(order):
        for (d, leaf, changed), way in zip(by[s], trees[s][1]):
            whole, folded = way + above[k], changed
            for left, right in whole:
                folded = H(left, folded, right)
            want.append((d, leaf, trees[s][0], root, H(*[x for step in whole for x in step]), folded, folded == root))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert {r.verified for r in got} == {True, False}


def test_manifest_of_one_and_none(spark):
    def run(rows):
        return merkle.proofs(spark.createDataFrame(rows, DOCUMENT), F.lit(False), F.col("text")).collect()
    assert run([]) == []
    (r,) = run([(1, None, None, None, None)])
    assert r.leaf == r.subroot == r.root == r.folded_root == H("1:1", "-", "-", "-", "-") and r.proof_sha256 == H("") and r.verified
    rows = run([(k, "t" * 100_000, None, s, 1) for s in ("a", "b") for k in range(3)])
    assert all(r.verified for r in rows) and len({r.root for r in rows}) == 1 and len({r.subroot for r in rows}) == 2


# whitening

VECTORS = "vec_id long, embedding array<float>"


def test_whitening_matches_eigenvectors(spark):
    rng = np.random.default_rng(3)
    base = (rng.standard_normal((400, 20)) @ rng.standard_normal((20, 20))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(1000 + i, base[7].tolist()) for i in range(300)]
    bad = [(2000, None), (2001, []), (2002, [None] * 20), (2003, [float("nan")] * 20), (2004, [float("inf")] + [0.0] * 19), (2005, [1.0] * 3), (2006, [1e30] * 20)]
    df = spark.createDataFrame(rows + bad, VECTORS).repartition(6)
    for name in ("x", "n", "component", "c", "r"):
        df = df.withColumn(name, F.lit("x"))
    got = whitening.whiten(df).collect()
    x = np.floor(64 * np.array([v for _, v in rows], np.float32).astype(float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(0)
    centred = fit - total / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert {r.n for r in got} == {n} and len(got) == 16 * len(rows) and {r.component for r in got} == set(range(1, 17))
    at = {i: k for k, (i, _) in enumerate(rows)}
    dev = n * x - total
    exact = {i: int((dev[k].astype(object) ** 2).sum()) for i, k in at.items()}
    sign = {}
    for r in got:
        k, c = at[r.vec_id], r.component - 1
        w = (dev[k] / n) @ vectors[:, c] / math.sqrt(values[c])
        s = sign.setdefault(c, 1 if w * r.whitened > 0 else -1)
        assert abs(r.whitened - s * w) < 1e-7 and r.deviation == exact[r.vec_id]
        assert abs(r.explained - values[c] / values.sum()) < 1e-9 and r.identity_error < 1e-9


def test_whitening_of_few_equal_and_no_rows(spark):
    def run(rows):
        return whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    assert run([]) == [] and run([(1, None), (2, [])]) == []
    assert run([(i, [1.0, 2.0]) for i in range(5)]) == []  # no variance, no component
    got = run([(1, [0.0, 0.0, 1.0]), (2, [0.0, 0.0, 2.0]), (2, [0.0, 0.0, 2.0]), (3, [0.0, 0.0, 4.0])])
    assert [r.component for r in got] == [1] * 4 and {r.n for r in got} == {3} and all(abs(r.explained - 1) < 1e-12 for r in got)


def test_factors_are_reduced_in_groups(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 3)
    monkeypatch.setattr(whitening, "BLOCK", 5)
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(6).tolist()) for i in range(400)]
    got = whitening.whiten(spark.createDataFrame(rows, VECTORS).repartition(20)).collect()
    assert len(got) == 6 * 400 and all(r.identity_error < 1e-9 for r in got)


@pytest.mark.parametrize("kind", ["plain", "decay", "low rank", "few", "equal", "pairs", "rotated pairs", "one", "copies"])
def test_singular_values_and_vectors(kind):
    rng = np.random.default_rng(9)
    q, _ = np.linalg.qr(rng.standard_normal((32, 32)))
    a = {"plain": rng.standard_normal((300, 32)), "decay": rng.standard_normal((300, 32)) @ np.diag(10.0 ** -np.arange(0, 16, 0.5)),
         "low rank": rng.standard_normal((300, 4)) @ rng.standard_normal((4, 32)), "few": np.vstack([rng.standard_normal((5, 32)), np.zeros((27, 32))]),
         "equal": np.eye(32), "pairs": np.diag(np.repeat(np.arange(1.0, 17), 2)), "rotated pairs": np.diag(np.repeat(np.arange(1.0, 17), 2)) @ q,
         "one": rng.standard_normal((9, 1)), "copies": np.repeat(rng.standard_normal((90, 8)), 4, axis=1)}[kind]
    r = np.linalg.qr(a, mode="r")
    diagonal, above, v = svd.bidiagonal(r)
    b = np.diag(diagonal) + np.diag(above, 1)
    assert np.allclose(v.T @ v, np.eye(len(v)), atol=1e-12) and np.allclose(b.T @ b, v.T @ r.T @ r @ v, atol=1e-9 * np.linalg.norm(r) ** 2)
    want = np.linalg.svd(r, compute_uv=False)
    assert np.allclose(np.sqrt(np.maximum(svd.dqds(diagonal, above), 0)), want, atol=1e-13 * want[0] * len(want))
    values, vectors = svd.directions(r, 16)
    rank = int((want > 1e-12 * want[0]).sum())
    assert len(values) == min(16, rank)
    white = r @ vectors / np.sqrt(values)
    assert np.abs(white.T @ white - np.eye(len(values))).max() < 1e-9

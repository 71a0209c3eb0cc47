"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE_WORDS words that cover its whole
text. Each passage is encoded as hashed word counts and character shares; a
learned layer maps it to a hidden vector, gated attention (a tanh and a
sigmoid branch) weighs the passages of a document, and the weighted vector is
scored. All weights are learned from document labels alone, on every passage
of at most MAX_TRAIN labelled documents of each class and at most about
MAX_TRAIN_CHARS characters of them (whole documents, those of the least
hashes); scoring takes every passage.

Defined results: a null or empty text is one empty passage and gets a score;
repeated rows get equal scores each; without labels of both classes the score
is the smoothed prior; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.batches import map_texts
from cartwheel.llm.common import materialise, of_columns
from cartwheel.llm.stats import BANG, DIGIT, PUNCT, SYMBOLS, UPPER
from cartwheel.llm.training import training_rows
from cartwheel.llm.vectors import Words, windows

PASSAGE_WORDS = 128
BUCKETS = 96
SHARES = 10
MAX_TRAIN = 3_000
#: Of each class: about 60,000 passages, 25 MB as vectors at the driver.
MAX_TRAIN_CHARS = 40_000_000
THRESHOLD = 0.3


def encode(encoded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(vectors, text index) of every passage, in text order."""
    w = Words(encoded, lower=False)
    per_text = np.maximum(1, -(-w.n // PASSAGE_WORDS))
    first = np.cumsum(per_text) - per_text
    total = int(per_text.sum())
    passage = first[w.doc] + (np.arange(len(w.doc)) - w.first[w.doc]) // PASSAGE_WORDS
    bucket = (w.hash >> np.uint64(33)).astype(np.int64) % BUCKETS
    counts = np.bincount(passage * BUCKETS + bucket, minlength=total * BUCKETS).reshape(total, BUCKETS).astype(np.float32)
    counts = np.log1p(counts)
    counts /= np.maximum(np.linalg.norm(counts, axis=1, keepdims=True), 1e-6)
    n = np.bincount(passage, minlength=total)
    size = np.maximum(np.bincount(passage, w.end - w.start, total), 1)

    def share(flags: np.ndarray) -> np.ndarray:
        upto = np.concatenate(([0], np.cumsum(flags[w.data])))
        return np.bincount(passage, upto[w.end] - upto[w.start], total) / size

    def repeats(at: np.ndarray, h: np.ndarray) -> np.ndarray:
        p = passage[at]
        order = np.lexsort((h, p))
        p, x = p[order], h[order]
        again = (p[1:] == p[:-1]) & (x[1:] == x[:-1])
        return np.bincount(p[1:][again], minlength=total) / np.maximum(n, 1)

    length = size / np.maximum(n, 1)
    shares = np.stack([share(SYMBOLS), share(UPPER), share(DIGIT), share(PUNCT), share(BANG),
                       repeats(np.arange(len(w.hash)), w.hash), repeats(*windows(w.hash, w.doc, 3)),
                       np.log1p(n) / 5, np.minimum(length, 40) / 10, n == 0], 1).astype(np.float32)
    return np.concatenate([counts, shares], 1), np.repeat(np.arange(len(encoded)), per_text)


@dataclass
class Model:
    prior: float
    scale: np.ndarray
    params: dict[str, np.ndarray] | None

    def score(self, x: np.ndarray, bag: np.ndarray, bags: int) -> np.ndarray:
        if self.params is None:
            return np.full(bags, self.prior)
        return 1 / (1 + np.exp(-forward(self.params, x * self.scale, bag)["logit"].astype(float)))


def forward(p: dict[str, np.ndarray], x: np.ndarray, bag: np.ndarray) -> dict[str, np.ndarray]:
    """``bag`` is sorted; every bag from 0 has a passage."""
    starts = np.flatnonzero(np.concatenate(([True], bag[1:] != bag[:-1])))
    h = np.maximum(x @ p["encode"] + p["encode0"], 0)
    t, s = np.tanh(h @ p["tanh"]), 1 / (1 + np.exp(-(h @ p["gate"])))
    raw = (t * s) @ p["weigh"]
    e = np.exp(raw - np.maximum.reduceat(raw, starts)[bag])
    a = e / np.add.reduceat(e, starts)[bag]
    z = np.add.reduceat(a[:, None] * h, starts)
    return {"h": h, "t": t, "s": s, "a": a, "z": z, "starts": starts, "logit": z @ p["out"] + p["out0"]}


def gradients(p: dict[str, np.ndarray], x: np.ndarray, bag: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    f = forward(p, x, bag)
    d = ((1 / (1 + np.exp(-f["logit"])) - y) / len(y)).astype(np.float32)
    dz = d[:, None] * p["out"]
    da = (f["h"] * dz[bag]).sum(1)
    draw = f["a"] * (da - np.add.reduceat(f["a"] * da, f["starts"])[bag])
    dts = draw[:, None] * p["weigh"]
    dt, ds = dts * f["s"] * (1 - f["t"] ** 2), dts * f["t"] * f["s"] * (1 - f["s"])
    dh = (f["a"][:, None] * dz[bag] + dt @ p["tanh"].T + ds @ p["gate"].T) * (f["h"] > 0)
    return {"encode": x.T @ dh, "encode0": dh.sum(0), "tanh": f["h"].T @ dt, "gate": f["h"].T @ ds,
            "weigh": (f["t"] * f["s"]).T @ draw, "out": f["z"].T @ d, "out0": d.sum(keepdims=True)}


def learn(x: np.ndarray, bag: np.ndarray, y: np.ndarray, hidden: int = 32, attention: int = 16,
          epochs: int = 25, batch: int = 64, rate: float = 0.004, decay: float = 1e-4, seed: int = 7) -> Model:
    """Adam on the log loss of the bags; ``x`` rows in bag order."""
    prior = float((y.sum() + 1) / (len(y) + 2))
    scale = (1 / np.maximum(x.std(0), 1e-2)).astype(np.float32) if len(x) else np.ones(x.shape[1], np.float32)
    if len(y) < 4 or y.min() == y.max():
        return Model(prior, scale, None)
    rng = np.random.default_rng(seed)

    def start(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    p = {"encode": start(x.shape[1], hidden), "encode0": np.zeros(hidden, np.float32), "tanh": start(hidden, attention),
         "gate": start(hidden, attention), "weigh": start(attention), "out": start(hidden),
         "out0": np.full(1, np.log(prior / (1 - prior)), np.float32)}
    m, v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
    x *= scale  # in place: the caller's vectors are not used again
    first = np.searchsorted(bag, np.arange(len(y)))
    size = np.bincount(bag, minlength=len(y))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for k in range(0, len(order), batch):
            some = order[k:k + batch]
            rows = np.concatenate([np.arange(first[b], first[b] + size[b]) for b in some])
            grads = gradients(p, x[rows], np.repeat(np.arange(len(some)), size[some]), y[some])
            step += 1
            for name, g in grads.items():
                g = g + decay * p[name]
                m[name] = 0.9 * m[name] + 0.1 * g
                v[name] = 0.999 * v[name] + 0.001 * g * g
                p[name] = p[name] - rate * (m[name] / (1 - 0.9 ** step)) / (np.sqrt(v[name] / (1 - 0.999 ** step)) + 1e-8)
    return Model(prior, scale, {k: a.astype(np.float32) for k, a in p.items()})


def fit(documents: DataFrame, labels: DataFrame, bound: int = MAX_TRAIN, chars: int = MAX_TRAIN_CHARS) -> Model:
    def work(encoded: list[bytes]) -> dict:
        x, bag = encode(encoded)
        ends = np.searchsorted(bag, np.arange(len(encoded) + 1))
        return {"passages": [x[a:b].ravel() for a, b in zip(ends, ends[1:])]}

    rows = materialise(training_rows(of_columns(documents, "doc_id", "text"), labels, ["quality"], bound))
    # few and short rows: the running length says where the sample of a class ends
    so_far = Window.partitionBy("quality").orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    sized = rows.select("doc_id", "quality", F.coalesce(F.length("text"), F.lit(0)).alias("size"))
    taken = sized.withColumn("before", F.coalesce(F.sum("size").over(so_far), F.lit(0))).where(F.col("before") <= chars).select("doc_id").distinct()
    rows = rows.join(F.broadcast(taken), "doc_id")  # at most 2 x bound ids
    got = map_texts(rows, ["doc_id", "quality"], {"passages": "array<float>"}, work).toArrow().sort_by(
        [("doc_id", "ascending"), ("quality", "ascending")])
    y = (got["quality"].to_numpy() > 0).astype(np.float32)
    lists = got["passages"].combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy()) // (BUCKETS + SHARES)
    x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, BUCKETS + SHARES)
    del got, lists
    return learn(x, np.repeat(np.arange(len(y)), sizes), y)


def score(documents: DataFrame, model: Model, keep: list[str], threshold: float = THRESHOLD,
          value: str = "score", flag: str = "predicted") -> DataFrame:
    """Columns ``keep`` with the score and whether it reaches ``threshold``."""
    def work(encoded: list[bytes]) -> dict:
        x, bag = encode(encoded)
        s = model.score(x, bag, len(encoded))
        return {value: s, flag: (s >= threshold).astype(np.int32)}

    return map_texts(documents, keep, {value: "double", flag: "int"}, work)

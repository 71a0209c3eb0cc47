"""Word and shingle hashes of many texts at once, as numpy arrays.

A text is handled as its UTF-8 bytes. Hashes are 64-bit sums of a random
value per byte times a power of an odd number, so that the hash of any byte
range comes from two prefix sums; ``mix`` then scatters them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BYTE_VALUES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
IS_NOT_ALNUM = np.zeros(256, bool)
IS_NOT_ALNUM[[*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
CHUNK_BYTES = 1_500_000


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    out = np.full(n, BASE, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


def chunks(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """(first index, encoded texts) in runs of about CHUNK_BYTES; a text is
    never cut, so a chunk is at most that much plus one text."""
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        b = (t or "").encode("utf-8", "surrogatepass")
        if held and size + len(b) > CHUNK_BYTES:
            yield first, held
            first, held, size = i, [], 0
        held.append(b)
        size += len(b)
    if held:
        yield first, held


class Words:
    """Words of several texts: ``start``/``end`` byte offsets in ``data``,
    ``doc`` index per word, ``n`` words per text, 64-bit ``hash`` per word."""

    def __init__(self, encoded: list[bytes], separators: np.ndarray = IS_SPACE, lower: bool = True):
        raw = np.frombuffer(b"\n".join(encoded) + b"\n", dtype=np.uint8)
        self.raw = raw
        self.data = LOWERED[raw] if lower else raw
        sizes = np.fromiter((len(b) + 1 for b in encoded), np.int64, len(encoded))
        self.text_end = np.cumsum(sizes) - 1
        self.text_start = self.text_end - sizes + 1
        sep = separators[self.data]
        sep[self.text_end] = True
        edge = np.diff(np.concatenate(([True], sep)).astype(np.int8))
        self.start = np.flatnonzero(edge == -1)
        self.end = np.flatnonzero(edge == 1)
        if len(self.end) < len(self.start):
            self.end = np.append(self.end, len(raw))
        self.doc = np.searchsorted(self.text_end, self.start)
        self.n = np.bincount(self.doc, minlength=len(encoded))
        self.first = np.cumsum(self.n) - self.n
        self._pow = powers(len(raw) + 1)
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[self.data] * self._pow[:-1], out=total[1:])
        self._total = total
        self.hash = self.of_range(self.start, self.end)

    def of_range(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of byte ranges, alike for equal bytes at any place."""
        return mix((self._total[end] - self._total[start]) * INVERSE_POWERS.upto(len(self._pow))[start] + (end - start).astype(np.uint64))


class _Inverse:
    """Powers of the inverse of BASE modulo 2**64, grown as needed."""

    def __init__(self):
        self.values = np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.values) < n:
            out = np.full(n, np.uint64(pow(int(BASE), -1, 2**64)), dtype=np.uint64)
            out[0] = 1
            self.values = np.multiply.accumulate(out, dtype=np.uint64)
        return self.values


INVERSE_POWERS = _Inverse()


def windows(hashes: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of first word, hash) of every run of ``k`` words in one text."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = mix(out + hashes[j : j + n] * np.uint64(2 * j + 3))
    at = np.flatnonzero(doc[:n] == doc[k - 1 :])
    return at, out[at]

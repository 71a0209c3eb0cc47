"""Document statistics of many texts at once."""

from __future__ import annotations

import numpy as np

from cartwheel.llm.vectors import Words, windows

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
PUNCT = np.zeros(256, bool)
PUNCT[[ord(c) for c in "!?.,;:"]] = True
WINDOW = 8
#: The columns of ``features``; the sign says how the quality score may move as one grows.
FEATURES = {"log_words": 0, "word_length": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1,
            "upper_share": 0, "digit_share": 0, "punct_share": 0, "distinct_share": 0, "line_words": 0, "bang_share": -1}
BANG = np.zeros(256, bool)
BANG[ord("!")] = True


def per_text(flags: np.ndarray, w: Words) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags)))
    return total[w.text_end] - total[w.text_start]


def distinct_per_text(doc: np.ndarray, hashes: np.ndarray, texts: int) -> np.ndarray:
    order = np.lexsort((hashes, doc))
    d, x = doc[order], hashes[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (x[1:] != x[:-1])
    return np.bincount(d[new], minlength=texts)


def base_counts(w: Words) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words per text.
    ``w`` must not be lower-cased."""
    texts = len(w.n)
    points = np.concatenate(([0], np.cumsum((w.data & 0xC0) != 0x80)))
    chars = np.bincount(w.doc, points[w.end] - points[w.start], texts).astype(np.int64)
    breaks = np.flatnonzero(w.data == 10)  # the end of each text is one, too
    line_start, line_end = np.concatenate(([0], breaks[:-1] + 1)), breaks
    has_word = np.searchsorted(w.start, line_end) > np.searchsorted(w.start, line_start)
    line_start, line_end = line_start[has_word], line_end[has_word]
    line_doc = np.searchsorted(w.text_end, line_start)
    lines = np.bincount(line_doc, minlength=texts)
    distinct = distinct_per_text(line_doc, w.of_range(line_start, line_end), texts)
    at, h = windows(w.hash, w.doc, WINDOW)
    order = np.lexsort((h, w.doc[at]))
    d, x = w.doc[at][order], h[order]
    same = np.zeros(len(d) + 1, bool)  # as the one before
    same[1:-1] = (d[1:] == d[:-1]) & (x[1:] == x[:-1])
    again = at[order][same[:-1] | same[1:]]
    cover = np.zeros(len(w.doc) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + WINDOW, -1)
    covered = np.cumsum(cover)[:-1] > 0
    return {"n_words": w.n, "word_chars": chars, "n_symbols": per_text(SYMBOLS[w.data], w),
            "n_dup_lines": lines - distinct, "n_repeat_words": np.bincount(w.doc[covered], minlength=texts), "n_lines": lines}


def features(w: Words, base: dict[str, np.ndarray]) -> np.ndarray:
    """One row of FEATURES per text; zeros for a text without words."""
    n = np.maximum(base["n_words"], 1)
    size = np.maximum(w.text_end - w.text_start, 1)
    lines = np.maximum(base["n_lines"], 1)
    return np.stack([
        np.log1p(base["n_words"]), base["word_chars"] / n, base["n_symbols"] / size, base["n_dup_lines"] / lines,
        base["n_repeat_words"] / n, per_text(UPPER[w.data], w) / size, per_text(DIGIT[w.data], w) / size,
        per_text(PUNCT[w.data], w) / size, distinct_per_text(w.doc, w.hash, len(w.n)) / n, np.log1p(base["n_words"] / lines),
        per_text(BANG[w.data], w) / size], 1)

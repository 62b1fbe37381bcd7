"""Licence notices in documents: an inverted index of template words, lossless counts, banded alignment.

Words are lower-cased runs of letters and digits. A notice is a place where at
least ``COVERAGE`` of a template's words stand in order, with places that differ
from those in the template by amounts within a band (a fifth of the template,
at least 2, to both sides of any middle). So all its words lie within the
template's length and twice the band. An inverted index (word -> templates)
gives the places of template words; where that many of them are so near each
other, counted as often as the template has them, the template is aligned on
every diagonal that such words allow. Nothing that aligns is missed; winnowed
grams would miss notices with words changed or put in.

The alignment of most matched words, then of the shortest span, then the
earliest, is reported with its span, and the words before and after it are
looked at again, so spans of one template do not overlap.

The index is the only shared state; its size is that of the templates, which
are a parameter. Texts are independent of each other, so there is no shuffle.

Edge cases: null and empty texts match nothing; several spans of a template in
one text give one row each; repeated rows give repeated rows; a row without doc_id keeps its null; other
columns are ignored; an empty table or no template gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callpulse.llm import kernels as K
from callpulse.llm.license_templates import TEMPLATES

COVERAGE = 0.8

_BREAK = np.ones(256, bool)
_BREAK[48:58] = _BREAK[65:91] = _BREAK[97:123] = False
_BREAK[128:] = False


class Index:
    """Words of all templates in order (vocabulary) and, of each template, how often it has each of them."""

    def __init__(self, templates: dict[str, str]):
        self.names, self.tokens = [], []
        for name, text in templates.items():
            data = np.frombuffer(text.encode(), np.uint8)
            start, end, _ = K.words(data, np.array([0, len(data)]), _BREAK)
            w = K.word_hashes(data, start, end, fold=True)
            if len(w):
                self.names.append(name)
                self.tokens.append(w)
        self.vocabulary = np.unique(np.concatenate(self.tokens)) if self.tokens else np.empty(0, np.uint64)
        self.counts = [np.bincount(np.searchsorted(self.vocabulary, w), minlength=len(self.vocabulary)) for w in self.tokens]


def _band(m: int) -> int:
    return max(2, m // 5)


def starts(at: np.ndarray, word: np.ndarray, counts: np.ndarray, need: int, width: int) -> np.ndarray:
    """Places of template words from which ``width`` places hold ``need`` of the template's words.

    ``at`` are the places of its words in order, ``word`` their numbers; a word counts as often as the template has it.
    """
    if len(at) < need:
        return at[:0]
    s = at[: len(at) - need + 1]
    s = s[at[need - 1 :] - s < width]
    if not len(s):
        return s
    total = np.zeros(len(s), np.int64)
    for v in np.flatnonzero(counts).tolist():
        own = at[word == v]
        total += np.minimum(np.searchsorted(own, s + width) - np.searchsorted(own, s), counts[v])
    return s[total >= need]


def align(template: np.ndarray, words: np.ndarray, diagonal: int, band: int) -> tuple[int, int, int]:
    """Longest common subsequence in a band: matched words, first and last matched place in words.

    Cell (i, d) pairs template word i with word i + diagonal + d, d from -band to band.
    """
    width = 2 * band + 1
    score = [0] * (width + 1)  # of the row before, by d; a word skipped in the template moves to d + 1
    first = [-1] * (width + 1)
    last = [-1] * (width + 1)
    n = len(words)
    for i, t in enumerate(template.tolist()):
        s2, f2, l2 = [0] * (width + 1), [-1] * (width + 1), [-1] * (width + 1)
        for d in range(width):
            j = i + diagonal + d - band
            best, f, e = score[d + 1] if d + 1 < width else 0, first[d + 1], last[d + 1]
            if d and s2[d - 1] > best:
                best, f, e = s2[d - 1], f2[d - 1], l2[d - 1]
            if 0 <= j < n and int(words[j]) == t and score[d] + 1 > best:
                best, f, e = score[d] + 1, first[d] if first[d] >= 0 else j, j
            s2[d], f2[d], l2[d] = best, f, e
        score, first, last = s2, f2, l2
    k = max(range(width), key=lambda d: (score[d], -last[d]))
    return score[k], first[k], last[k]


def notices(token: np.ndarray, counts: np.ndarray, need: int, w: np.ndarray, at: np.ndarray, word: np.ndarray):
    """(matched, first, last) of every notice of one template among the words w of one text."""
    m = len(token)
    band = _band(m)
    width = m + 2 * band
    first = starts(at, word, counts, need, width)
    if not len(first):
        return
    cut = np.flatnonzero(np.diff(first) >= width) + 1
    todo = [(int(g[0]), min(int(g[-1]) + width, len(w))) for g in np.split(first, cut)]
    known: dict[int, tuple[int, int, int]] = {}  # alignments that no border of a stretch has cut, by diagonal
    while todo:
        lo, hi = todo.pop()
        a, b = np.searchsorted(at, [lo, hi])
        some = starts(at[a:b], word[a:b], counts, need, width)
        whole = next((f for f in some.tolist() if f + m <= hi and np.array_equal(w[f : f + m], token)), None)
        if whole is not None:
            best = (m, whole, whole + m - 1)
        else:
            best = None
            for d in np.unique(some[:, None] + np.arange(need - m - band, band + 1)).tolist() if len(some) else ():
                inside = d - band >= lo and d + m + band <= hi
                got = known.get(d) if inside else None
                if got is None:
                    n, f, e = align(token, w[lo:hi], d - lo, band)
                    got = (n, f + lo, e + lo)
                    if inside:
                        known[d] = got
                if got[0] >= need and (best is None or (-got[0], got[2] - got[1], got[1]) < (-best[0], best[2] - best[1], best[1])):
                    best = got
        if best is not None:
            yield best
            todo += [(lo, best[1]), (best[2] + 1, hi)]


def _scan(index: Index, coverage: float):
    needs = [max(1, math.ceil(coverage * len(t))) for t in index.tokens]

    def run(batches):
        for batch in batches:
            data_all, off_all = K.utf8(batch.column("text"))
            for a, b in K.pieces(off_all):
                data, off = data_all[off_all[a] : off_all[b]], off_all[a : b + 1] - off_all[a]
                start, end, row = K.words(data, off, _BREAK)
                w = K.word_hashes(data, start, end, fold=True)
                out: list[tuple] = []
                if len(w) and len(index.names):
                    word = np.minimum(np.searchsorted(index.vocabulary, w), len(index.vocabulary) - 1)
                    at = np.flatnonzero(index.vocabulary[word] == w)
                    word = word[at]
                for t, need in enumerate(needs if len(w) else ()):
                    token, counts = index.tokens[t], index.counts[t]
                    mine = counts[word] > 0
                    p, v = at[mine], word[mine]
                    # texts with enough template words near each other
                    k = max(0, len(p) - need + 1)
                    near = (p[need - 1 :] - p[:k] < len(token) + 2 * _band(len(token))) & (row[p[need - 1 :]] == row[p[:k]])
                    for r in np.unique(row[p[:k][near]]).tolist():
                        lo, hi = np.searchsorted(row, [r, r + 1])
                        x, y = np.searchsorted(p, [lo, hi])
                        for matched, f, e in notices(token, counts, need, w[lo:hi], p[x:y] - lo, v[x:y]):
                            s, z = int(start[lo + f] - off[r]), int(end[lo + e] - off[r])
                            out.append((a + r, index.names[t], matched / len(token), int(f), int(e) + 1, s, z))
                rows = pa.array([x[0] for x in out], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(rows),
                        pa.array([x[1] for x in out], pa.string()),
                        pa.array([x[2] for x in out], pa.float64()),
                        *[pa.array([x[k] for x in out], pa.int64()) for k in (3, 4, 5, 6)],
                    ],
                    ["doc_id", "license", "coverage", "start_word", "end_word", "start_byte", "end_byte"],
                )

    return run


def license_matches(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """One row per matched span: doc_id, license, coverage, start_word, end_word, start_byte, end_byte (ends exclusive)."""
    index = Index(TEMPLATES if templates is None else templates)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(
        _scan(index, coverage),
        "doc_id long, license string, coverage double, start_word long, end_word long, start_byte long, end_byte long",
    )

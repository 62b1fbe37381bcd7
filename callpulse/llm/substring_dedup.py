"""Removal of word passages that an earlier document already has (difference-cover anchors).

A window is ``window`` consecutive words of one document. With a difference
cover D modulo v, for any two starts i, j there is a shift s < v for which both
(i + s) and (j + s) fall on D modulo v. So two equal windows of ``window``
words share an equal *anchor*, a run of ``window - v + 1`` words that starts at
a cover position in both documents, and only |D| of v positions are hashed.

Steps:

1. hash the anchors of every document, and its whole word sequence; documents
   of one sequence (128 bits) are one text from here on, of the smallest doc_id,
   and lose all their words but for that one;
2. anchors found in two texts or more go back to their texts, where they are
   extended: the windows that contain one are the candidates;
3. 96-bit hashes of the candidate windows (of two independent hashes of each word) give the smallest doc_id of each
   word sequence; windows that start in a larger doc_id are repeats;
4. every word covered by a repeat is removed.

Hot anchors (a passage in a third of all documents) are pre-aggregated by the
partial ``groupBy`` and their rows come back by a join that AQE can split (``splittable``).
A task holds one piece of text, and lists bounded by one document.

Edge cases: a null text has no words; a text of fewer than ``window`` words
loses nothing; exact repeats of a row (same doc_id and text) are not earlier
documents, each such row gets the same result; a row without doc_id keeps all
its words and is no source of removals; columns other than doc_id and text are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callpulse.llm import kernels as K
from callpulse.llm.workspace import Workspace, splittable

WINDOW = 50
#: the place that stands for all words of a document
WHOLE = -1


@lru_cache(maxsize=8)
def difference_cover(q: int) -> tuple[int, tuple[int, ...]]:
    """Smallest perfect difference set of q + 1 residues modulo q*q + q + 1, by search (q a prime power up to 5)."""
    v = q * q + q + 1
    for rest in combinations(range(3, v), q - 1):
        d = (0, 1, *rest)
        if len({(a - b) % v for a in d for b in d if a != b}) == v - 1:
            return v, d
    raise ValueError(f"no perfect difference set modulo {v}")


def cover_for(window: int) -> tuple[int, tuple[int, ...]]:
    """The widest period that leaves anchors of at least a third of the window."""
    for q in (5, 4, 3, 2):
        if window - (q * q + q + 1) + 1 >= max(2, window // 3):
            return difference_cover(q)
    return 1, (0,)


class _Texts:
    """Words, their hashes and their index within the row, for one piece of texts."""

    def __init__(self, data: np.ndarray, off: np.ndarray, base: int = K.BASE):
        self.data, self.off = data, off
        self.start, self.end, self.row = K.words(data, off)
        self.first = np.searchsorted(self.row, np.arange(len(off)))  # first word of each row, and their number
        self.index = np.arange(len(self.start)) - self.first[self.row]
        self.hash = K.word_hashes(data, self.start, self.end, base=base)

    def second(self) -> np.ndarray:
        """Word hashes that are independent of ``hash``."""
        return K.word_hashes(self.data, self.start, self.end, base=K.BASE2)

    def anchors(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Word places of the anchors, and their hashes; rows shorter than a window have none."""
        v, cover = cover_for(window)
        size = window - v + 1
        h = K.run_hash(self.hash, size)
        n = len(h)
        on = np.zeros(v, bool)
        on[list(cover)] = True
        ok = on[self.index[:n] % v] & (self.row[:n] == self.row[size - 1 : size - 1 + n])
        ok &= np.diff(self.first)[self.row[:n]] >= window
        at = np.flatnonzero(ok)
        return at, h[at]


def _pieces(batch: pa.RecordBatch):
    data, off = K.utf8(batch.column("text"))
    for a, b in K.pieces(off):
        yield a, b, data[off[a] : off[b]], off[a : b + 1] - off[a]


def _anchor_rows(window: int):
    """Per document of at least ``window`` words: a 128-bit hash of its word sequence and its distinct anchors."""

    def run(batches):
        for batch in batches:
            docs = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for a, b, data, off in _pieces(batch):
                t = _Texts(data, off)
                at, h = t.anchors(window)
                row = t.row[at]
                order = np.lexsort((h, row))
                h, row = h[order], row[order]
                keep = np.ones(len(h), bool)
                keep[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                h, row = h[keep], row[keep]
                long = np.diff(t.first) >= window  # the others have no anchors
                pair = np.stack([t.hash, t.second()], axis=1)
                c1, c2 = K.digests(pair, t.first[:-1][long], t.first[1:][long])
                ends = np.searchsorted(row, np.flatnonzero(long), "right").astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs[a:b][long].astype(np.int64)),
                        pa.array(c1.view(np.int64)),
                        pa.array(c2.view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(np.append(np.int32(0), ends)), pa.array(h.view(np.int64))),
                    ],
                    ["doc", "c1", "c2", "hs"],
                )

    return run


def _lists(col: pa.Array, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Values and row numbers of a list column's rows a to b."""
    part = col.slice(a, b - a)
    return (
        part.flatten().to_numpy(zero_copy_only=False),
        np.repeat(np.arange(b - a), np.asarray(pa.compute.fill_null(pa.compute.list_value_length(part), 0))),
    )


def _window_rows(window: int):
    v, _ = cover_for(window)

    def run(batches):
        for batch in batches:
            docs = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for a, b, data, off in _pieces(batch):
                t = _Texts(data, off)
                at, h = t.anchors(window)
                hit, hit_row = _lists(batch.column("hs"), a, b)
                # an anchor is shared if (row, hash) is in the row's list
                known = K.mix(hit.astype(np.int64).view(np.uint64) + K.mix(hit_row.astype(np.uint64)))
                own = K.mix(h + K.mix(t.row[at].astype(np.uint64)))
                p = at[np.isin(own, known)]
                # extend: windows start up to v - 1 words before the anchor, within the row
                n = len(t.start)
                low = np.maximum(p - (v - 1), t.first[t.row[p]])
                d = np.bincount(low, minlength=n + 1) - np.bincount(p + 1, minlength=n + 1)
                whole = np.zeros(n, bool)
                if n >= window:
                    whole[: n - window + 1] = t.row[: n - window + 1] == t.row[window - 1 :]
                s = np.flatnonzero((np.cumsum(d[:n]) > 0) & whole)
                h1 = K.run_hash(t.hash, window)[s] if len(s) else np.empty(0, np.uint64)
                h2 = K.run_hash(t.second(), window, K.BASE)[s] if len(s) else h1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h1.view(np.int64)),
                        pa.array((h2 >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                        pa.array(docs[a:b][t.row[s]].astype(np.int64)),
                        pa.array(t.index[s].astype(np.int32)),
                    ],
                    ["h1", "h2", "doc", "pos"],
                )

    return run


def _results(window: int, texts: bool):
    def run(batches):
        for batch in batches:
            for a, b, data, off in _pieces(batch):
                t = _Texts(data, off)
                pos, row = _lists(batch.column("pos"), a, b)
                gone = K.covered(np.unique((pos.astype(np.int64) + t.first[row])[pos != WHOLE]), window, len(t.start))
                gone |= np.isin(t.row, row[pos == WHOLE])
                raw = data.tobytes()
                n_removed, kept = [], []
                for r in range(b - a):
                    lo, hi = t.first[r], t.first[r + 1]
                    g = gone[lo:hi]
                    n_removed.append(int(g.sum()))
                    ks, ke = t.start[lo:hi][~g], t.end[lo:hi][~g]
                    kept.append(b" ".join([raw[x:y] for x, y in zip(ks.tolist(), ke.tolist())]))
                cols = [
                    batch.column("doc_id").slice(a, b - a),
                    pa.array(np.diff(t.first)),
                    pa.array(n_removed, pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
                ]
                names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
                if texts:
                    cols.append(pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string()))
                    names.append("kept_text")
                yield pa.RecordBatch.from_arrays(cols, names)

    return run


def remove_repeated_passages(docs: DataFrame, window: int = WINDOW, texts: bool = True, work: Workspace | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 and, with ``texts``, kept_text."""
    work = work or Workspace(docs.sparkSession, "substring-dedup")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    named = docs.where("doc_id is not null")
    texts_of = work.table(named.mapInArrow(_anchor_rows(window), "doc long, c1 long, c2 long, hs array<long>"), "anchors")
    reps = work.table(texts_of.groupBy("c1", "c2").agg(F.min("doc").alias("rep")), "reps")
    anchors = texts_of.select(F.explode("hs").alias("h"), "c1")
    shared = anchors.groupBy("h").agg(F.min("c1").alias("lo"), F.max("c1").alias("hi")).where("lo < hi").select("h")
    lists = anchors.join(splittable(shared, "h"), "h").groupBy("c1").agg(F.collect_set("h").alias("hs"))
    lists = work.table(reps.join(splittable(lists, "c1"), "c1").select(F.col("rep").alias("doc"), "hs"), "shared")
    windows = work.table(
        named.join(lists, named.doc_id == lists.doc).select("doc_id", "text", "hs").mapInArrow(
            _window_rows(window), "h1 long, h2 int, doc long, pos int"
        ),
        "windows",
    )
    first = windows.groupBy("h1", "h2").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi").select("h1", "h2", "lo")
    later = windows.join(splittable(first, "h1", "h2"), ["h1", "h2"]).where("doc > lo").select("doc", "pos")
    copies = texts_of.join(reps, ["c1", "c2"]).where("doc > rep").select("doc", F.lit(WHOLE).alias("pos"))
    repeats = work.table(later.unionByName(copies).groupBy("doc").agg(F.collect_set("pos").alias("pos")), "repeats")
    for name in ("anchors", "reps", "shared", "windows"):
        work.delete(name)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if texts else "")
    return docs.join(repeats, docs.doc_id == repeats.doc, "left").select("doc_id", "text", "pos").mapInArrow(
        _results(window, texts), schema
    )

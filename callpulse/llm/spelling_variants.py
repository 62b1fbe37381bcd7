"""Spelling variants: vocabulary acceptor, one-edit transducer and acceptor again, composed.

Words are counted over all texts. Two words are near if one inserted, deleted or
replaced code point turns one into the other. Near pairs are the pairs that
A * E * A accepts, with A the minimised acceptor of the vocabulary and E the
transducer that makes exactly one edit. The composition is enumerated in
partitions of its initial states:

* A pair belongs to the place i where its words first differ. Places are taken
  in ranges [a, b) of the shorter word, of length m. Words of a pair whose i is in the
  range share their first a and their last m - b code points, so the machine
  may as well be started after that shared part: every (m, a, b, shared part) is one
  initial state, and its words are independent of all others.
* The first ranges are the two halves of the word. An initial state with more than
  ``LIMIT`` words, or ``WIDE`` places, is replaced by those of the two halves of its range, and so
  on: a range of one place has few words, whatever the size of the vocabulary.
  Each pair is accepted in one partition exactly, at every size.

Inside a partition the words' middle parts form an acceptor, minimised by
merging equal states as they are made. The composed machine stays on the
diagonal (the same state twice) until the edit: two different arcs (replaced) or one arc
against none (inserted); after it both sides read the same letters, so what is accepted is the
intersection of two right languages, kept for each pair of states.

Forms are followed to their roots by pointer doubling: the counts at least double
with each step, so there are few rounds.

Edge cases: null and empty texts have no words; a row without doc_id takes part
with an empty id; repeated rows count as often as they occur; ties of the largest n
go to the smallest word in code-point order; other columns are not read; an empty table
gives an empty result. A task counts words in a table that is handed on at ``FLUSH`` entries.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callpulse.llm.workspace import Workspace, splittable

DELETE_ONE_IN = 97
SHORTEST = 5
LEAST = 3
FLUSH = 200_000
LIMIT = 4_096
#: places of a range at most; words of more than twice as many letters start with narrower ranges than halves
WIDE = 64
#: states and pairs of states that a task keeps across partitions
STATES = 150_000

_RUN = re.compile("[a-zÀ-ÿ]+")


# -- counting ---------------------------------------------------------------


def _count(shortest: int):
    def table(counts: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    def run(batches):
        counts: dict[str, int] = {}
        for batch in batches:
            texts = pc.ascii_lower(batch.column("text"))
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
                text = text.as_py()
                if not text:
                    continue
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for w, n in Counter(_RUN.findall(text)).items():
                    h = zlib.crc32(w.encode(), start)
                    if h % DELETE_ONE_IN == 0:
                        h %= len(w)
                        w = w[:h] + w[h + 1 :]
                    if len(w) >= shortest:
                        counts[w] = counts.get(w, 0) + n
                if len(counts) >= FLUSH:
                    yield table(counts)
                    counts = {}
        yield table(counts)

    return run


def word_counts(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """word, n: the words of at least ``shortest`` code points that occur at least ``least`` times."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(_count(shortest), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# -- initial states -----------------------------------------------------------

KEY = ("m", "a", "b", "shared")


def _region(words: DataFrame) -> DataFrame:
    """Rows with m, a, b get the shared part."""
    return words.withColumn("shared", F.expr("concat(substring(word, 1, a), right(word, m - b))"))


def _first_regions(words: DataFrame, shortest: int) -> DataFrame:
    size, half = F.length("word"), F.floor(F.col("m") / 2).cast("int")
    ranges = F.array(F.struct(F.lit(0).alias("a"), half.alias("b")), F.struct(half.alias("a"), (F.col("m") + 1).alias("b")))
    return _region(
        words.select("word", "n", F.explode(F.array(size, size - 1)).alias("m"))
        .where(F.col("m") >= shortest)
        .select("word", "n", "m", F.explode(ranges).alias("r"))
        .select("word", "n", "m", "r.a", "r.b")
    )


def initial_states(words: DataFrame, work: Workspace, shortest: int = SHORTEST, limit: int = LIMIT) -> DataFrame:
    """word, n and the initial states it takes part in; none of more than one place has over ``limit`` words or ``WIDE`` places.

    Wide ranges with one word are given up: that word is near none there.
    """
    states, ready, level = _first_regions(words, shortest), None, 0
    width = F.col("b") - F.col("a")
    while True:
        large = states.where(width > 1).groupBy(*KEY).count()
        large = large.where((F.col("count") > limit) | ((width > WIDE) & (F.col("count") > 1))).drop("count")
        large = work.table(large, f"large-{level}")
        small = states.where(width <= WIDE)
        if large.isEmpty():
            return small if ready is None else ready.unionByName(small)
        hot = splittable(large, "m", "a", "b")
        small = small.join(hot, list(KEY), "left_anti")
        ready = small if ready is None else ready.unionByName(small)
        middle = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
        halves = F.array(F.struct("a", middle.alias("b")), F.struct(middle.alias("a"), "b"))
        rest = states.join(hot, list(KEY), "left_semi").select("word", "n", "m", F.explode(halves).alias("r"))
        states = work.table(_region(rest.select("word", "n", "m", "r.a", "r.b")), f"states-{level}")
        level += 1


# -- acceptor and composition -----------------------------------------------------


class Acceptor:
    """Minimised acceptor of several sets of words: equal states are one state. State 0 accepts nothing but the empty word."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[tuple, int] = {(True, ()): 0}
        self.final, self.arcs = [True], [{}]
        self._right: dict[int, list[str]] = {0: [""]}
        self._both: dict[tuple[int, int], list[str]] = {}

    def __len__(self) -> int:
        return len(self.arcs) + len(self._both)

    def add(self, words: list[str], lo: int, hi: int, depth: int = 0) -> int:
        """The state whose right language is words[lo:hi], which ascend, without their first ``depth`` letters."""
        final = len(words[lo]) == depth
        i, arcs = lo + final, []
        while i < hi:
            c, j = words[i][depth], i + 1
            while j < hi and words[j][depth] == c:
                j += 1
            arcs.append((c, self.add(words, i, j, depth + 1)))
            i = j
        key = (final, tuple(arcs))
        state = self.numbers.get(key)
        if state is None:
            state = self.numbers[key] = len(self.arcs)
            self.final.append(final)
            self.arcs.append(dict(arcs))
        return state

    def right(self, q: int) -> list[str]:
        """Right language of a state."""
        out = self._right.get(q)
        if out is None:
            out = [""] if self.final[q] else []
            for c, r in self.arcs[q].items():
                out += [c + w for w in self.right(r)]
            self._right[q] = out
        return out

    def both(self, q: int, r: int) -> list[str]:
        """Intersection of the right languages of two states."""
        if q == r:
            return self.right(q)
        key = (q, r) if q < r else (r, q)
        out = self._both.get(key)
        if out is None:
            out = [""] if self.final[q] and self.final[r] else []
            x, y = self.arcs[q], self.arcs[r]
            if len(y) < len(x):
                x, y = y, x
            for c, s in x.items():
                t = y.get(c)
                if t is not None:
                    out += [c + w for w in self.both(s, t)]
            self._both[key] = out
        return out

    def pairs(self, start: int, places: int):
        """Accepted pairs from an initial state, the shorter word first, those of equal length ascending.

        The words first differ at one of the first ``places`` places. Given as (before, end of one, end of the other, the letters after both).
        """
        stack = [(start, "")]
        while stack:
            q, before = stack.pop()
            arcs = list(self.arcs[q].items())
            for k, (c, r) in enumerate(arcs):
                for d, s in arcs[k + 1 :]:
                    after = self.both(r, s)
                    if after:
                        yield before, c, d, after
                # one side reads c, the other nothing; its own next letter is another one
                after = self.both(q, r)
                if after:
                    after = [w for w in after if not w.startswith(c)]
                    if after:
                        yield before, "", c, after
                if len(before) + 1 < places:
                    stack.append((r, before + c))


def _pairs_of(acceptor: Acceptor, m: int, a: int, b: int, words: list[str], n: list[int]):
    """word, n, n_near, and n and word of the best near word, for one initial state; words ascend."""
    after = max(m - b, 0)
    middle = [w[a : len(w) - after] for w in words]
    inside = m - after - a
    if inside not in map(len, middle):
        return []
    if len(acceptor) > STATES:
        acceptor.clear()
    place = {w: i for i, w in enumerate(middle)}
    near, best = [0] * len(words), [None] * len(words)
    for before, c, d, rest in acceptor.pairs(acceptor.add(sorted(middle), 0, len(middle)), b - a):
        left, right = before + c, before + d
        for w in rest:
            # pairs of two longer words belong to the states of their own length
            x = left + w
            if len(x) != inside:
                continue
            i, j = place[x], place[right + w]
            near[i] += 1
            near[j] += 1
            k = best[i]
            if k is None or n[j] > n[k] or (n[j] == n[k] and j < k):
                best[i] = j
            k = best[j]
            if k is None or n[i] > n[k] or (n[i] == n[k] and i < k):
                best[j] = i
    return [(words[i], n[i], near[i], n[k], words[k]) for i, k in enumerate(best) if k is not None]


NEAR = "word string, n long, n_near long, best_n long, best string"


def _compose(batches):
    acceptor, rows = Acceptor(), []
    key, words, counts = None, [], []

    def batch():
        cols = zip(*rows) if rows else [[]] * 5
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], [x.split()[0] for x in NEAR.split(", ")])

    for part in batches:
        for word, n, *at in zip(*(part.column(c).to_pylist() for c in ("word", "n", *KEY))):
            if at != key:
                if len(words) > 1:
                    rows.extend(_pairs_of(acceptor, *key[:3], words, counts))
                    if len(rows) > 10_000:
                        yield batch()
                        rows = []
                key, words, counts = at, [], []
            words.append(word)
            counts.append(n)
    if len(words) > 1:
        rows.extend(_pairs_of(acceptor, *key[:3], words, counts))
    yield batch()


def near_words(words: DataFrame, work: Workspace, shortest: int = SHORTEST, limit: int = LIMIT) -> DataFrame:
    """word, n, n_near (0 if none), form_n and form (the near word of largest n, null if none)."""
    states = initial_states(words, work, shortest, limit)
    found = states.repartition(*KEY).sortWithinPartitions(*KEY, "word").select("word", "n", *KEY).mapInArrow(_compose, NEAR)
    none = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("best_n"), F.lit(None).cast("string").alias("best"))
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("k"), F.col("best").alias("w"))))
    every = none.unionByName(found).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("b"))
    return every.select("word", "n", "n_near", (-F.col("b.k")).alias("form_n"), F.col("b.w").alias("form"))


def _roots(links: DataFrame, work: Workspace) -> DataFrame:
    """word, root for rows word, form without cycles, by pointer doubling."""
    now = work.table(links.select("word", F.col("form").alias("to"), F.lit(False).alias("done")), "roots-0")
    level = 0
    while not now.where("not done").isEmpty():
        # hot roots have many words that point to them: both sides of the join come straight from a shuffle, so AQE can split
        step = now.select(F.col("word").alias("at"), F.col("to").alias("next"), F.col("done").alias("last"))
        moved = now.where("not done").join(step, F.col("to") == F.col("at"), "left")
        moved = moved.select("word", F.coalesce("next", "to").alias("to"), F.coalesce("last", F.lit(True)).alias("done"))
        level += 1
        now = work.table(now.where("done").unionByName(moved), f"roots-{level}")
    return now.select("word", F.col("to").alias("root"))


def spelling_variants(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, limit: int = LIMIT) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    The form is the near word of largest n, if that is at least twice the word's; the root is where forms end.
    """
    work = Workspace(docs.sparkSession, "spelling")
    words = work.table(word_counts(docs, shortest, least), "words")
    near = near_words(words, work, shortest, limit)
    strong = F.col("form_n") >= 2 * F.col("n")
    rows = work.table(
        near.select("word", "n", "n_near", F.when(strong, F.col("form")).alias("form"), F.when(strong, F.col("form_n")).alias("form_n")), "forms"
    )
    roots = _roots(rows.where(F.col("form").isNotNull()), work).withColumnRenamed("word", "from")
    return rows.join(roots, F.col("word") == F.col("from"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )

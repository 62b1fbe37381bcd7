"""Closed syncmers, fingerprints, likeness and the neighbour table against plain versions."""

import random
from functools import cache

import numpy as np
import pytest

from callpulse.llm import fingerprints as FP
from callpulse.llm import kernels as K

from . import brute


@cache
def _hash(raw: bytes, base: int) -> int:
    return int(K.run_hash(K.BYTE[np.frombuffer(raw, np.uint8)], len(raw), base)[0])


@cache
def plain_fingerprint(text: str) -> list[int]:
    """Every 16-byte string whose smallest inner 8-byte string is its first or last one, by the definition."""
    raw = text.encode()
    first: dict[int, int] = {}
    for at in range(len(raw) - FP.KMER + 1):
        mer = raw[at : at + FP.KMER]
        inner = [_hash(mer[i : i + FP.SMER], K.BASE2) for i in range(FP.KMER - FP.SMER + 1)]
        if min(inner) in (inner[0], inner[-1]):
            first.setdefault(_hash(mer, K.BASE) >> 32, at)
    kept = sorted(first)[: FP.KEPT]
    return sorted(kept, key=first.get)


def plain_likeness(a: list[int], b: list[int]) -> float:
    if not a or not b:
        return float(not a and not b)
    union = sorted({*a, *b})[: FP.KEPT]
    match = [b.index(x) for x in a if x in b and x in union]
    best = [1] * len(match)
    for i, x in enumerate(match):
        best[i] = 1 + max((best[j] for j in range(i) if match[j] < x), default=0)
    return max(best, default=0) / len(union)


def _texts() -> dict[int, str]:
    rnd = random.Random(4)
    words = ["haus", "wind", "see", "the", "point", "número", "déjà", "of", "longer", "words"]
    line = lambda n: " ".join(rnd.choice(words) + rnd.choice("abcdefgh") for _ in range(n))
    parts = [line(12) for _ in range(6)]
    return {
        1: " ".join(parts), 2: " ".join(parts[::-1]), 3: " ".join(parts[:4]) + line(30), 4: line(150), 5: "ab" * 200, 6: "ab" * 150,
        7: "a short one, but a text", 8: line(40) + " ".join(parts[2:5]), 9: " ".join(parts),
    }


def test_fingerprints_and_likeness_equal_the_plain_ones():
    texts = list(_texts().values())
    got = FP.sketches(*FP._laid_out(texts))
    want = [plain_fingerprint(t) for t in texts]
    for g, w in zip(got, want):
        if w:
            assert g.tolist() == w
    for g, w in zip(got, want):
        for h, v in zip(got, want):
            if w and v:
                assert FP.likeness(g, h) == pytest.approx(plain_likeness(w, v))
    assert FP.likeness(got[0], got[8]) == 1.0 and FP.text_of(got[0]) == FP.text_of(got[8])
    assert FP.likeness(got[0], got[1]) < 0.5  # the same passages in reverse order


def test_neighbour_table_equals_the_plain_one(spark):
    texts = _texts()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    ids = sorted(texts, reverse=True)
    for buckets in (1, 3, 40):
        got = {r.doc_id: r for r in FP.neighbour_edits(docs, buckets).collect()}
        assert sorted(got) == sorted(texts)
        for k, i in enumerate(ids):
            t, nxt = texts[i], texts[ids[(k + 1) % len(ids)]]
            cut = len(t) // 3
            edited = t[: len(t) - cut] + nxt[:cut]
            own, changed, other = map(plain_fingerprint, (t, edited, nxt))
            assert got[i].n_chars == len(t) and got[i].edited_sha256 == brute.sha(edited)
            if own and changed and other:
                assert got[i].fingerprint == FP.text_of(np.array(own, np.uint32)) and got[i].edited_fingerprint == FP.text_of(np.array(changed, np.uint32))
                assert got[i].near_edited == pytest.approx(plain_likeness(own, changed)) and got[i].near_next == pytest.approx(plain_likeness(own, other))


def test_texts_longer_than_a_piece(spark):
    rnd = random.Random(5)
    long = " ".join(f"w{rnd.randrange(10**6)}" for _ in range(100_000))
    assert len(long) > K.PIECE
    texts = {1: long, 2: "x", 3: long, 4: long[: len(long) // 2]}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in FP.neighbour_edits(docs, 2).collect()}
    assert got[1].fingerprint == got[3].fingerprint and got[1].n_chars == len(long)
    assert got[4].edited_sha256 == brute.sha(texts[4][: len(texts[4]) - len(texts[4]) // 3] + long[: len(texts[4]) // 3])
    assert 0.2 < got[4].near_next < 0.8  # half of the next text

"""Texts longer than one piece of the kernels, against the plain versions."""

import random

import pytest

from callpulse.llm import kernels as K
from callpulse.llm.minhash import near_duplicates
from callpulse.llm.substring_dedup import remove_repeated_passages
from callpulse.llm.suffix_dedup import remove_repeated_bytes

from . import brute


@pytest.fixture(scope="module")
def long_rows():
    rnd = random.Random(8)
    words = [f"w{rnd.randrange(10**6)}é" for _ in range(75_000)]
    near = [w if rnd.random() > 0.01 else w + "x" for w in words]
    rows = [(1, "a short text of nine words, before the others"), (2, " ".join(words)), (3, " ".join(near)), (4, " ".join(words[40_000:40_300]))]
    assert len(rows[1][1].encode()) > K.PIECE
    return rows


@pytest.fixture(scope="module")
def long_docs(spark, long_rows):
    return spark.createDataFrame(long_rows, "doc_id long, text string").repartition(2)


def test_long_passages(long_docs, long_rows):
    want = brute.passages(long_rows)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in remove_repeated_passages(long_docs).collect()}
    assert got == want and want[4][1] == 300 and want[3][1] > 0


def test_long_repeated_bytes(long_docs, long_rows):
    want = {d: v[:4] for d, v in brute.repeated_bytes(long_rows).items()}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeated_bytes(long_docs).collect()}
    assert got == want and want[3][1] > 0


def test_long_near_duplicates(long_docs, long_rows):
    want = brute.near_groups(long_rows, 4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(long_docs, 4).collect()}
    assert got == want and want[3][1] == 2

"""Substring, suffix and near-duplicate operators against plain versions, edge cases included."""

import random

import numpy as np
import pytest

from callpulse.llm import suffix_sort
from callpulse.llm.minhash import near_duplicates
from callpulse.llm.substring_dedup import cover_for, difference_cover, remove_repeated_passages
from callpulse.llm.suffix_dedup import HOT, remove_repeated_bytes, strip_repeated_bytes

from . import brute


@pytest.mark.parametrize("q", [2, 3, 4, 5])
def test_difference_cover_meets_every_shift(q):
    v, d = difference_cover(q)
    assert all(any((i + s) % v in d and (j + s) % v in d for s in range(v)) for i in range(v) for j in range(v))


def test_cover_leaves_whole_anchors():
    for window in (2, 10, 50, 200):
        v, _ = cover_for(window)
        assert window - v + 1 >= 1


@pytest.mark.parametrize("window", [50, 12])
def test_passages(docs, rows, window):
    want = brute.passages(rows, window)
    got = remove_repeated_passages(docs, window).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.n_removed == 0
        else:
            assert (r.n_words, r.n_removed, r.kept_sha256) == want[r.doc_id], r.doc_id
            assert brute.sha(r.kept_text) == r.kept_sha256


@pytest.mark.parametrize("size, hot", [(100, HOT), (30, HOT), (100, 1), (100, 3), (30, 1)])
def test_repeated_bytes(docs, rows, size, hot):
    """Also with so few blocks allowed to a gram that they are cut narrower."""
    want = brute.repeated_bytes(rows, size)
    got = remove_repeated_bytes(docs, size, hot=hot).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.n_removed == 0
        else:
            assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id][:4], r.doc_id


def test_strip_keeps_columns(docs, rows):
    want = brute.repeated_bytes(rows)
    got = strip_repeated_bytes(docs)
    assert got.schema.simpleString() == docs.schema.simpleString()
    for r in got.collect():
        if r.doc_id is not None and r.text is not None:
            assert r.text == want[r.doc_id][4].decode("utf-8", "ignore")
            assert r.n_chars == len(r.text)


@pytest.mark.parametrize("shingle", [4, 5])
def test_near_duplicates(docs, rows, shingle):
    want = brute.near_groups(rows, shingle)
    got = near_duplicates(docs, shingle).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], r.doc_id
            assert r.kept == (r.doc_id == r.component_id)


def test_near_duplicate_chains_and_stragglers(spark):
    """A group whose members differ by up to a few words from a base: links that the hubs miss are found."""
    rnd = random.Random(3)
    base = [f"w{i}" for i in range(90)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(rnd.randint(0, 4)):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    want = brute.near_groups(rows, 4)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert len({c for _, c in want.values()}) > 1


def test_empty_tables(no_docs):
    assert remove_repeated_passages(no_docs).count() == 0
    assert remove_repeated_bytes(no_docs).count() == 0
    assert strip_repeated_bytes(no_docs).count() == 0
    assert near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("seed", range(12))
def test_suffix_classes(seed):
    rnd = np.random.default_rng(seed)
    n, limit = int(rnd.integers(150, 900)), int(rnd.choice([4, 8, 30, 100]))
    t = rnd.integers(97, 97 + int(rnd.integers(1, 4)), n + limit).astype(np.uint8)
    raw = t.tobytes()
    at = rnd.permutation(n)[: n // 2]
    order, cls = suffix_sort.classes(np.concatenate([t, np.zeros(16, np.uint8)]), at, limit)
    s = [raw[x : x + limit] for x in at[order]]
    assert s == sorted(s)
    assert [a == b for a, b in zip(s, s[1:])] == [bool(a == b) for a, b in zip(cls, cls[1:])]


def test_sql_twins(spark):
    import __spark_entry__ as E
    from callpulse.plans.compare import compare, duckdb_connect

    sf = "/root/testdata/sf0.001"
    con = duckdb_connect(sf)
    for name in ("op1_substring_dedup", "op4_minhash", "op6_suffix_dedup", "op8_decontaminate"):
        out = compare(name, E.queries()[name](spark, sf), con, E.oracle_sql()[name])
        assert out.ok, (name, out.detail)


def test_a_held_result_outlives_a_pipeline_run(spark):
    """The pipeline removes its own tables only, restores nothing it did not change, and leaves no folder behind."""
    import os

    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60).cache()
    held = remove_repeated_bytes(docs, texts=False)
    near = near_duplicates(docs)
    before = (sorted(held.collect()), sorted(near.collect()))
    root = spark.sparkContext.getCheckpointDir().split("://")[-1].removeprefix("file:")
    folders = set(os.listdir(root))
    corpus_pipeline.run(spark, sf).count()
    assert (sorted(held.collect()), sorted(near.collect())) == before
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == batch
    # what is left is the table that the lazy last stage reads
    assert {x.rsplit("-", 1)[0] for x in set(os.listdir(root)) - folders} == {"pipeline"}


def _thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_structured_words_do_not_collide(spark):
    """Words of 2,048 letters that every polynomial hash modulo 2**64 with an odd base takes for equal."""
    x, y = _thue_morse(2048), _thue_morse(2048).translate(str.maketrans("ab", "ba"))
    around = [f"w{i}" for i in range(30)]
    docs = [(1, " ".join([*around, x, *around])), (2, " ".join([*around, y, *around])), (3, " ".join([*around, x.upper(), *around]))]
    # whole texts whose words are such sequences
    docs += [(4, " ".join(x)), (5, " ".join(y)), (6, " ".join(x))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in remove_repeated_passages(df, texts=False).collect()}
    assert got == brute.passages(docs)
    assert got[2][1] == 0 and got[3][1] == 0
    small = [(1, " ".join([*around[:5], x, *around[:4]])), (2, " ".join([*around[:5], y, *around[:4]])), (3, " ".join([*around[:5], x.upper(), *around[:4]]))]
    near = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(spark.createDataFrame(small, df.schema), shingle=4).collect()}
    assert near == brute.near_groups(small, 4)
    assert near[2][1] == 2 and near[3][1] == 1

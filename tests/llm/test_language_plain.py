"""Language profiles, prototypes and cosines against a plain version."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from callpulse.llm import language_id as L


def plain_profile(text: str | None) -> np.ndarray:
    """The sum over trigrams of letters and boundaries of the bound, permuted letter vectors."""
    low = f" {(text or '').lower()} "
    marked = re.sub(r"\x00+", "\x00", "".join(c if c.isalpha() else "\x00" for c in low))
    out = np.zeros(L.DIMENSIONS)
    for gram, n in Counter(zip(marked, marked[1:], marked[2:])).items():
        a, b, c = (L._vector(ord(x)).astype(float) for x in gram)
        out += n * np.roll(a, 2) * np.roll(b, 1) * c
    return out


def plain_languages(rows: list[tuple]) -> dict[int | None, tuple[str, float]]:
    unit = lambda v: v / np.linalg.norm(v) if v.any() else v
    sums: dict[str, np.ndarray] = {}
    for i, t, lang in rows:
        if lang is not None and zlib.crc32(("" if i is None else str(i)).encode()) % 4 != 2 and any(c.isalpha() for c in t or ""):
            sums[lang] = sums.get(lang, 0) + unit(plain_profile(t))
    names = sorted(sums)
    each = np.stack([unit(sums[k]) for k in names])
    each = np.stack([unit(v) for v in each - each.mean(0)])
    out = {}
    for i, t, _ in rows:
        cos = each @ unit(plain_profile(t))
        k = int(cos.argmax())
        out[i] = (names[k], min(max(cos[k], 0.0), 1.0)) if any(c.isalpha() for c in t or "") else ("und", 0.0)
    return out


def test_profiles_equal_the_plain_ones():
    texts = ["One two, three!", "", None, "été 12 über", "a", "...", "x" * 500, "Ünï  cödé\nand  Ends"]
    got, has = L.profiles(texts)
    for t, g, h in zip(texts, got, has):
        assert h == any(c.isalpha() for c in t or "")
        if h:
            assert np.allclose(g, plain_profile(t)), t


def test_languages_equal_the_plain_ones(spark):
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").collect()]
    rows = [r for r in rows if r[0] is not None] + [(10**7, None, "en"), (10**7 + 1, "123", None)]
    want = plain_languages(rows)
    got = L.identify_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert len(got) == len(rows)
    for r in got:
        lang, score = want[r.doc_id]
        assert r.lang_pred == lang and r.score == pytest.approx(score, abs=1e-4), r.doc_id

"""Exact bounded medians against brute force on repeated rows."""

from __future__ import annotations

import random
import statistics

import pytest

from callpulse.operators.median import exact_medians


@pytest.mark.parametrize("seed,buckets", [(1, 4), (2, 16), (3, 1024), (4, 2)])
def test_exact_weighted_median(spark, seed, buckets):
    rnd = random.Random(seed)
    rows = []
    for _ in range(300):
        a = rnd.choice([None, rnd.random(), float(rnd.randint(0, 3))])  # continuous, ties, nulls
        b = rnd.choice([0.0, 0.0, 0.0, rnd.gauss(0, 1)])  # one heavy value
        rows.append((a, b, rnd.randint(1, 5)))
    df = spark.createDataFrame(rows, "a double, b double, w int")
    got = exact_medians(df, ["a", "b"], "w", buckets=buckets)
    for i, c in enumerate(["a", "b"]):
        rep = [r[i] for r in rows for _ in range(r[2]) if r[i] is not None]
        assert got[c] == pytest.approx(statistics.median(rep), rel=0, abs=1e-12)
    got1 = exact_medians(df, ["a"], None, buckets=buckets)
    assert got1["a"] == pytest.approx(statistics.median([r[0] for r in rows if r[0] is not None]), abs=1e-12)


def test_all_null_column(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    assert exact_medians(df, ["a", "b"]) == {"a": None, "b": 1.5}


def test_nan_does_not_count(spark):
    nan = float("nan")
    df = spark.createDataFrame([(x,) for x in (nan, 1.0, nan, 2.0, 9.0, nan, nan, None)], "a double")
    assert exact_medians(df, ["a"]) == {"a": 2.0}
    assert exact_medians(df.where("isnan(a)"), ["a"]) == {"a": None}

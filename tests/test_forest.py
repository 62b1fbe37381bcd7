"""Leaf-limited forest and exact AUC against plain versions."""

from __future__ import annotations

import math
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from callpulse.operators import forest
from callpulse.operators.forest import ForestModel, ForestParams, feature_order, fit_forest
from callpulse.operators.ranking import exact_auc

FEATURES = ["a", "b", "c", "d", "e"]


def _rows(n=260, seed=3):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        x = [float(rnd.randint(0, 9)), rnd.choice([0.0, 0.5, 7.25]), float(rnd.randint(-3, 20)), 1.0, rnd.random() * rnd.randint(1, 2)]
        good = x[0] + 2 * x[1] + rnd.gauss(0, 3) > 8
        out.append((*x, bool(good), rnd.choice([1, 1, 2, 5])))
    return out


def _frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, ", ".join(f"{f} double" for f in FEATURES) + ", good boolean, times long").repartition(parts)


def _plain_tree(rows, t, p, w):
    """Best-first growth on the rows themselves; nodes as (depth, n0, n1, feature, threshold, left, right)."""
    sums = lambda rs: (sum(r[6] for r in rs if not r[5]), sum(r[6] for r in rs if r[5]))
    pure = lambda a, b: ((a * w[0]) ** 2 + (b * w[1]) ** 2) / (a * w[0] + b * w[1])

    def best(rs, node, depth):
        n0, n1 = sums(rs)
        if depth >= p.max_depth or n0 + n1 < p.min_samples_split or n0 + n1 < 2 * p.min_samples_leaf or not n0 or not n1:
            return None
        order = feature_order(p.seed, t, node, len(FEATURES)).tolist()
        draws = p.draws(len(FEATURES))
        for some in [order[:draws], *[[f] for f in order[draws:]]]:
            found = []
            for f in some:
                for v in sorted({r[f] for r in rs}):
                    left, right = [r for r in rs if r[f] <= v], [r for r in rs if r[f] > v]
                    if not right or min(sum(sums(left)), sum(sums(right))) < p.min_samples_leaf:
                        continue
                    gain = pure(*sums(left)) + pure(*sums(right)) - pure(n0, n1)
                    if gain > 1e-9:
                        found.append((round(gain, 9), -f, -v))
            if found:
                gain, f, v = max(found)
                return gain, -f, -v
        return None

    nodes, members, depth = [None], [rows], [0]
    nodes[0] = [0, *sums(rows), None, None, None, None]
    frontier = {0: best(rows, 0, 0)}
    leaves = 1
    while leaves < p.max_leaf_nodes:
        open_ = [(-s[0], k) for k, s in frontier.items() if s]
        if not open_:
            break
        k = min(open_)[1]
        _, f, v = frontier.pop(k)
        sides = [[r for r in members[k] if r[f] <= v], [r for r in members[k] if r[f] > v]]
        nodes[k][3:] = [FEATURES[f], v, len(nodes), len(nodes) + 1]
        for s in sides:
            nodes.append([depth[k] + 1, *sums(s), None, None, None, None])
            members.append(s)
            depth.append(depth[k] + 1)
            frontier[len(nodes) - 1] = best(s, len(nodes) - 1, depth[-1])
        leaves += 1
    return nodes


PARAMS = [
    ForestParams(num_trees=7, max_leaf_nodes=6, min_samples_leaf=20, min_samples_split=50, max_bins=255, features_per_split=2),
    ForestParams(num_trees=3, max_leaf_nodes=40, min_samples_leaf=5, min_samples_split=60, max_depth=4, max_bins=255, features_per_split=1, seed=1),
    ForestParams(num_trees=2, max_leaf_nodes=1, min_samples_leaf=1, min_samples_split=2),
]


@pytest.mark.parametrize("params", PARAMS)
def test_forest_equals_plain_growth(spark, params):
    rows = _rows(200)
    model = fit_forest(_frame(spark, rows), FEATURES, "good", params, weight="times")
    n0, n1 = (sum(r[6] for r in rows if r[5] is c) for c in (False, True))
    w = tuple((n0 + n1) / (2 * n) for n in (n0, n1))
    for t in range(params.num_trees):
        want = _plain_tree(rows, t, params, w)
        got = [n for n in model.nodes if n[0] == t]
        assert [(n[2], n[7], n[8], n[3], n[5], n[6]) for n in got] == [(v[0], v[1], v[2], v[3], v[5], v[6]) for v in want]
        # a threshold lies at a value of the node or at the next bin bound below the following value
        for n, v in zip(got, want):
            if v[4] is not None:
                assert n[4] == v[4]


@pytest.mark.parametrize("parts", [1, 7])
def test_limits_hold_and_partitions_do_not_matter(spark, parts):
    p = ForestParams(num_trees=25, max_leaf_nodes=5, min_samples_leaf=15, min_samples_split=70, max_bins=16)
    rows = _rows(400, 9)
    model = fit_forest(_frame(spark, rows, parts), FEATURES, "good", p)
    assert model.nodes == fit_forest(_frame(spark, rows, 3), FEATURES, "good", p).nodes
    for t in range(p.num_trees):
        own = {n[1]: n for n in model.nodes if n[0] == t}
        leaves = [n for n in own.values() if n[3] is None]
        assert len(leaves) <= p.max_leaf_nodes and sum(n[7] + n[8] for n in leaves) == len(rows)
        for n in own.values():
            if n[3] is None:
                assert n[7] + n[8] >= p.min_samples_leaf
            else:
                assert n[7] + n[8] >= p.min_samples_split


def test_rows_are_dealt_to_all_cores_and_shared_paths_counted_once(spark, monkeypatch):
    """One input file must not mean one task a round; trees that agree on their splits must not count the same rows again."""
    written, counts = [], []
    keep = forest.materialize
    monkeypatch.setattr(forest, "materialize", lambda df: written.append(keep(df)) or written[-1])
    p = ForestParams(num_trees=30, max_leaf_nodes=4, min_samples_leaf=10, min_samples_split=30, features_per_split=5)
    model = fit_forest(_frame(spark, _rows(4000), 1), FEATURES, "good", p)
    (data,) = written
    assert data.select(F.spark_partition_id().alias("p")).distinct().count() == spark.sparkContext.defaultParallelism
    # all features are drawn everywhere, so all trees are the same: one count a node and feature, whatever the number of trees
    assert len({tuple(n[1:]) for n in model.nodes}) == len(model.nodes) // p.num_trees
    bincount = forest.np.bincount
    monkeypatch.setattr(forest.np, "bincount", lambda *a, **k: counts.append(1) or bincount(*a, **k))
    batch = pa.RecordBatch.from_pydict({"x": [bytes([i % 7, i % 3]) for i in range(50)], "y": pa.array([i % 2 for i in range(50)], pa.int32()), "m": [1] * 50})
    wanted = [(t, 1, ((0, 2, True),), [(0, 0), (0, 1)]) for t in range(30)]
    out = pa.Table.from_batches(forest._histograms(2, 7, wanted)([batch]))
    assert len(counts) == 2 and out.num_rows == 30 * (3 + 3)
    below = [i for i in range(50) if i % 7 <= 2]
    assert sum(out.column("n0").to_pylist()) == 30 * 2 * sum(i % 2 == 0 for i in below)
    assert sum(out.column("n1").to_pylist()) == 30 * 2 * sum(i % 2 for i in below)


def test_forest_scores_and_round_trip(spark, tmp_path):
    p = ForestParams(num_trees=20, max_leaf_nodes=8, min_samples_leaf=10, min_samples_split=25)
    rows = _rows(500, 5)
    df = _frame(spark, rows)
    model = fit_forest(df, FEATURES, "good", p)
    scored = model.transform(df)
    nodes = {(n[0], n[1]): n for n in model.nodes}
    for r in scored.limit(40).collect():
        total = 0.0
        for t in range(p.num_trees):
            n = nodes[t, 0]
            while n[3] is not None:
                n = nodes[t, n[5] if r[n[3]] <= n[4] else n[6]]
            total += n[9]
        assert math.isclose(r["p_good"], total / p.num_trees) and r["prediction"] == float(r["p_good"] > 0.5)
    assert exact_auc(scored, F.col("good"), F.col("p_good")).first()["auc"] > 0.8  # a planted signal is found
    model.save(spark, str(tmp_path / "m"))
    again = ForestModel.load(spark, str(tmp_path / "m"))
    assert again.features == model.features and again.nodes == model.nodes


def test_forest_without_a_split(spark):
    one_class = [(*r[:5], True, 1) for r in _rows(50)]
    model = fit_forest(_frame(spark, one_class), FEATURES, "good", ForestParams(num_trees=3))
    assert [n[9] for n in model.nodes] == [1.0, 1.0, 1.0]
    empty = fit_forest(_frame(spark, one_class).where("a < -1"), FEATURES, "good", ForestParams(num_trees=1))
    assert len(empty.nodes) == 1


def _plain_auc(pairs):
    pos, neg = [s for y, s in pairs if y], [s for y, s in pairs if not y]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg)) if pos and neg else None


def test_exact_auc(spark):
    rnd = random.Random(2)
    rows = [(g, rnd.random() < 0.4, rnd.choice([0.0, 1.0, rnd.random(), round(rnd.random(), 1)])) for g in ("x", "y", None) for _ in range(150)]
    rows += [("z", True, 0.5), ("x", None, 0.1), ("x", True, None)]
    df = spark.createDataFrame(rows, "g string, y boolean, s double").repartition(5)
    known = [(g, y, s) for g, y, s in rows if y is not None and s is not None]
    got = {r["g"]: (r["n_pos"], r["n_neg"], r["auc"]) for r in exact_auc(df, F.col("y"), F.col("s"), {"g": F.col("g")}).collect()}
    assert got.keys() == {"x", "y", "z", None}
    for g, (p, n, auc) in got.items():
        own = [(y, s) for k, y, s in known if k == g]
        want = _plain_auc(own)
        assert (p, n) == (sum(y for y, _ in own), sum(not y for y, _ in own))
        assert auc == want or math.isclose(auc, want, rel_tol=1e-12)
    total = exact_auc(df, F.col("y"), F.col("s")).collect()
    assert len(total) == 1 and math.isclose(total[0]["auc"], _plain_auc([(y, s) for _, y, s in known]), rel_tol=1e-12)
    assert exact_auc(df.where("s > 9"), F.col("y"), F.col("s")).count() == 0

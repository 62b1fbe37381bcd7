"""Random forest with best-first growth, a limit on leaves and a least size for a split.

``pyspark.ml`` grows trees level by level and has neither limit, so trees are
grown here over distributed histograms:

* every feature is cut into at most ``max_bins`` bins (all distinct values where
  there are no more, else approximate quantiles) and each row is written once as its bin numbers;
* a round is one pass over those rows for all trees together: a task sends each row
  down every tree and counts, for the nodes that wait, (feature, bin) by class. Nodes that the same splits lead to are
  counted once for all their trees, and the rows are dealt out to all cores.
  The counts are added up and the best split of each node is found in Spark; one row
  a node reaches the driver;
* the driver keeps, per tree, the leaves ordered by the gain of their best split and splits
  the first one (best first), until the tree has ``max_leaf_nodes`` leaves or no leaf can be split. The two new leaves wait
  for the next round.

A node may be split if it has at least ``min_samples_split`` rows, is not below ``max_depth``, holds
both classes, and both sides get at least ``min_samples_leaf`` rows; a split must lower the weighted Gini impurity. Each
node looks at ``features_per_split`` features drawn for it; if none has a valid
split, at the others in drawn order, and takes the first that has one. All counts are whole numbers and ties are broken by draw order, so
a forest depends on the rows, the parameters and the seed only, not on partitions.

A row counts ``weight`` times (whole number); balanced class weights apply to the counts of a class.
Trees differ by their feature draws; rows are not resampled.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from callpulse.session import materialize


@dataclass(frozen=True)
class ForestParams:
    num_trees: int = 500
    max_depth: int = 15
    max_leaf_nodes: int = 14
    min_samples_leaf: int = 80
    min_samples_split: int = 175
    max_bins: int = 64
    features_per_split: int | None = None  # None: square root of the number of features
    seed: int = 7

    def draws(self, n_features: int) -> int:
        return max(1, min(n_features, self.features_per_split or math.isqrt(n_features)))


@dataclass
class Node:
    depth: int
    n0: int
    n1: int
    feature: int | None = None
    bin: int | None = None
    left: int | None = None
    right: int | None = None


@dataclass
class Tree:
    nodes: list[Node] = field(default_factory=list)
    #: splits in the order made: node, feature, bin, left, right
    splits: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    #: (-gain, node, feature, bin, n0 and n1 of the left side)
    frontier: list[tuple] = field(default_factory=list)
    #: nodes whose histograms are wanted, and whether their first features had no valid split
    waiting: dict[int, bool] = field(default_factory=dict)


def feature_order(seed: int, tree: int, node: int, n_features: int) -> np.ndarray:
    """Features of a node in drawn order."""
    return np.random.default_rng([seed, tree, node]).permutation(n_features)


# -- bins ------------------------------------------------------------------------


def bin_edges(rows: DataFrame, features, max_bins: int) -> list[list[float]]:
    """Ascending upper bounds per feature; a value has the bin of the first bound that is not below it."""
    quantiles = [j / max_bins for j in range(1, max_bins + 1)]
    x = [F.col(f).cast("double") for f in features]
    row = rows.agg(
        *[F.percentile_approx(c, quantiles, 100 * max_bins).alias(f"q{i}") for i, c in enumerate(x)],
        *[F.approx_count_distinct(c).alias(f"d{i}") for i, c in enumerate(x)],
    ).first()
    edges = [sorted(set(row[f"q{i}"] or [])) for i in range(len(x))]
    # few distinct values: all of them, rare ones too (at most twice max_bins values a feature reach the driver)
    few = [i for i in range(len(x)) if row[f"d{i}"] <= 2 * max_bins]
    if few:
        pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), x[i].alias("v")) for i in few]))
        values: dict[int, list[float]] = {}
        for r in rows.select(pairs.alias("p")).select("p.i", "p.v").where(F.col("v").isNotNull()).distinct().collect():
            values.setdefault(r["i"], []).append(r["v"])
        for i, v in values.items():
            if len(v) <= max_bins:
                edges[i] = sorted(v)
    # one more bound for what lies above the last one seen
    return [[*e, math.inf] for e in edges]


def _binned(features, edges: list[list[float]]):
    def run(batches):
        for b in batches:
            x = np.empty((b.num_rows, len(features)), np.uint8)
            for i, e in enumerate(edges):
                x[:, i] = np.searchsorted(e, b.column(i).to_numpy(zero_copy_only=False), "left")
            raw = pa.array([r.tobytes() for r in x], pa.binary())
            yield pa.RecordBatch.from_arrays([raw, b.column(len(features)), b.column(len(features) + 1)], ["x", "y", "m"])

    return run


# -- one round ---------------------------------------------------------------------

_CELLS = "tree int, node int, place int, feature int, bin int, n0 long, n1 long"


def _path(tree: "Tree", node: int) -> tuple[tuple[int, int, bool], ...]:
    """(feature, bin, whether left) of the splits from the root to the node."""
    above = {}
    for parent, feature, bin_, left, right in tree.splits:
        above[left], above[right] = (parent, feature, bin_, True), (parent, feature, bin_, False)
    steps = []
    while node in above:
        node, *step = above[node]
        steps.append(tuple(step))
    return tuple(reversed(steps))


def _histograms(n_features: int, n_bins: int, wanted: list[tuple]):
    """wanted: (tree, node, path, [(place, feature), ..]); trees that share a path share its rows and counts."""
    # paths as nested steps, so that rows are narrowed down once for all paths that begin alike
    root: dict = {"next": {}, "features": set(), "path": ()}
    for _, _, path, drawn in wanted:
        at = root
        for depth, step in enumerate(path):
            at = at["next"].setdefault(step, {"next": {}, "features": set(), "path": path[: depth + 1]})
        at["features"].update(f for _, f in drawn)

    def run(batches):
        sums: dict[tuple[tuple, int], np.ndarray] = {}
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            x = np.ascontiguousarray(np.frombuffer(b"".join(b.column("x").to_pylist()), np.uint8).reshape(n, n_features).T)
            y = b.column("y").to_numpy(zero_copy_only=False).astype(np.int64)
            m = b.column("m").to_numpy(zero_copy_only=False)

            def count(at, here):
                if not len(here):
                    return
                cls, times = y[here], m[here]
                for f in at["features"]:
                    own = np.bincount(x[f, here] * np.int64(2) + cls, weights=times, minlength=2 * n_bins).astype(np.int64)
                    key = (at["path"], f)
                    sums[key] = sums[key] + own if key in sums else own
                for (f, k, left), below in at["next"].items():
                    goes_left = x[f, here] <= k
                    count(below, here[goes_left if left else ~goes_left])

            count(root, np.arange(n))
        for tree, node, path, drawn in wanted:
            seen = [(place, f) for place, f in drawn if (path, f) in sums]
            if not seen:
                continue
            cells = np.stack([sums[path, f] for _, f in seen]).reshape(len(seen), n_bins, 2)
            j, k = np.nonzero(cells.any(axis=2))
            places = np.array(seen)
            cols = [np.full(len(j), tree), np.full(len(j), node), places[j, 0], places[j, 1], k]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int32()) for c in cols), pa.array(cells[j, k, 0]), pa.array(cells[j, k, 1])],
                [c.split()[0] for c in _CELLS.split(", ")],
            )

    return run


def best_splits(cells: DataFrame, weights: tuple[float, float], min_samples_leaf: int) -> DataFrame:
    """Per (tree, node): n0, n1 and the best valid split (gain, feature, bin, l0, l1; null if none).

    ``place`` orders the features: those of place 0 compete by gain, others come one after the other.
    """
    h = cells.groupBy("tree", "node", "place", "feature", "bin").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    whole = Window.partitionBy("tree", "node", "place", "feature")
    upto = whole.orderBy("bin")
    h = h.select(
        "tree", "node", "place", "feature", "bin",
        F.sum("n0").over(upto).alias("l0"), F.sum("n1").over(upto).alias("l1"), F.sum("n0").over(whole).alias("n0"), F.sum("n1").over(whole).alias("n1"),
    )

    def purity(a, b):
        a, b = a * F.lit(float(weights[0])), b * F.lit(float(weights[1]))
        return F.try_divide(a * a + b * b, a + b)

    r0, r1 = F.col("n0") - F.col("l0"), F.col("n1") - F.col("l1")
    gain = purity(F.col("l0"), F.col("l1")) + purity(r0, r1) - purity(F.col("n0"), F.col("n1"))
    valid = (F.col("l0") + F.col("l1") >= min_samples_leaf) & (r0 + r1 >= min_samples_leaf) & (gain > 1e-9)
    order = F.when(valid, F.struct((-F.col("place")).alias("p"), gain.alias("g"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b")))
    return h.groupBy("tree", "node").agg(
        F.max("n0").alias("n0"),
        F.max("n1").alias("n1"),
        F.max_by(F.struct(gain.alias("gain"), "feature", "bin", "l0", "l1"), order).alias("best"),
    )


# -- growth --------------------------------------------------------------------------


def _may_split(node: Node, p: ForestParams) -> bool:
    n = node.n0 + node.n1
    return node.depth < p.max_depth and n >= p.min_samples_split and n >= 2 * p.min_samples_leaf and node.n0 > 0 and node.n1 > 0


def _advance(tree: Tree, p: ForestParams) -> None:
    """Split the best leaves until a node waits for its histogram or the tree is done."""
    while not tree.waiting and tree.frontier and len(tree.splits) + 1 < p.max_leaf_nodes:
        _, k, feature, bin_, l0, l1 = heapq.heappop(tree.frontier)
        node = tree.nodes[k]
        node.feature, node.bin, node.left, node.right = feature, bin_, len(tree.nodes), len(tree.nodes) + 1
        tree.nodes += [Node(node.depth + 1, l0, l1), Node(node.depth + 1, node.n0 - l0, node.n1 - l1)]
        tree.splits.append((k, feature, bin_, node.left, node.right))
        if len(tree.splits) + 1 < p.max_leaf_nodes:
            tree.waiting = {c: False for c in (node.left, node.right) if _may_split(tree.nodes[c], p)}


def fit_forest(
    rows: DataFrame,
    features,
    label: str,
    params: ForestParams = ForestParams(),
    class_weights: tuple[float, float] | None = None,
    weight: str | None = None,
) -> "ForestModel":
    """``label`` is 0 or 1 (or boolean). Class weights default to n / (2 n_class) of the rows given; features must not be null."""
    features = list(features)
    n_features = len(features)
    edges = bin_edges(rows, features, params.max_bins)
    n_bins = max(len(e) for e in edges)
    plain = rows.select(
        *[F.col(f).cast("double").alias(f) for f in features],
        F.col(label).cast("int").alias("__y"),
        (F.col(weight) if weight else F.lit(1)).cast("long").alias("__m"),
    )
    binned = plain.mapInArrow(_binned(features, edges), "x binary, y int, m long")
    # few bytes a row, much work a row and round: rows are dealt out to all cores, however few files they came from
    data = materialize(binned.repartition(rows.sparkSession.sparkContext.defaultParallelism))
    count = {r["y"]: r["n"] for r in data.groupBy("y").agg(F.sum("m").alias("n")).collect()}
    n0, n1 = count.get(0, 0), count.get(1, 0)
    if class_weights is None:
        class_weights = tuple((n0 + n1) / (2 * n) if n else 0.0 for n in (n0, n1))
    trees = [Tree([Node(0, n0, n1)]) for _ in range(params.num_trees)]
    for tree in trees:
        if _may_split(tree.nodes[0], params) and params.max_leaf_nodes > 1:
            tree.waiting = {0: False}
    draws = params.draws(n_features)
    while True:
        wanted = []
        for t, tree in enumerate(trees):
            for node, again in tree.waiting.items():
                order = feature_order(params.seed, t, node, n_features).tolist()
                drawn = [(k + 1, f) for k, f in enumerate(order[draws:])] if again else [(0, f) for f in order[:draws]]
                wanted.append((t, node, _path(tree, node), drawn))
        if not wanted:
            return ForestModel.of(trees, features, edges, class_weights)
        cells = data.mapInArrow(_histograms(n_features, n_bins, wanted), _CELLS)
        found = {(r["tree"], r["node"]): r["best"] for r in best_splits(cells, class_weights, params.min_samples_leaf).collect()}
        for t in sorted({t for t, *_ in wanted}):
            tree = trees[t]
            waiting, tree.waiting = tree.waiting, {}
            for node in waiting:
                best = found[t, node]
                if best is not None:
                    heapq.heappush(tree.frontier, (-best["gain"], node, best["feature"], best["bin"], best["l0"], best["l1"]))
                elif not waiting[node] and draws < n_features:
                    tree.waiting[node] = True
            _advance(tree, params)


# -- model ---------------------------------------------------------------------------

MODEL_SCHEMA = (
    "tree int, node int, depth int, feature string, threshold double, left int, right int, n0 long, n1 long, p_good double, n_features int, place int"
)


class ForestModel:
    """Fitted trees as one row per node; at most num_trees x (2 max_leaf_nodes - 1) rows."""

    def __init__(self, features: list[str], nodes: list[tuple]):
        self.features, self.nodes = features, nodes

    @classmethod
    def of(cls, trees: list[Tree], features: list[str], edges, class_weights) -> "ForestModel":
        out = []
        for t, tree in enumerate(trees):
            for k, v in enumerate(tree.nodes):
                w0, w1 = v.n0 * class_weights[0], v.n1 * class_weights[1]
                leaf = v.feature is None
                out.append((
                    t, k, v.depth, None if leaf else features[v.feature], None if leaf else float(edges[v.feature][v.bin]),
                    v.left, v.right, v.n0, v.n1, w1 / (w0 + w1) if w0 + w1 else 0.0,
                ))
        return cls(features, out)

    def table(self, spark: SparkSession) -> DataFrame:
        """The nodes, and one row for each feature's place (tree -1)."""
        places = [(-1, -1, 0, f, None, None, None, 0, 0, 0.0, len(self.features), i) for i, f in enumerate(self.features)]
        return spark.createDataFrame([(*n, len(self.features), None) for n in self.nodes] + places, MODEL_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        self.table(spark).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "ForestModel":
        rows = spark.read.schema(MODEL_SCHEMA).parquet(path).collect()
        features = [r["feature"] for r in sorted((r for r in rows if r["tree"] < 0), key=lambda r: r["place"])]
        nodes = sorted((tuple(r)[:10] for r in rows if r["tree"] >= 0), key=lambda n: n[:2])
        return cls(features, nodes)

    def _arrays(self):
        place = {f: i for i, f in enumerate(self.features)}
        trees: dict[int, list[tuple]] = {}
        for n in self.nodes:
            trees.setdefault(n[0], []).append(n)
        out = []
        for _, ns in sorted(trees.items()):
            leaf = [n[3] is None for n in ns]
            out.append((
                np.array([0 if x else place[n[3]] for x, n in zip(leaf, ns)]),
                np.array([math.inf if x else n[4] for x, n in zip(leaf, ns)]),
                # a leaf leads to itself
                np.array([k if x else n[5] for k, (x, n) in enumerate(zip(leaf, ns))]),
                np.array([k if x else n[6] for k, (x, n) in enumerate(zip(leaf, ns))]),
                np.array([n[9] for n in ns]),
                max(n[2] for n in ns),
            ))
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """df with p_good (mean over the trees of the leaf's weighted share of class 1) and prediction (1.0 above a half)."""
        trees, n_trees = self._arrays(), max(1, len({n[0] for n in self.nodes}))

        @F.pandas_udf("double")
        def score(*cols: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(np.float64) for c in cols])
            total, row = np.zeros(len(x)), np.arange(len(x))
            for feature, threshold, left, right, p, depth in trees:
                at = np.zeros(len(x), np.int64)
                for _ in range(depth):
                    at = np.where(x[row, feature[at]] <= threshold[at], left[at], right[at])
                total += p[at]
            return pd.Series(total / n_trees)

        out = df.withColumn("p_good", score(*[F.col(f).cast("double") for f in self.features]))
        return out.withColumn("prediction", F.when(F.col("p_good") > 0.5, 1.0).otherwise(0.0))

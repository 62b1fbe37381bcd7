"""Small gradient-boosted trees for two classes, trained on a bounded sample and applied in batches."""

from __future__ import annotations

import numpy as np


class Boosted:
    """Logistic loss, histogram splits of equal depth, each tree on a random share of the rows; arrays only, so it travels in a task closure."""

    def __init__(self, trees: int = 40, depth: int = 4, rate: float = 0.2, bins: int = 32, least: float = 5.0, l2: float = 1.0, share: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.least, self.l2, self.share = trees, depth, rate, bins, least, l2, share

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        n, m = x.shape
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(m)]
        codes = [np.searchsorted(cuts[j], x[:, j], "left") for j in range(m)]
        rng = np.random.default_rng(5)
        mean = min(max(float(y.mean()), 1e-3), 1 - 1e-3) if n else 0.5
        self.start = float(np.log(mean / (1 - mean)))
        score = np.full(n, self.start)
        inner, leaves = (1 << self.depth) - 1, 1 << self.depth
        self.feature = np.zeros((self.trees, inner), np.int64)
        self.cut = np.full((self.trees, inner), np.inf)
        self.value = np.zeros((self.trees, leaves))
        for t in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p)
            some = np.flatnonzero(rng.random(n) < self.share) if self.share < 1 else np.arange(n)
            code = [c[some] for c in codes]
            mine, g, h = x[some], g[some], h[some]
            node = np.zeros(len(some), np.int64)  # within the level
            for level in range(self.depth):
                width = 1 << level
                best = np.full(width, 1e-9)
                split = np.zeros(width, np.int64)
                at = np.full(width, -1)
                for j in range(m):
                    b = len(cuts[j]) + 1
                    if b < 2:
                        continue
                    key = node * b + code[j]
                    gs = np.cumsum(np.bincount(key, g, width * b).reshape(width, b), 1)
                    hs = np.cumsum(np.bincount(key, h, width * b).reshape(width, b), 1)
                    gt, ht = gs[:, -1:], hs[:, -1:]
                    gl, hl = gs[:, :-1], hs[:, :-1]
                    gain = gl**2 / (hl + self.l2) + (gt - gl) ** 2 / (ht - hl + self.l2) - gt**2 / (ht + self.l2)
                    gain[(hl < self.least / 4) | (ht - hl < self.least / 4)] = 0
                    k = gain.argmax(1)
                    v = gain[np.arange(width), k]
                    better = v > best
                    best[better], split[better], at[better] = v[better], j, k[better]
                base = width - 1
                for w in range(width):
                    self.feature[t, base + w] = split[w]
                    self.cut[t, base + w] = cuts[split[w]][at[w]] if at[w] >= 0 else np.inf
                right = mine[np.arange(len(some)), self.feature[t, base + node]] > self.cut[t, base + node]
                node = 2 * node + right
            gs, hs = np.bincount(node, g, leaves), np.bincount(node, h, leaves)
            self.value[t] = self.rate * gs / (hs + self.l2)
            score += self.value[t][self._leaf(x, t)]
        return self

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        at = np.arange(len(x))
        for t in range(self.trees):
            out += self.value[t][self._leaf(x, t, at)]
        return out

    def _leaf(self, x: np.ndarray, t: int, at: np.ndarray | None = None) -> np.ndarray:
        """The leaf of tree t that each row falls into."""
        at = np.arange(len(x)) if at is None else at
        node = np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[at, self.feature[t, node]] > self.cut[t, node])
        return node - self.feature.shape[1]

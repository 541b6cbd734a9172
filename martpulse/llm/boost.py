"""Gradient boosted shallow trees over binned features, and Platt scaling, learned from sums over all rows.

A model asks for sums only: per level of a tree one histogram of gradients and second derivatives over all rows. Blocks of rows
add theirs in whole numbers, ``STEP`` to one, so that neither the layout nor the order of the blocks changes the model.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STEP = 2**20


def bin_edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Inner edges per feature: distinct quantiles, with finer ones at both ends, where rare kinds of rows lie."""
    cuts = np.unique([*np.linspace(0, 1, bins + 1)[1:-1], 0.002, 0.005, 0.01, 0.99, 0.995, 0.998])
    return [np.unique(np.quantile(x[:, j], cuts)) for j in range(x.shape[1])]


def to_bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]).astype(np.int32)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def best_split(g: np.ndarray, h: np.ndarray, l2: float) -> tuple[float, int]:
    """(gain, last bin of the left side) for histograms of gradients and second derivatives."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = gl**2 / (hl + l2) + (g.sum() - gl) ** 2 / (h.sum() - hl + l2) - g.sum() ** 2 / (h.sum() + l2)
    if not len(gain):
        return 0.0, -1
    at = int(np.argmax(gain))
    return float(gain[at]), at


def whole(x: np.ndarray) -> np.ndarray:
    return np.rint(x * STEP)


def summed(rows: DataFrame, block: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    """The sum over all blocks of what ``block`` makes of one: ``size`` whole numbers, added up per task and then by Spark."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += block(batch)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["slot", "amount"])

    got = rows.mapInArrow(add, "slot int, amount long").groupBy("slot").agg(F.sum("amount")).collect()
    out = np.zeros(size, np.int64)
    for slot, amount in got:
        out[slot] = amount
    return out


@dataclass
class Trees:
    """Binary classifier: a sum of trees of a fixed depth, each stored as arrays of splits and leaf values."""

    depth: int = 3
    rounds: int = 60
    rate: float = 0.2
    bins: int = 32
    l2: float = 1.0
    start: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        """From rows in memory."""
        self.edges = bin_edges(x, self.bins)
        b, n = to_bins(x, self.edges), np.ones(len(y))
        return self.learn(y.mean(), lambda feature, cut, level: self.histogram(b, n, y, feature, cut, level))

    def learn(self, positive: float, sums: Callable[[np.ndarray, np.ndarray, int], np.ndarray]) -> Trees:
        """From sums: ``positive`` is the share of label 1, ``sums(feature, cut, level)`` adds up :meth:`histogram` over all rows.

        A pass per level; the values of the leaves come from the histograms of the last one.
        """
        p = np.clip(positive, 1e-3, 1 - 1e-3)
        self.start = float(np.log(p / (1 - p)))
        at = np.cumsum([0, *(len(e) + 1 for e in self.edges)])
        inner = 2**self.depth - 1
        for _ in range(self.rounds):
            feature, cut, value = np.zeros(inner, int), np.full(inner, np.iinfo(np.int32).max), np.zeros(inner + 1)
            for level in range(self.depth):
                first = 2**level - 1
                hists = np.asarray(sums(feature, cut, level)).reshape(2, first + 1, at[-1]) / STEP
                for n in range(first + 1):
                    found = (0.0, 0, -1)
                    for j in range(len(self.edges)):
                        gain, last = best_split(hists[0, n, at[j] : at[j + 1]], hists[1, n, at[j] : at[j + 1]], self.l2)
                        found = max(found, (gain, j, last))
                    if found[2] >= 0:
                        feature[first + n], cut[first + n] = found[1:]
                    if level == self.depth - 1:
                        j, end = found[1], at[found[1]] + found[2] + 1 if found[2] >= 0 else at[found[1] + 1]
                        for side, part in enumerate((hists[:, n, at[j] : end], hists[:, n, end : at[j + 1]])):
                            g, h = part.sum(1)
                            value[2 * n + side] = -self.rate * g / (h + self.l2)
            self.trees.append((feature, cut, value))
        return self

    def histogram(self, b: np.ndarray, n: np.ndarray, positive: np.ndarray, feature: np.ndarray, cut: np.ndarray, level: int) -> np.ndarray:
        """What a block of binned rows adds: gradients, then second derivatives, per node of a level, feature and bin.

        Row i stands for ``n[i]`` equal rows, ``positive[i]`` of them with label 1.
        """
        p = sigmoid(self.total(b))
        node = self._reached(b, feature, cut, level) - (2**level - 1)
        out = []
        for w in (whole(n * p - positive), whole(n * p * (1 - p))):
            parts = []
            for j, e in enumerate(self.edges):
                size = len(e) + 1
                parts.append(np.bincount(node * size + b[:, j], w, 2**level * size).reshape(2**level, size))
            out.append(np.concatenate(parts, axis=1))
        return np.stack(out).astype(np.int64).ravel()

    def slots(self, level: int) -> int:
        """The length of a histogram."""
        return 2 * 2**level * sum(len(e) + 1 for e in self.edges)

    def _reached(self, b: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
        node = np.zeros(len(b), np.int32)
        for level in range(levels):
            right = np.zeros(len(b), bool)
            for n in range(2**level - 1, 2 ** (level + 1) - 1):
                right |= (node == n) & (b[:, feature[n]] > int(cut[n]))
            node = 2 * node + 1 + right
        return node

    def total(self, b: np.ndarray) -> np.ndarray:
        """Margins of binned rows: tree by tree, or all trees at once for the few rows of one text; both add in the same order."""
        z = np.zeros(len(b))
        if len(b) > 256 or not self.trees:
            for feature, cut, value in self.trees:
                z += value[self._reached(b, feature, cut, self.depth) - len(feature)]
            return self.start + z
        feature, cut, value = (np.array(a) for a in zip(*self.trees, strict=True))
        tree, row, node = np.arange(len(feature))[:, None], np.arange(len(b)), np.zeros((len(feature), len(b)), int)
        for _ in range(self.depth):
            node = 2 * node + 1 + (b[row, feature[tree, node]] > cut[tree, node])
        return self.start + value[tree, node - feature.shape[1]].cumsum(0)[-1]

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.total(to_bins(x, self.edges))


def platt(margin: np.ndarray, label: np.ndarray, n: np.ndarray, of: tuple[float, float], a: float, b: float) -> np.ndarray:
    """What a block of rows adds to a Newton step of Platt scaling; ``of`` has the targets of labels 0 and 1.

    Rows far from the cut add little each, so every sum has a second slot for what is below one ``STEP``.
    """
    p = sigmoid(a * margin + b)
    d, w = n * (p - np.where(label > 0, of[1], of[0])), n * (p * (1 - p) + 1e-9)
    x = np.stack([d * margin, d, w * margin**2, w * margin, w]) * STEP
    high = np.floor(x)
    return np.stack([high, whole(x - high)], axis=1).astype(np.int64).sum(2).ravel()


def calibrate(sums: Callable[[float, float], np.ndarray], steps: int = 50) -> tuple[float, float]:
    """Platt scaling by Newton steps: (slope, offset) with p = sigmoid(slope * margin + offset), from :func:`platt` over all rows."""
    a, b = 1.0, 0.0
    for _ in range(steps):
        da, db, aa, ab, bb = np.asarray(sums(a, b)).reshape(5, 2) @ np.array([1 / STEP, 1 / STEP**2])
        step = np.linalg.solve(np.array([[aa + 1e-6, ab], [ab, bb + 1e-6]]), np.array([da, db]))
        step /= max(1.0, np.abs(step).max())  # far from the optimum a whole step overshoots
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)

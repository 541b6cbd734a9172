"""Quality classifier: a generalised additive model with pairwise interactions.

Training goes round the features in turn; each time a shallow tree of at most three leaves is fitted to the current
gradients of one feature's bins and a small step of it is added to that feature's lookup table. The strongest pairs on
what is left (gain of the best cut in four) get tables of their own in the same way. A text's score is the sum of one entry
per table: bins by binary search, entries by vectorised lookup.

Features come from the whole text alone. The model is fitted on at most ``sample`` labelled rows, those with the
smallest hash of doc_id; every document is scored.

Defined cases: a null text is empty, and an empty text gets a score as any other; a null doc_id is not held out;
labels that are null, repeated for a document, or held out are ignored (repeats: each counts); without labels of both classes every
score is the share of good labels, or 0.5 without any; other columns are kept by :func:`score` and replaced if their
name clashes with an added one.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martpulse.llm.boost import best_split, bin_edges, sigmoid, to_bins

THRESHOLD = 0.7
FEATURES = (
    "words", "word_length", "long_words", "distinct", "stutter", "upper", "digit", "space", "stop", "symbol", "high",
    "line_length", "line_repeats", "pipes", "tail_symbols", "shouted",
)
LOWER, UPPER, DIGIT, SPACE, STOP, SYMBOL, HIGH = range(7)


def _byte_classes() -> np.ndarray:
    table = np.full(256, SYMBOL, np.int64)
    table[128:] = HIGH
    for chars, kind in ((b".,;:?'\"()-", STOP), (b" \t\r\n\v\f", SPACE)):
        table[list(chars)] = kind
    table[ord("0") : ord("9") + 1], table[ord("A") : ord("Z") + 1], table[ord("a") : ord("z") + 1] = DIGIT, UPPER, LOWER
    return table


CLASSES = _byte_classes()


def features(text: str | None) -> list[float]:
    """The numbers of one whole text, in the order of FEATURES."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.bincount(CLASSES[raw], minlength=7) if len(raw) else np.zeros(7)
    size = max(1, len(raw))
    words, lines = text.split(), text.split("\n")
    n = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    return [
        float(np.log1p(len(words))), lengths.sum() / n, (lengths > 20).sum() / n, len(set(words)) / n**0.75,
        sum(map(operator.eq, words, words[1:])) / n,
        counts[UPPER] / size, counts[DIGIT] / size, counts[SPACE] / size, counts[STOP] / size, counts[SYMBOL] / size,
        counts[HIGH] / size, float(np.log1p(len(text) / len(lines))), 1 - len(set(lines)) / len(lines),
        text.count("|") / n, sum(w[-1] in "!$%&*#" for w in words) / n, counts[UPPER] / max(1, counts[LOWER] + counts[UPPER]),
    ]


@dataclass
class Gam:
    """Lookup tables per feature and per chosen pair."""

    bins: int = 32
    coarse: int = 8
    rounds: int = 150
    pair_rounds: int = 60
    pairs_kept: int = 8
    rate: float = 0.1
    l2: float = 1.0
    start: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def _coarse(self, bins: np.ndarray, j: int) -> np.ndarray:
        return bins * self.coarse // (len(self.edges[j]) + 1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Gam:
        self.edges = bin_edges(x, self.bins)
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(mean / (1 - mean)))
        b = to_bins(x, self.edges)
        z = np.full(len(y), self.start)
        for _ in range(self.rounds):
            for j in range(x.shape[1]):
                p = sigmoid(z)
                step = self._shallow(b[:, j], p - y, p * (1 - p), len(self.edges[j]) + 1)
                self.tables[j] += step
                z += step[b[:, j]]
        small = np.column_stack([self._coarse(b[:, j], j) for j in range(x.shape[1])])
        p = sigmoid(z)
        gains = [
            (self._four(small[:, i], small[:, j], p - y, p * (1 - p))[0], i, j)
            for i in range(x.shape[1]) for j in range(i)
        ]
        self.pairs = [(i, j) for gain, i, j in sorted(gains, reverse=True)[: self.pairs_kept] if gain > 0]
        self.pair_tables = [np.zeros((self.coarse, self.coarse)) for _ in self.pairs]
        for _ in range(self.pair_rounds):
            for table, (i, j) in zip(self.pair_tables, self.pairs, strict=True):
                p = sigmoid(z)
                step = self._four(small[:, i], small[:, j], p - y, p * (1 - p))[1]
                table += step
                z += step[small[:, i], small[:, j]]
        return self

    def _shallow(self, bins: np.ndarray, g: np.ndarray, h: np.ndarray, size: int) -> np.ndarray:
        """A tree of up to three leaves over one feature: the best cut, then the better cut of its two sides."""
        hg, hh = np.bincount(bins, g, size), np.bincount(bins, h, size)
        gain, at = best_split(hg, hh, self.l2)
        cuts = {0, size}
        if gain > 0:
            cuts.add(at + 1)
            left, right = best_split(hg[: at + 1], hh[: at + 1], self.l2), best_split(hg[at + 1 :], hh[at + 1 :], self.l2)
            side, base = (left, 0) if left[0] >= right[0] else (right, at + 1)
            if side[0] > 0:
                cuts.add(base + side[1] + 1)
        out, order = np.zeros(size), sorted(cuts)
        for a, b in zip(order, order[1:], strict=False):
            out[a:b] = -self.rate * hg[a:b].sum() / (hh[a:b].sum() + self.l2)
        return out

    def _four(self, bi: np.ndarray, bj: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
        """(gain, step) of the best cut of a pair's grid into four."""
        k = self.coarse
        corner = []
        for w in (g, h):
            grid = np.bincount(bi * k + bj, w, k * k).reshape(k, k)
            corner.append((grid, grid.cumsum(0).cumsum(1)))
        (gg, gc), (hg, hc) = corner
        best, at = -1.0, (0, 0)
        for a in range(k - 1):
            for c in range(k - 1):
                gain = 0.0
                for gq, hq in zip(self._quarters(gc, a, c), self._quarters(hc, a, c), strict=True):
                    gain += gq**2 / (hq + self.l2)
                if gain > best:
                    best, at = gain, (a, c)
        a, c = at
        step = np.zeros((k, k))
        for rows in (slice(0, a + 1), slice(a + 1, k)):
            for cols in (slice(0, c + 1), slice(c + 1, k)):
                step[rows, cols] = -self.rate * gg[rows, cols].sum() / (hg[rows, cols].sum() + self.l2)
        return best - gg.sum() ** 2 / (hg.sum() + self.l2), step

    @staticmethod
    def _quarters(c: np.ndarray, a: int, b: int) -> tuple[float, float, float, float]:
        nw = c[a, b]
        return nw, c[a, -1] - nw, c[-1, b] - nw, c[-1, -1] - c[a, -1] - c[-1, b] + nw

    def score(self, x: np.ndarray) -> np.ndarray:
        b = to_bins(x, self.edges)
        z = np.full(len(x), self.start)
        for j, table in enumerate(self.tables):
            z += table[b[:, j]]
        for table, (i, j) in zip(self.pair_tables, self.pairs, strict=True):
            z += table[self._coarse(b[:, i], i), self._coarse(b[:, j], j)]
        return sigmoid(z)


@dataclass
class Constant:
    """What is left to say without labels of both classes."""

    value: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.value)


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> Gam | Constant:
    """Fits on at most ``sample`` labelled documents that are not held out; their features, 16 numbers each, go to the driver.

    A doc_id may be labelled, or stand in the documents, many times: the bound holds for the joined rows too.
    """
    chosen = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .select("doc_id", F.col("quality").cast("double").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample)
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t) for t in batch.column(2).to_pylist()], float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *(pa.array(c) for c in x.T)], ["quality", "place", *FEATURES])

    got = (
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most ``sample`` rows of two numbers
        .select("quality", F.xxhash64("doc_id", "text").alias("place"), "text")
        .mapInArrow(rows, "quality double, place long, " + ", ".join(f"{c} double" for c in FEATURES))
        .orderBy("place", "quality").limit(sample).drop("place")
        .toPandas().to_numpy(float)
    )
    if not len(got):
        return Constant(0.5)
    got = got[np.lexsort(got.T[::-1])]  # the order of tasks does not matter
    y = (got[:, 0] > 0.5).astype(float)
    if y.min() == y.max():
        return Constant(float(y[0]))
    return Gam().fit(got[:, 1:], y)


def score(docs: DataFrame, model: Gam | Constant) -> DataFrame:
    """All columns of ``docs`` with ``score`` and ``predicted``."""
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # tables of a fixed size
    at = kept.index("text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t) for t in batch.column(at).to_pylist()], float).reshape(-1, len(FEATURES))
            s = shared.value.score(x)
            added = [pa.array(s, pa.float64()), pa.array((s >= THRESHOLD).astype(np.int32), pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*kept, "score", "predicted"])

    rest = docs.select(*[f"`{c}`" for c in kept])
    schema = T.StructType([*rest.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return rest.mapInArrow(rows, schema)


def quality(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> DataFrame:
    return score(docs, fit(docs, labels, sample))

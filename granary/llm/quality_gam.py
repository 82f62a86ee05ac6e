"""A quality classifier: a generalised additive model with pairwise interactions.

score = logistic(intercept + sum of f_i(x_i) + sum of f_ij(x_i, x_j)); each f is a lookup table over the bins of one
feature or of two. Cyclic boosting learns them: round after round each feature in turn gets a shallow tree (LEAVES
leaves, fitted to the gradients in its bins), a small step of which is added to its table. Then
the pairs whose best tree gains most get tables of their own in the same way. A text is scored by finding its features' bins and adding
table entries, a batch of texts at a time.

Features are counted over the whole text: shares of characters and words, repetition and lengths. The
model is fitted on the driver on a bounded sample: the SAMPLE labelled documents with the smallest hashes.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

#: At most so many labelled documents are learnt from.
SAMPLE = 20_000
ROUNDS, PAIR_ROUNDS, RATE, LEAVES, BINS, PAIR_BINS, PAIRS, RIDGE = 150, 60, 0.1, 4, 32, 8, 8, 4.0
NAMES = ("chars", "words", "word_length", "distinct", "adjacent", "upper", "exclaim", "bar", "symbols", "digits", "stops", "lines", "foreign", "short", "commonest", "brackets")


def _bytes(chars: str) -> np.ndarray:
    return np.frombuffer(chars.encode(), np.uint8)


UPPER, LOWER = np.arange(65, 91), np.arange(97, 123)
SYMBOLS, DIGITS, STOPS, BRACKETS = _bytes("#$%&*@^~=+\\_"), _bytes("0123456789"), _bytes(".,;:?"), _bytes("<>[]{}()")


def features(text: str | None) -> list[float]:
    """One text's features; null counts as empty, whose features are all 0."""
    if not text:
        return [0.0] * len(NAMES)
    raw = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    words = text.split()
    n, w, letters = int(raw.sum()), max(1, len(words)), max(1, int(raw[UPPER].sum() + raw[LOWER].sum()))
    counts = Counter(words)
    return [
        np.log1p(len(text)),
        np.log1p(len(words)),
        n / w,
        len(counts) / w,
        sum(map(operator.eq, words, words[1:])) / w,
        raw[UPPER].sum() / letters,
        raw[33] / w,
        raw[124] / w,
        raw[SYMBOLS].sum() / w,
        raw[DIGITS].sum() / n,
        raw[STOPS].sum() / w,
        raw[10] / w,
        raw[128:].sum() / n,
        sum(c for x, c in counts.items() if len(x) < 4) / w,
        max(counts.values(), default=0) / w,
        raw[BRACKETS].sum() / w,
    ]


@dataclass
class Model:
    """Bin borders and tables; a few kilobytes whatever the corpus."""

    intercept: float
    borders: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)  # of each feature, from bins to the bins of pairs
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1 for rows of features."""
        total = np.full(len(x), self.intercept)
        if self.tables and len(x):
            bins = [np.searchsorted(b, x[:, i], "right") for i, b in enumerate(self.borders)]
            for i, t in enumerate(self.tables):
                total += t[bins[i]]
            for i, j, t in self.pairs:
                total += t[self.coarse[i][bins[i]], self.coarse[j][bins[j]]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _borders(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], method="higher")) if len(x) else np.empty(0)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """A regression tree over ordered bins with sums of gradients and curvatures: each bin's step."""
    gs, hs = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    gain = lambda a, b: (gs[b] - gs[a]) ** 2 / (hs[b] - hs[a] + RIDGE)
    cuts = [0, len(g)]
    for _ in range(leaves - 1):
        best = (1e-9, None)
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b - a > 1:
                m = np.arange(a + 1, b)
                won = gain(a, m) + gain(m, b) - gain(a, b)
                best = max(best, (float(won.max()), int(m[won.argmax()])), key=lambda x: x[0])
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    step = np.empty(len(g))
    for a, b in zip(cuts, cuts[1:], strict=False):
        step[a:b] = (gs[b] - gs[a]) / (hs[b] - hs[a] + RIDGE)
    return step


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best tree that cuts a table of two features once along each: its gain and each cell's step."""
    best, step = 0.0, np.zeros(g.shape)
    gs, hs = np.zeros((g.shape[0] + 1, g.shape[1] + 1)), np.zeros((g.shape[0] + 1, g.shape[1] + 1))
    gs[1:, 1:], hs[1:, 1:] = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    n, m = g.shape
    box = lambda s, a, b, c, d: s[b, d] - s[a, d] - s[b, c] + s[a, c]
    for r in range(1, n):
        for c in range(1, m):
            parts = [(a, b, p, q) for a, b in ((0, r), (r, n)) for p, q in ((0, c), (c, m))]
            won = sum(box(gs, *p) ** 2 / (box(hs, *p) + RIDGE) for p in parts) - gs[n, m] ** 2 / (hs[n, m] + RIDGE)
            if won > best:
                best = won
                for a, b, p, q in parts:
                    step[a:b, p:q] = box(gs, a, b, p, q) / (box(hs, a, b, p, q) + RIDGE)
    return best, step


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """A model of labels 0 and 1. One class alone, or no rows, gives a constant: (ones + 1) / (rows + 1)."""
    ones, n = int(y.sum()), len(y)
    if ones in (0, n):
        p = min((ones + 1) / (n + 1), 1 - 1e-9)
        return Model(float(np.log(p / (1 - p))))
    model = Model(float(np.log(ones / (n - ones))))
    model.borders = [_borders(x[:, i], BINS) for i in range(x.shape[1])]
    bins = [np.searchsorted(b, x[:, i], "right") for i, b in enumerate(model.borders)]
    sizes = [len(b) + 1 for b in model.borders]
    model.tables = [np.zeros(s) for s in sizes]
    model.coarse = [np.minimum(np.arange(s) * PAIR_BINS // s, PAIR_BINS - 1) for s in sizes]
    total = np.full(n, model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for i, b in enumerate(bins):
            g, h = slopes()
            step = RATE * _tree(np.bincount(b, g, sizes[i]), np.bincount(b, h, sizes[i]), LEAVES)
            model.tables[i] += step
            total += step[b]
    wide = [model.coarse[i][b] for i, b in enumerate(bins)]

    def of_pair(i: int, j: int) -> tuple[float, np.ndarray]:
        g, h = slopes()
        cell = wide[i] * PAIR_BINS + wide[j]
        return _quadrants(*(np.bincount(cell, v, PAIR_BINS**2).reshape(PAIR_BINS, PAIR_BINS) for v in (g, h)))

    gains = sorted(((of_pair(i, j)[0], i, j) for i in range(len(bins)) for j in range(i)), reverse=True)[:PAIRS]
    model.pairs = [(i, j, np.zeros((PAIR_BINS, PAIR_BINS))) for _, i, j in gains]
    for _ in range(PAIR_ROUNDS):
        for i, j, t in model.pairs:
            step = RATE * of_pair(i, j)[1]
            t += step
            total += step[wide[i], wide[j]]
    return model


def scorer(model: Model) -> Callable[[Column], Column]:
    """A function of text columns that gives scores."""

    @F.arrow_udf(DoubleType())
    def score(text: pa.Array) -> pa.Array:
        x = np.array([features(t.as_py()) for t in text], float).reshape(-1, len(NAMES))
        return pa.array(model.score(x), pa.float64())

    return score


def held_out(key: Column) -> Column:
    """Rows that are never learnt from: crc32 of the key as text leaves 2 when divided by 4. A null key is none of them."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Model:
    """Learns from at most `sample` labelled documents outside the held-out quarter.

    Labels that a key has twice are averaged, null labels and keys without a document are passed over. Of several documents
    with one key the smallest features count. Null and empty texts have features of 0, very long ones are counted whole.
    Without labels or documents the model is a constant. Other columns are not read.
    """
    k = F.col(f"`{key}`")
    known = labels.where(F.col(label).isNotNull() & k.isNotNull() & ~held_out(k)).groupBy(k.alias("__key")).agg((F.avg(label) >= 0.5).cast("int").alias("__label"))
    chosen = known.orderBy(F.xxhash64("__key"), "__key").limit(sample)

    @F.arrow_udf(ArrayType(DoubleType()))
    def measured(text: pa.Array) -> pa.Array:
        return pa.array([list(map(float, features(t.as_py()))) for t in text], pa.list_(pa.float64()))

    # chosen has `sample` rows at most, so it may be sent to every executor
    found = docs.select(k.alias("__key"), F.col(f"`{text}`").alias("__text")).join(F.broadcast(chosen), "__key")
    rows = found.select("__key", "__label", measured("__text").alias("__x")).groupBy("__key", "__label").agg(F.min("__x").alias("__x")).collect()
    rows.sort(key=lambda r: r["__key"])
    return fit(np.array([r["__x"] for r in rows], float).reshape(-1, len(NAMES)), np.array([r["__label"] for r in rows], float))


def classified(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """docs with held_out, score and predicted (1 if score >= threshold). Columns with these names are replaced.

    Null and empty texts score alike, very long ones are read whole, repeated rows score each by itself; an empty table gives an
    empty result.
    """
    made = ["held_out", "score", "predicted"]
    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in made], scorer(model)(F.col(f"`{text}`")).alias("score"))
    return rows.withColumns({"held_out": held_out(F.col(f"`{key}`")), "predicted": (F.col("score") >= threshold).cast("int")})

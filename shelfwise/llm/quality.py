"""Quality classifier: a generalised additive model with pairwise interactions.

Boosting goes round and round the features; each step fits a shallow tree on one feature's bins to the current
residuals and adds a small part of it to that feature's lookup table. Then the same for a few pairs of features on
coarser grids. A text's score is the sum of the table entries of its bins, through the logistic function.

The model is fitted on a bounded sample (``SAMPLE_ROWS`` labelled rows, those with the smallest hash of the id);
features of all texts are computed and scored in Arrow batches where the texts lie, without a shuffle.

Defined cases: null and empty texts have all features 0 and a score like any other; labels that are null, or whose
document is missing, are not used; with labels of one kind only, or none, every text gets the smoothed share.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import bound_batches, text_of, utf8

# Bound of the training sample: labelled rows that are fetched to fit the model.
SAMPLE_ROWS = 20_000

UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
LETTERS = UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
BLANKS = b" \t\n\r\x0b\x0c"
RARE_MARKS = b"#$%&*@^_~|{}[]<>\\=+"
LINK = re.compile(rb"https?://|www\.|@\w+\.")

FEATURES = (
    "log_bytes", "log_words", "word_length", "upper_share", "mark_share", "rare_mark_share", "digit_share",
    "distinct_words", "top_word_share", "repeated_next", "distinct_pairs", "distinct_lines", "line_length",
    "stops_per_word", "marked_words", "links_per_word", "short_words", "capital_words",
)


def features_of(text: bytes) -> list[float]:
    """The features of one whole text, all from counts of bytes, words and lines."""
    words = text.split()
    n, k = len(text), len(words)
    if not k:
        return [0.0] * len(FEATURES)
    seen = Counter(words)
    lines = [line for line in text.split(b"\n") if line]
    marks = len(text.translate(None, LETTERS + DIGITS + BLANKS))
    return [
        np.log1p(n), np.log1p(k), sum(map(len, words)) / k,
        (n - len(text.translate(None, UPPER))) / n, marks / n, (n - len(text.translate(None, RARE_MARKS))) / n,
        (n - len(text.translate(None, DIGITS))) / n,
        len(seen) / k, max(seen.values()) / k,
        sum(map(eq, words, words[1:])) / k, len(set(zip(words, words[1:]))) / max(1, k - 1),
        len(set(lines)) / len(lines), np.log1p(n / len(lines)),
        (text.count(b".") + text.count(b"!") + text.count(b"?")) / k,
        sum(1 for w in words if w[-1] < 48) / k, len(LINK.findall(text)) / k,
        sum(1 for w in words if len(w) <= 2) / k, sum(1 for w in words if 65 <= w[0] <= 90) / k,
    ]


def feature_matrix(texts: Iterable[bytes]) -> np.ndarray:
    rows = [features_of(t) for t in texts]
    return np.array(rows, dtype=float).reshape(len(rows), len(FEATURES))


@dataclass
class Additive:
    """Lookup tables over bins: one per feature, and one per pair of features."""

    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    grids: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, j], side="right")]
        for a, b, table in self.pairs:
            total += table[np.searchsorted(self.grids[a], x[:, a], side="right"),
                           np.searchsorted(self.grids[b], x[:, b], side="right")]
        return 1.0 / (1.0 + np.exp(-total))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _best_cut(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, int]:
    """Gain and place of the best cut of a run of bins."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - g.sum() ** 2 / (h.sum() + ridge)
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def _tree(g: np.ndarray, h: np.ndarray, ridge: float, depth: int = 2) -> np.ndarray:
    """A shallow tree over ordered bins: its value in every bin."""
    gain, at = _best_cut(g, h, ridge) if depth else (0.0, 0)
    if gain <= 1e-9:
        return np.full(len(g), g.sum() / (h.sum() + ridge))
    return np.concatenate([_tree(g[:at], h[:at], ridge, depth - 1), _tree(g[at:], h[at:], ridge, depth - 1)])


def _quadrants(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """The best cross of one cut on each axis of a grid: its gain and its values."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    tg, th = cg[-1, -1], ch[-1, -1]
    parts_g = [cg, cg[:, -1:] - cg, cg[-1:, :] - cg, tg - cg[:, -1:] - cg[-1:, :] + cg]
    parts_h = [ch, ch[:, -1:] - ch, ch[-1:, :] - ch, th - ch[:, -1:] - ch[-1:, :] + ch]
    gain = sum(a**2 / (np.maximum(b, 0) + ridge) for a, b in zip(parts_g, parts_h))
    i, j = np.unravel_index(np.argmax(gain), gain.shape)
    value = [a[i, j] / (max(b[i, j], 0) + ridge) for a, b in zip(parts_g, parts_h)]
    low, left = np.arange(g.shape[0])[:, None] <= i, np.arange(g.shape[1])[None, :] <= j
    return float(gain[i, j]), np.where(low & left, value[0], np.where(
        low, value[1], np.where(left, value[2], value[3])))


def fit(
    x: np.ndarray, y: np.ndarray, rounds: int = 120, pair_rounds: int = 40, rate: float = 0.1, bins: int = 48,
    grid: int = 12, n_pairs: int = 6, ridge: float = 4.0,
) -> Additive:
    """Fit the tables to features ``x`` and labels ``y`` of 0 and 1; the same rows give the same model."""
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    model = Additive(base=float(np.log(share / (1 - share))))
    if len(y) == 0 or y.min() == y.max():
        return model
    total = np.full(len(y), model.base)
    model.edges = [_edges(c, bins) for c in x.T]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    places = [np.searchsorted(e, c, side="right") for e, c in zip(model.edges, x.T)]

    def residuals() -> tuple[np.ndarray, np.ndarray]:
        p = 1.0 / (1.0 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for at, table in zip(places, model.tables):
            r, w = residuals()
            step = rate * _tree(np.bincount(at, r, len(table)), np.bincount(at, w, len(table)), ridge)
            table += step
            total += step[at]

    model.grids = [_edges(c, grid) for c in x.T]
    coarse = [np.searchsorted(e, c, side="right") for e, c in zip(model.grids, x.T)]

    def histograms(a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        r, w = residuals()
        shape = len(model.grids[a]) + 1, len(model.grids[b]) + 1
        flat = coarse[a] * shape[1] + coarse[b]
        return (np.bincount(flat, r, shape[0] * shape[1]).reshape(shape),
                np.bincount(flat, w, shape[0] * shape[1]).reshape(shape), flat)

    gains = sorted(((_quadrants(*histograms(a, b)[:2], ridge)[0], a, b)
                    for a, b in combinations(range(x.shape[1]), 2)), reverse=True)
    model.pairs = [(a, b, np.zeros((len(model.grids[a]) + 1, len(model.grids[b]) + 1))) for _, a, b in gains[:n_pairs]]
    for _ in range(pair_rounds):
        for a, b, table in model.pairs:
            g, h, flat = histograms(a, b)
            step = rate * _quadrants(g, h, ridge)[1]
            table += step
            total += step.ravel()[flat]
    return model


def features(text: Column | str) -> Column:
    """The features of a text column as an array."""
    @F.arrow_udf("array<double>")
    def compute(texts: pa.Array) -> pa.Array:
        return pa.array(feature_matrix(utf8(texts)).tolist(), pa.list_(pa.float64()))

    return compute(text_of(text))


def train(
    docs: DataFrame, labels: DataFrame, usable: Column, doc_id: str = "doc_id", text: str = "text",
    label: str = "quality", sample_rows: int = SAMPLE_ROWS,
) -> Additive:
    """Fit on the labelled rows for which ``usable`` (a condition on ``doc_id`` of the labels) holds.

    At most ``sample_rows`` labels are used, those with the smallest hash of their id, so the joined side and the
    fetched rows are bounded by that number.
    """
    bound_batches(docs.sparkSession)
    chosen = (
        labels.filter(usable & F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("_labelled"))
        .agg(F.max(label).alias("_label"))
        .orderBy(F.xxhash64("_labelled"), "_labelled").limit(sample_rows)
    )
    sample = (
        docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
        .join(F.broadcast(chosen), F.col("_id") == F.col("_labelled"))
        .select("_id", "_label", features("_text").alias("_features"))
        .groupBy("_id", "_label").agg(F.min("_features").alias("_features"))
    )
    rows = sorted(sample.collect())
    x = np.array([r["_features"] for r in rows], dtype=float).reshape(len(rows), len(FEATURES))
    return fit(x, np.array([r["_label"] for r in rows], dtype=float))


def score(model: Additive, text: Column | str) -> Column:
    """Probability of label 1 for every text."""
    @F.arrow_udf("double")
    def compute(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(feature_matrix(utf8(texts))))

    return compute(text_of(text))


def keep_good(
    docs: DataFrame, model: Additive, text: str = "text", threshold: float = 0.3,
) -> DataFrame:
    """The rows whose text scores at least ``threshold``, columns unchanged."""
    return docs.filter(score(model, text) >= threshold)

"""Quality: histogram gradient-boosted trees over document statistics.

The statistics are of the whole text and of nothing else. Training bins each
statistic by quantiles once and then works on counts of gradients by bin. The
trees are kept flattened, as arrays of features, thresholds, children and
values; a batch of documents walks all trees at once, a level at a time.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._learning import labelled, sampled_labels
from ._shared import free_name

STATISTICS = [
    "log_chars", "log_words", "word_length", "longest_word", "distinct_words", "top_word", "adjacent_repeats",
    "caps_words", "title_words", "symbol_ends", "symbols", "bars", "exclamations", "commas", "stops", "digits",
    "breaks", "line_length", "repeated_lines", "non_ascii", "once_words", "unusual_spaces",
]
SYMBOLS = "#%&*$@^~=_<>{}[]\\"


def statistics(text: str | None) -> list[float]:
    """The statistics of a text, in the order of STATISTICS; all zero but the ratios' neutral values when it is empty (or null)."""
    text = text or ""
    n = max(len(text), 1)
    words = text.split()
    m = max(len(words), 1)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    k = max(len(lines), 1)
    repeats = sum(map(str.__eq__, words, words[1:]))
    return [
        float(np.log1p(len(text))),
        float(np.log1p(len(words))),
        sum(map(len, words)) / m,
        float(max(map(len, counts), default=0)),
        len(counts) / m,
        max(counts.values(), default=0) / m,
        repeats / m,
        sum(map(str.isupper, words)) / m,
        sum(map(str.istitle, words)) / m,
        sum(w[-1] in SYMBOLS for w in words) / m,
        sum(map(text.count, SYMBOLS)) / n,
        text.count("|") / m,
        text.count("!") / m,
        text.count(",") / m,
        text.count(".") / m,
        sum(map(text.count, "0123456789")) / n,
        text.count("\n") / m,
        len(text) / k,
        1 - len(set(lines)) / k if lines else 0.0,
        (len(text.encode("utf-8", "surrogatepass")) - len(text)) / n,
        sum(v == 1 for v in counts.values()) / m,
        (text.count("  ") + text.count("\t")) / m,
    ]


@dataclass
class Trees:
    """All trees in one set of arrays; a leaf is its own child."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def scores(self, x: np.ndarray, block: int = 4096) -> np.ndarray:
        out = np.empty(len(x))
        for i in range(0, len(x), block):
            part = x[i : i + block]
            node = np.repeat(self.roots[None, :], len(part), axis=0)
            rows = np.arange(len(part))[:, None]
            for _ in range(self.depth):
                node = np.where(part[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            out[i : i + block] = self.base + self.value[node].sum(1)
        return 1 / (1 + np.exp(-np.clip(out, -60, 60)))


def boost(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, least: int = 3, ridge: float = 1.0) -> Trees:
    """Logistic boosting on binned columns; without both classes a constant, the labels' mean (1 without any)."""
    p = float(np.clip(y.mean() if len(y) else 1.0, 1e-4, 1 - 1e-4))
    base = float(np.log(p / (1 - p)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def leaf(v: float) -> int:
        i = len(value)
        feature.append(0), threshold.append(np.inf), left.append(i), right.append(i), value.append(v)
        return i

    if len(y) and y.min() != y.max():
        columns = x.shape[1]
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(columns)]
        binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
        shift = np.arange(columns) * bins
        f = np.full(len(y), base)

        def grow(rows: np.ndarray, level: int, g: np.ndarray, h: np.ndarray) -> int:
            total_g, total_h = g[rows].sum(), h[rows].sum()
            i = leaf(-rate * total_g / (total_h + ridge))
            if level == depth or len(rows) < 2 * least:
                f[rows] += value[i]
                return i
            flat = (binned[rows] + shift).ravel()
            by_g = np.bincount(flat, np.repeat(g[rows], columns), columns * bins).reshape(columns, bins).cumsum(1)
            by_h = np.bincount(flat, np.repeat(h[rows], columns), columns * bins).reshape(columns, bins).cumsum(1)
            by_n = np.bincount(flat, minlength=columns * bins).reshape(columns, bins).cumsum(1)
            gain = by_g**2 / (by_h + ridge) + (total_g - by_g) ** 2 / (total_h - by_h + ridge) - total_g**2 / (total_h + ridge)
            gain[(by_n < least) | (len(rows) - by_n < least)] = -1
            j, b = np.unravel_index(np.argmax(gain), gain.shape)
            if gain[j, b] <= 1e-6:
                f[rows] += value[i]
                return i
            low = binned[rows, j] <= b
            feature[i], threshold[i] = int(j), float(edges[j][b])
            left[i] = grow(rows[low], level + 1, g, h)
            right[i] = grow(rows[~low], level + 1, g, h)
            return i

        for _ in range(trees):
            prob = 1 / (1 + np.exp(-f))
            roots.append(grow(np.arange(len(y)), 0, prob - y, np.maximum(prob * (1 - prob), 1e-6)))
    else:
        roots.append(leaf(0.0))
    return Trees(np.array(roots), np.array(feature, np.int64), np.array(threshold), np.array(left), np.array(right), np.array(value), depth, base)


def _statistics_udf():
    @F.arrow_udf("array<double>")
    def measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([statistics(t.as_py()) for t in texts], pa.list_(pa.float64()))

    return measured


def fit(docs: DataFrame, labels: DataFrame, fold: int = 5, left_out: int = 0, max_per_class: int = 4000, id_col: str = "doc_id", text_col: str = "text", label: str = "quality") -> Trees:
    """Learns from a sample of at most about max_per_class labelled documents of each class, measured whole."""
    sample = sampled_labels(labels, label, fold, left_out, max_per_class, id_col=id_col)
    chosen = labelled(docs, sample, text_col, id_col)
    rows = sorted((r["label"], tuple(r["x"])) for r in chosen.select("label", _statistics_udf()("text").alias("x")).collect())
    x = np.array([r[1] for r in rows]).reshape(len(rows), len(STATISTICS))
    return boost(x, np.array([r[0] for r in rows], np.float64))


def scored(docs: DataFrame, model: Trees, text_col: str = "text", out: str = "score") -> DataFrame:
    """docs with the score of each whole text (null: empty) as the column out, which replaces one of that name."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            x = np.array([statistics(t.as_py()) for t in texts]).reshape(len(texts), len(STATISTICS))
            yield pa.array(shared.value.scores(x), pa.float64())

    return docs.withColumn(out, score(F.col(text_col).cast("string")))


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, fold: int = 5, left_out: int = 0, max_per_class: int = 4000) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of docs.

    A null text counts as empty; a null id has held_out null; repeated rows
    stay. An empty table gives an empty result; without usable labels of both
    classes every score is the labels' mean (about 1 without any label).
    """
    rows = scored(docs.select("doc_id", "text"), fit(docs, labels, fold, left_out, max_per_class))
    held = F.crc32(F.col("doc_id").cast("string")) % fold == left_out
    return rows.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, fold: int = 5, left_out: int = 0, max_per_class: int = 4000) -> DataFrame:
    """The rows of docs that score threshold or more, with docs' columns, whatever their names.

    A null text counts as empty and is scored so; repeated rows are scored
    alike; rows without an id are scored too. An empty table gives an empty result.
    """
    model, name = fit(docs, labels, fold, left_out, max_per_class), free_name(docs, "score")
    return scored(docs, model, out=name).where(F.col(name) >= threshold).select(*docs.columns)

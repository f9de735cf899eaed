"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting goes round the features; each visit fits one shallow tree to the gradient
over that feature's bins and adds it to the feature's lookup table. Pairs follow in the same
way over a coarse grid. A score is then a sum of table entries, looked up for whole batches.

Fitting takes a bounded sample (`FIT_ROWS`); scoring covers every row. Defined results: a null
text scores as the empty text; texts of any length are measured whole; without any labelled row
every score is 0.5, with labels of one class only the smoothed share of label 1; repeated rows get
equal scores; a labelled doc_id with several texts is fitted to once, by the text with the smallest
hash; an empty table gives an empty result; only doc_id, text and the label are read, whatever
other columns there are.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.features import TextView
from corpusloom.llm.shared import labelled_sample

#: Labelled documents that a model is fitted to, at most.
FIT_ROWS = 12_000

FEATURES = (
    "log_words", "symbols", "upper", "letters", "dup_lines", "repeats", "word_length",
    "distinct", "ends", "digits", "line_words",
)


def features(view: TextView) -> tuple[float, ...]:
    n = view.n_words
    return (
        float(np.log1p(n)),
        view.share(view.n_symbols, n),
        view.share(view.n_upper, view.n_letters),
        view.share(view.n_letters, view.word_chars),
        view.share(view.n_dup_lines, len(view.lines)),
        view.share(view.n_repeat_words, n),
        view.share(view.word_chars, n),
        view.share(view.distinct_words, n),
        view.share(view.word_ends, n),
        view.share(view.n_digits, view.word_chars),
        view.share(n, len(view.lines)),
    )


def feature_matrix(texts: list[str | None]) -> np.ndarray:
    rows = [features(TextView(t)) for t in texts]
    return np.array(rows, dtype=np.float64).reshape(len(rows), len(FEATURES))


@dataclass(frozen=True)
class Gam:
    """Cut points per feature, one table per feature, and one table per chosen pair."""

    intercept: float
    cuts: tuple[np.ndarray, ...]
    tables: tuple[np.ndarray, ...]
    coarse: tuple[np.ndarray, ...]
    pairs: tuple[tuple[int, int, np.ndarray], ...]

    def margins(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for f, (cuts, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            total += table[np.searchsorted(cuts, x[:, f], side="right")]
        for a, b, table in self.pairs:
            left = np.searchsorted(self.coarse[a], x[:, a], side="right")
            total += table[left, np.searchsorted(self.coarse[b], x[:, b], side="right")]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margins(x), -30, 30)))


def _cut_points(values: np.ndarray, bins: int) -> np.ndarray:
    """Cuts between distinct values, near the quantiles."""
    marks = np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)))
    return (marks[1:] + marks[:-1]) / 2


def _best_cut(gradient: np.ndarray, weight: np.ndarray, ridge: float) -> tuple[float, int]:
    """Gain and place of the best cut between neighbouring bins; place 0 is no cut."""
    if len(gradient) < 2:
        return 0.0, 0
    g, h = np.cumsum(gradient), np.cumsum(weight)
    left, right = g[:-1] ** 2 / (h[:-1] + ridge), (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + ridge)
    gain = left + right - g[-1] ** 2 / (h[-1] + ridge)
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def shallow_tree(
    gradient: np.ndarray, weight: np.ndarray, leaves: int = 4, ridge: float = 1.0
) -> np.ndarray:
    """A tree of a few leaves over ordered bins: the value of every bin."""
    parts = [(0, len(gradient))]
    while len(parts) < leaves:
        found = [(*_best_cut(gradient[a:b], weight[a:b], ridge), a, b) for a, b in parts]
        gain, at, a, b = max(found)
        if gain <= 1e-9 or at == 0:
            break
        parts.remove((a, b))
        parts += [(a, a + at), (a + at, b)]
    out = np.zeros(len(gradient))
    for a, b in parts:
        out[a:b] = gradient[a:b].sum() / (weight[a:b].sum() + ridge)
    return out


def _grid_tree(gradient: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """A tree of depth two on a grid: one cut over the rows, then one over either side.

    The first cut is the one whose two second cuts gain most, so that pairs are found which
    neither feature shows alone.
    """
    rows_g, rows_h = np.cumsum(gradient, axis=0), np.cumsum(weight, axis=0)

    def halves(at: int) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        top_g, top_h = rows_g[at - 1], rows_h[at - 1]
        return [
            (0, at, top_g, top_h),
            (at, len(gradient), rows_g[-1] - top_g, rows_h[-1] - top_h),
        ]

    def worth(at: int) -> float:
        return sum(
            _best_cut(g, h, ridge)[0] + g.sum() ** 2 / (h.sum() + ridge) for _, _, g, h in halves(at)
        )

    out = np.zeros_like(gradient)
    if len(gradient) < 2:
        return out + shallow_tree(rows_g[-1], rows_h[-1], 2, ridge)
    for a, b, g, h in halves(max(range(1, len(gradient)), key=worth)):
        out[a:b] = shallow_tree(g, h, 2, ridge)
    return out


def fit_gam(
    x: np.ndarray,
    y: np.ndarray,
    rounds: int = 40,
    rate: float = 0.25,
    bins: int = 48,
    grid: int = 8,
    n_pairs: int = 4,
    pair_rounds: int = 15,
) -> Gam:
    """Fit by cyclic boosting on the log loss."""
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    intercept = float(np.log(share / (1 - share)))
    n_features = x.shape[1]
    if len(y) == 0 or y.min() == y.max():
        none = tuple(np.zeros(0) for _ in range(n_features))
        return Gam(intercept, none, tuple(np.zeros(1) for _ in none), none, ())
    cuts = tuple(_cut_points(x[:, f], bins) for f in range(n_features))
    coarse = tuple(_cut_points(x[:, f], grid) for f in range(n_features))
    binned = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(cuts)]
    squares = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(coarse)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    margin = np.full(len(y), intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1.0 / (1.0 + np.exp(-margin))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for f in range(n_features):
            g, h = slopes()
            size = len(tables[f])
            step = rate * shallow_tree(
                np.bincount(binned[f], g, size), np.bincount(binned[f], h, size)
            )
            tables[f] += step
            margin += step[binned[f]]

    def on_grid(a: int, b: int, values: np.ndarray) -> np.ndarray:
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        flat = squares[a] * shape[1] + squares[b]
        return np.bincount(flat, values, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    gains = []
    for a, b in combinations(range(n_features), 2):
        up, down = on_grid(a, b, g), on_grid(a, b, h)
        gains.append((float((up**2 / (down + 1.0)).sum()), a, b))
    pairs = {(a, b): np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1))
             for _, a, b in sorted(gains, reverse=True)[:n_pairs]}
    for _ in range(pair_rounds):
        for (a, b), table in pairs.items():
            g, h = slopes()
            step = rate * _grid_tree(on_grid(a, b, g), on_grid(a, b, h))
            table += step
            margin += step[squares[a], squares[b]]
    return Gam(intercept, cuts, tuple(tables), coarse, tuple((a, b, t) for (a, b), t in pairs.items()))


def train_quality(
    documents: DataFrame, labels: DataFrame, limit: int = FIT_ROWS, label: str = "quality"
) -> Gam:
    """Fit to the labelled training documents; measures are taken where the texts are."""

    @F.arrow_udf("array<double>")
    def measure(texts: pa.Array) -> pa.Array:
        return pa.array(list(feature_matrix(texts.to_pylist())), pa.list_(pa.float64()))

    rows = (
        labelled_sample(documents, labels, label, limit)
        .select("doc_id", "label", measure("text").alias("x"))
        .collect()
    )
    rows.sort(key=lambda r: (r["doc_id"], r["x"]))
    x = np.array([r["x"] for r in rows], dtype=np.float64).reshape(len(rows), len(FEATURES))
    return fit_gam(x, np.array([r["label"] for r in rows], dtype=np.float64))


def quality_score(text: Column, model: Gam) -> Column:
    """The probability of label 1, a double between 0 and 1."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(feature_matrix(texts.to_pylist())), pa.float64())

    return score(text)


def classifier_filter(docs: DataFrame, model: Gam, threshold: float = 0.5) -> DataFrame:
    """The rows that score at least the threshold, with all their columns."""
    return docs.filter(quality_score(F.col("text"), model) >= threshold)

"""Quality by a generalised additive model with pairwise interactions.

Features are cut into bins.  Training goes round the features; each time a
shallow tree on one feature's bins is fitted to the gradient of the log loss
and a small share of it is added to that feature's table.  Then the pairs whose
interaction would help most get tables of their own in the same way.  A score
is a sum of table entries, looked up for all rows at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from foliospark.llm.common import binary_values, give_back, stored
from foliospark.llm.statistics import FEATURES, describe, described, held_out, sampled_rows, training_rows

#: Most labelled rows a model is fitted on.
SAMPLE = 20_000
LIMIT = 0.7
BINS, PAIR_BINS, ROUNDS, PAIRS, RATE, DEPTH = 48, 12, 120, 8, 0.1, 2


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(edges)], axis=1)


def _tree(gradient: np.ndarray, weight: np.ndarray, depth: int) -> np.ndarray:
    """Leaf values per bin of a tree that cuts the ordered bins by the largest gain."""
    total = gradient.sum() / (weight.sum() + 1.0)
    if depth == 0 or len(gradient) < 2:
        return np.full(len(gradient), total)
    g, w = np.cumsum(gradient)[:-1], np.cumsum(weight)[:-1]
    gain = g**2 / (w + 1.0) + (gradient.sum() - g) ** 2 / (weight.sum() - w + 1.0)
    at = int(np.argmax(gain)) + 1
    return np.concatenate([_tree(gradient[:at], weight[:at], depth - 1), _tree(gradient[at:], weight[at:], depth - 1)])


def _tree2(gradient: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Leaf values per cell of the best cut of the rows and a cut of the columns on either side; and its gain."""
    best, out = -1.0, np.zeros_like(gradient)
    for at in range(1, gradient.shape[0]):
        value, gain = np.empty_like(gradient), 0.0
        for part in (slice(0, at), slice(at, None)):
            g, w = gradient[part].sum(axis=0), weight[part].sum(axis=0)
            leaf = _tree(g, w, 1)
            value[part] = leaf
            gain += float((leaf * g).sum())
        if gain > best:
            best, out = gain, value
    return out, best


@dataclass
class AdditiveModel:
    """Bin edges, one table per feature and per pair, and the intercept."""

    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)
    base: float = 0.0

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> AdditiveModel:
        """Without rows, or with one label only, every score is that share of ones (0.5 without rows)."""
        width = x.shape[1]
        share = (y.sum() + 1.0) / (len(y) + 2.0)
        base = float(np.log(share / (1 - share)))
        if not len(y) or y.min() == y.max():
            return cls([np.zeros(0)] * width, [np.zeros(0)] * width, [np.zeros(1)] * width, base=base)
        model = cls([_edges(x[:, k], BINS) for k in range(width)], [_edges(x[:, k], PAIR_BINS) for k in range(width)], [], base=base)
        model.tables = [np.zeros(len(e) + 1) for e in model.edges]
        fine, rough = _binned(x, model.edges), _binned(x, model.coarse)
        score = np.full(len(y), base)

        def slopes() -> tuple[np.ndarray, np.ndarray]:
            p = 1 / (1 + np.exp(-score))
            return y - p, np.maximum(p * (1 - p), 1e-6)

        for _ in range(ROUNDS):
            for k, table in enumerate(model.tables):
                g, w = slopes()
                step = RATE * _tree(np.bincount(fine[:, k], g, len(table)), np.bincount(fine[:, k], w, len(table)), DEPTH)
                table += step
                score += step[fine[:, k]]

        def cells(a: int, b: int) -> tuple[tuple[int, int], np.ndarray]:
            shape = len(model.coarse[a]) + 1, len(model.coarse[b]) + 1
            return shape, rough[:, a] * shape[1] + rough[:, b]

        def fitted(a: int, b: int) -> tuple[np.ndarray, float]:
            shape, cell = cells(a, b)
            g, w = slopes()
            size = shape[0] * shape[1]
            return _tree2(np.bincount(cell, g, size).reshape(shape), np.bincount(cell, w, size).reshape(shape))

        ranked = sorted(combinations(range(width), 2), key=lambda p: -fitted(*p)[1])
        model.pairs = ranked[:PAIRS]
        model.pair_tables = [np.zeros(cells(*p)[0]) for p in model.pairs]
        for _ in range(ROUNDS // 2):
            for p, table in zip(model.pairs, model.pair_tables):
                step = RATE * fitted(*p)[0]
                table += step
                score += step.ravel()[cells(*p)[1]]
        return model

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1."""
        fine, rough = _binned(x, self.edges), _binned(x, self.coarse)
        total = np.full(len(x), self.base)
        for k, table in enumerate(self.tables):
            total += table[fine[:, k]]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[rough[:, a], rough[:, b]]
        return 1 / (1 + np.exp(-total))


def _features(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float32).reshape(-1, len(FEATURES))


def scored(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, limit: float = LIMIT) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``documents (doc_id, text)``.

    The model learns from at most ``sample`` rows of ``labels (doc_id, quality)``
    that are not held out.  A null text is empty; an empty text has a score like
    any other; a null id is not held out and has no label; equal texts have
    equal scores; texts count whole; other columns are not read; without labels
    every score is 0.5; an empty table gives an empty result.
    """
    stats = stored(described(documents).select("doc_id", "features"), "features")
    model = AdditiveModel.fit(*training_rows(stats, labels, sample))
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = model.score(_features(batch.column("features")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= limit).astype(np.int32))], schema=schema)

    return stats.select("doc_id", held_out().alias("held_out"), "features").mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int")


def accepted(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, limit: float = LIMIT) -> DataFrame:
    """The rows of ``documents``, all columns, that the model takes for label 1.

    Each row is judged by its own text, also if its id is null or repeated; a
    null text is judged as an empty one; equal rows share their fate; texts count
    whole; columns may have any names.  Without labels every score is 0.5 and
    nothing stays at the limit set here; an empty table gives an empty result.
    Texts are judged where they are read, without an exchange.
    """
    model = AdditiveModel.fit(*sampled_rows(documents, labels, sample))

    @F.arrow_udf("boolean")
    def good(text: pa.Array) -> pa.Array:
        features = np.array([describe(t)[1] for t in binary_values(text)], np.float32).reshape(-1, len(FEATURES))
        give_back()
        return pa.array(model.score(features) >= limit)

    return documents.where(good(F.coalesce("text", F.lit("")).cast("binary")))

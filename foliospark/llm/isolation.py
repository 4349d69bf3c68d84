"""Quality rules with an isolation forest on the rules' statistics.

Trees cut random features at random values of a sample of good rows until each
row is alone.  A document that is cut off after few splits is unlike them.  The
mean path length gives an anomaly score; the limit is the one that parts
labelled good and bad rows best.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from foliospark.llm.common import stored
from foliospark.llm.statistics import COUNTS, FEATURES, described, labelled_rows, numbered

#: Rows that ``fitted`` is meant for, the plain form on rows that are at hand; ``judged`` fits on all labelled rows.
SAMPLE = 20_000
TREES, ROWS, DEPTH = 200, 512, 11
LEAST_WORDS, MOST_REPEATED = 50, 50


def _average_path(n: np.ndarray | float) -> np.ndarray:
    """Expected path length of a search among n values that does not find its own."""
    n = np.asarray(n, dtype=np.float64)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


@dataclass
class IsolationForest:
    """Trees as arrays: feature (-1 at a leaf), cut, left and right child, and the path length ending at a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    depth: np.ndarray
    normal: float
    limit: float = 1.0

    @classmethod
    def fit(cls, x: np.ndarray, seed: int = 9, dealt: bool = False) -> IsolationForest:
        """Each tree draws ``ROWS`` of the rows, or takes its own of ``TREES * ROWS`` rows that are ``dealt``."""
        rng = np.random.default_rng(seed)
        rows = min(ROWS, len(x))
        trees = []
        for tree in range(TREES):
            feature, cut, child, depth = [], [], [], []

            def grow(part: np.ndarray, level: int) -> int:
                at = len(feature)
                feature.append(-1)
                cut.append(0.0)
                child.append((at, at))
                depth.append(level + float(_average_path(len(part))))
                low, high = (part.min(axis=0), part.max(axis=0)) if len(part) else (np.zeros(1), np.zeros(1))
                open_ = np.nonzero(high > low)[0]
                if level < DEPTH and len(part) > 1 and len(open_):
                    k = int(rng.choice(open_))
                    feature[at], cut[at] = k, float(rng.uniform(low[k], high[k]))
                    right = part[:, k] > cut[at]
                    child[at] = grow(part[~right], level + 1), grow(part[right], level + 1)
                return at

            grow(x[tree::TREES] if dealt else x[rng.choice(len(x), rows, replace=False)] if rows else x, 0)
            trees.append((feature, cut, child, depth))
        size = max(len(t[0]) for t in trees)

        def padded(k: int, fill) -> np.ndarray:
            return np.array([list(t[k]) + [fill] * (size - len(t[k])) for t in trees])
        return cls(padded(0, -1), padded(1, 0.0), padded(2, (0, 0)), padded(3, 0.0), float(max(_average_path(max(rows, 2)), 1e-9)))

    def score(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1; near 1 for what is cut off early, beyond the range of the sample too."""
        total = np.zeros(len(x))
        every = np.arange(len(x))
        for feature, cut, child, depth in zip(self.feature, self.cut, self.child, self.depth):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                k = feature[node]
                step = (x[every, np.maximum(k, 0)] > cut[node]).astype(np.int64)
                node = child[node, step]  # a leaf is its own child
            total += depth[node]
        return 2.0 ** (-(total / len(self.feature)) / self.normal)

    def calibrate(self, x: np.ndarray, good: np.ndarray) -> None:
        """The limit with the best mean of the shares of good rows kept and bad rows found.

        Without bad rows nothing is rejected beyond what the good rows reach.
        """
        s = self.score(x)
        if good.all():
            self.limit = float(s.max(initial=1.0)) + 1e-9
            return
        order = np.argsort(s, kind="stable")
        kept = np.cumsum(good[order]) / max(good.sum(), 1)
        found = 1 - np.cumsum(~good[order]) / (~good).sum()
        last = np.append(np.diff(s[order]) > 0, True)  # a limit can't part equal scores
        best = int(np.argmax(np.where(last, kept + found, -1)))
        after = s[order][best + 1] if best + 1 < len(s) else s[order][best] + 1e-9
        self.limit = float((s[order][best] + after) / 2)


def fitted(x: np.ndarray, y: np.ndarray) -> IsolationForest:
    """A forest on one half of the good rows, its limit from all others."""
    half = (np.arange(len(y)) % 2 == 0) & (y == 1)
    forest = IsolationForest.fit(x[half] if half.any() else np.zeros((0, len(FEATURES)), np.float32))
    rest = ~half
    forest.calibrate(x[rest], y[rest] == 1)
    return forest


def _features(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float32).reshape(-1, len(FEATURES))


def fitted_on(stats: DataFrame, labels: DataFrame) -> IsolationForest:
    """What ``fitted`` gives, from every labelled row that is not held out.

    A tree takes ``ROWS`` rows by its method, so the forest's rows fit on the
    driver: with more good rows than all trees take, those are drawn from all of
    them.  The limit is found among the scores of all other labelled rows.
    """
    rows = labelled_rows(stats, labels)
    half = (F.col("place") % 2 == 0) & (F.col("quality") == 1)
    good, most = rows.where(half), TREES * ROWS
    dealt = good.count() > most
    order = F.xxhash64("place", F.lit(9)) if dealt else F.col("place")
    x = good.orderBy(order, "place").limit(most).select("features").toArrow().column("features").combine_chunks()
    forest = IsolationForest.fit(_features(x), dealt=dealt)
    forest.limit = _limit(rows.where(~half), forest)
    return forest


def _limit(rows: DataFrame, forest: IsolationForest) -> float:
    """The limit ``calibrate`` sets, from the scores of ``rows (features, quality)``: running counts over ranges of scores."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(forest.score(_features(batch.column("features")))), batch.column("good")], names=["score", "good"])

    scored = rows.select("features", (F.col("quality") == 1).alias("good")).mapInArrow(run, "score double, good boolean")
    each = scored.groupBy("score").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    each = stored(numbered(each, [F.col("score")], "scores"), "scores")
    parts = sorted(each.groupBy("part").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.max("score").alias("high")).collect(), key=lambda r: r.part)
    all_good, all_bad = sum(r.good for r in parts), sum(r.bad for r in parts)
    if not all_bad:
        return max([1.0, *(r.high for r in parts)]) + 1e-9
    before = [(r.part, sum(p.good for p in parts[:k]), sum(p.bad for p in parts[:k])) for k, r in enumerate(parts)]
    offsets = F.broadcast(rows.sparkSession.createDataFrame(before, "part long, more_good long, more_bad long"))
    so_far = Window.partitionBy("part").orderBy("score").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kept = (F.sum("good").over(so_far) + F.col("more_good")) / F.lit(max(all_good, 1))
    found = 1 - (F.sum("bad").over(so_far) + F.col("more_bad")) / F.lit(all_bad)
    gains = each.join(offsets, "part").select("score", (kept + found).alias("gain"))
    best = gains.agg(F.min_by("score", F.struct(-F.col("gain"), "score")).alias("best")).first().best
    after = each.where(F.col("score") > best).agg(F.min("score").alias("after")).first().after
    return (best + (best + 1e-9 if after is None else after)) / 2


def judged(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, anomaly`` per row.

    A row fails the base rules with fewer than 50 words or with more than half of
    its words in 3-word windows found twice; it is kept if it passes them and its
    anomaly is within the limit.  A null text is empty; null ids stay null and
    have no label; equal texts are judged alike; texts count whole; other columns
    are not read; without labels no row is an anomaly; an empty table gives an
    empty result.
    """
    stats = stored(described(documents), "statistics")
    forest = fitted_on(stats, labels)
    names = ["doc_id", *COUNTS]
    schema = pa.schema([*((n, pa.int64()) for n in names), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("anomaly", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _features(batch.column("features"))
            words, repeated = (np.asarray(batch.column(c)) for c in ("n_words", "n_repeat_words"))
            failed = (words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * words)
            anomaly = forest.score(x)
            yield pa.RecordBatch.from_arrays([
                *(batch.column(n) for n in names), pa.array(failed), pa.array(~failed & (anomaly <= forest.limit)), pa.array(anomaly),
            ], schema=schema)

    return stats.mapInArrow(run, ", ".join(f"{n} long" for n in names) + ", base_failed boolean, kept boolean, anomaly double")

"""Ranked lexical search by impact vectors in order of length.

A document is a vector of term impacts, an item one of term weights, and a score
their product.  Only terms of items matter, so vectors are cut to those.
Vectors are stored in order of length, each part of the table a bucket of
similar lengths.  The longest ones are scored first and give every item a score
to beat, its tenth best so far.  Then

1. a bucket is skipped for an item if ``|item| * |longest vector|`` stays below
   that score (Cauchy-Schwarz), and files no item can use are not read;
2. inside a bucket the product is bounded: exact over the item's heaviest
   coordinates, and Cauchy-Schwarz over what both vectors have left;
3. what survives is scored exactly in integers, and raises the score to beat.

Bounds are floating-point numbers with a margin and strict, so that equal scores
are decided by id.  Every task keeps ten documents per item, the rest is a rank.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from foliospark.llm.common import binary_values, stored

TOP = 10
#: Items searched for together, and about how many distinct terms they may have; more items take further passes.
ITEMS, TERMS = 256, 1 << 15
#: Heaviest coordinates of an item that are multiplied before it is bounded.
FOCUS = 16
#: The share of the longest vectors that is scored first.
FIRST = 1 / 64
#: Vectors bounded together, at most.
ROWS = 1024
MARGIN = 1 + 1e-9

# Term bytes are ASCII letters and digits and all bytes of other characters; A-Z are lower-cased.
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TERM).split()


_ITEM = pa.schema([("item", pa.int64()), ("terms", pa.list_(pa.binary()))])


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        terms = [sorted(set(terms_of(t.tobytes()))) for t in binary_values(batch.column("bytes"))]
        yield pa.RecordBatch.from_arrays([batch.column("item"), pa.array(terms, _ITEM.field(1).type)], schema=_ITEM)


_COUNTS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("times", pa.list_(pa.int64()))])
_COUNTS_DDL = "doc_id long, n long, terms array<int>, times array<long>"


def _lists(parts: list[list[int]], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array([x for part in parts for x in part], kind))


def _count_rows(vocabulary: list[bytes]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {term: k for k, term in enumerate(vocabulary)}
        for batch in batches:
            sizes, terms, times = [], [], []
            for text in binary_values(batch.column("bytes")):
                words = terms_of(text.tobytes())
                found = Counter(map(number.get, words))
                found.pop(None, None)
                sizes.append(len(words))
                terms.append(list(found))
                times.append(list(found.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), _lists(terms, pa.int32()), _lists(times, pa.int64())], schema=_COUNTS)
    return run


_VECTOR = pa.schema([("doc_id", pa.int64()), ("length", pa.float64()), ("terms", pa.list_(pa.int32())), ("impacts", pa.list_(pa.int64()))])
_VECTOR_DDL = "doc_id long, length double, terms array<int>, impacts array<long>"


def _vector_rows(n_docs: int, n_terms: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Impacts and their Euclidean length; rows have one term or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            times = batch.column("times")
            ends = np.concatenate([[0], np.cumsum(times.value_lengths().to_numpy())])
            tf = times.flatten().to_numpy()
            m = 10 + 90 * batch.column("n").to_numpy() * n_docs // n_terms
            impact = 1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, np.diff(ends)))
            length = np.sqrt(np.add.reduceat(impact.astype(np.float64) ** 2, ends[:-1]))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(length), batch.column("terms"),
                pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(impact))], schema=_VECTOR)
    return run


@dataclass
class Items:
    """Weights of the items of one pass; terms are numbers below ``n_terms``."""

    n_terms: int
    terms: list[np.ndarray]
    weights: list[np.ndarray]

    def __post_init__(self) -> None:
        self.length = np.array([math.sqrt(float((w.astype(np.float64) ** 2).sum())) for w in self.weights])
        owner = np.repeat(np.arange(len(self.terms)), [len(t) for t in self.terms])
        key = owner * self.n_terms + np.concatenate([*self.terms, np.zeros(0, np.int64)])
        order = np.argsort(key)
        self.key, self.weight = key[order], np.concatenate([*self.weights, np.zeros(0, np.int64)])[order]
        heavy = [np.argsort(-w, kind="stable")[:FOCUS] for w in self.weights]
        rest = [np.delete(w, h).astype(np.float64) for w, h in zip(self.weights, heavy)]
        self.rest = np.array([math.sqrt(float((r ** 2).sum())) for r in rest])
        # The items whose heaviest coordinates hold a term.
        term = np.concatenate([*(t[h] for t, h in zip(self.terms, heavy)), np.zeros(0, np.int64)]).astype(np.int64)
        item = np.repeat(np.arange(len(heavy)), [len(h) for h in heavy])
        weight = np.concatenate([*(w[h] for w, h in zip(self.weights, heavy)), np.zeros(0, np.int64)])
        order = np.argsort(term, kind="stable")
        self.focus_item, self.focus_weight = item[order], weight[order].astype(np.float64)
        self.focus_size = np.bincount(term, minlength=self.n_terms)
        self.focus_first = np.cumsum(self.focus_size) - self.focus_size

    def scores(self, item: np.ndarray, row: np.ndarray, ends: np.ndarray, terms: np.ndarray, impacts: np.ndarray) -> np.ndarray:
        """Exact scores of pairs of an item and a row."""
        out = np.zeros(len(item), np.int64)
        sizes = np.diff(ends)[row]
        step = max(1, 4_000_000 // max(int(sizes.max(initial=1)), 1))
        for a in range(0, len(item), step):
            n = sizes[a:a + step]
            at = np.repeat(ends[:-1][row[a:a + step]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            probe = np.repeat(item[a:a + step], n) * self.n_terms + terms[at]
            place = np.minimum(np.searchsorted(self.key, probe), len(self.key) - 1)
            product = np.where(self.key[place] == probe, self.weight[place] * impacts[at], 0)
            out[a:a + step] = np.add.reduceat(product, np.cumsum(n) - n)
        return out


class _Best:
    """The best documents of each item so far, and the score that a further one must reach."""

    def __init__(self, reach: np.ndarray, top: int):
        self.reach, self.top = reach.astype(np.float64), top
        none = np.zeros(0, np.int64)
        self.held = [(none, none, none) for _ in reach]  # score, whether the id is null, id

    def add(self, item: int, score: np.ndarray, missing: np.ndarray, doc_id: np.ndarray) -> None:
        score, missing, doc_id = (np.concatenate(x) for x in zip(self.held[item], (score, missing, doc_id)))
        order = np.lexsort((doc_id, missing, -score))[:self.top]
        self.held[item] = score[order], missing[order], doc_id[order]
        if len(order) == self.top:
            self.reach[item] = max(self.reach[item], float(score[order[-1]]))


_HIT = pa.schema([("k", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _hit_rows(items: Items, reach: list[int], top: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each task's best documents; ``reach`` are scores that others reached already."""
    def block(best: _Best, doc_id: np.ndarray, missing: np.ndarray, length: np.ndarray,
              ends: np.ndarray, terms: np.ndarray, impacts: np.ndarray) -> None:
        active = items.length * length.max() * MARGIN >= np.maximum(best.reach, 1)
        if not active.any():
            return
        n = len(length)
        row = np.repeat(np.arange(n), np.diff(ends))
        times = items.focus_size[terms]
        at = np.repeat(items.focus_first[terms], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        cell = np.repeat(row, times) * len(active) + items.focus_item[at]
        value = np.repeat(impacts, times).astype(np.float64)
        product = np.bincount(cell, value * items.focus_weight[at], n * len(active)).reshape(n, -1)
        held = np.bincount(cell, value ** 2, n * len(active)).reshape(n, -1)
        left = np.sqrt(np.maximum(length[:, None] ** 2 * MARGIN - held, 0))
        fits = (product + left * items.rest) * MARGIN >= np.maximum(best.reach, 1)
        item, row = np.nonzero((fits & active).T)
        if not len(item):
            return
        score = items.scores(item, row, ends, terms, impacts)
        good = score >= np.maximum(best.reach, 1)[item]
        item, row, score = item[good], row[good], score[good]
        for k in np.unique(item).tolist():
            a, b = np.searchsorted(item, [k, k + 1])
            best.add(k, score[a:b], missing[row[a:b]], doc_id[row[a:b]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(np.array(reach), top)
        size = 64
        for batch in batches:
            if not batch.num_rows:
                continue
            missing = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False).astype(np.int64)
            doc_id = batch.column("doc_id").fill_null(0).to_numpy()
            length = batch.column("length").to_numpy()
            ends = np.concatenate([[0], np.cumsum(batch.column("terms").value_lengths().to_numpy())])
            terms, impacts = (batch.column(c).flatten().to_numpy() for c in ("terms", "impacts"))
            a = 0
            while a < len(length):
                b = min(a + size, len(length))
                block(best, doc_id[a:b], missing[a:b], length[a:b], ends[a:b + 1] - ends[a], terms[ends[a]:ends[b]], impacts[ends[a]:ends[b]])
                a, size = b, min(2 * size, ROWS)
        for k, (score, missing, doc_id) in enumerate(best.held):
            if len(score):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(score), k, np.int32)), pa.array(doc_id, mask=missing.astype(bool)), pa.array(score)], schema=_HIT)
    return run


def _ranked(hits: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("k").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _searched(documents: DataFrame, items: list, top: int) -> DataFrame:
    """``item, rank, doc_id, score`` of some items; their number and that of their terms are bounded."""
    spark = documents.sparkSession
    vocabulary = sorted({term for r in items for term in r.terms})
    number = {term: k for k, term in enumerate(vocabulary)}
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("bytes"))
    counts = stored(texts.mapInArrow(_count_rows([bytes(t) for t in vocabulary]), _COUNTS_DDL), "counts")
    total = counts.agg(F.count_if(F.col("n") > 0).alias("n_docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_terms")).first()
    # One row for each term of the items.
    holders = dict(counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect())
    weight = np.array([math.floor(1000 * math.log((2 * total.n_docs + 2) / (2 * holders.get(k, 0) + 1))) for k in range(len(vocabulary))], np.int64)
    own = [np.array([k for t in r.terms if (k := number[t]) in holders], np.int64) for r in items]
    model = Items(max(len(vocabulary), 1), own, [weight[t] for t in own])
    vectors = counts.where(F.size("terms") > 0).mapInArrow(_vector_rows(total.n_docs, total.n_terms), _VECTOR_DDL)
    # Equal lengths are parted by a row's number, so that copies spread as well.
    ordered = stored(vectors.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(F.desc("length"), "place")
                     .sortWithinPartitions(F.desc("length"), "place").drop("place"), "vectors")
    ddl = "k int, doc_id long, score long"
    cut = ordered.agg(F.percentile_approx("length", 1 - FIRST).alias("cut")).first().cut
    cut = 0.0 if cut is None else cut
    first = stored(_ranked(ordered.where(F.col("length") >= cut).mapInArrow(_hit_rows(model, [0] * len(items), top), ddl), top), "first")
    reach = [0] * len(items)
    for r in first.where(F.col("rank") == top).collect():  # one row for each item
        reach[r.k] = r.score
    # No item can use a vector shorter than this.
    least = min((reach[k] / model.length[k] / MARGIN for k in range(len(items)) if model.length[k]), default=0.0)
    rest = ordered.where((F.col("length") < cut) & (F.col("length") >= least)).mapInArrow(_hit_rows(model, reach, top), ddl)
    found = _ranked(first.select("k", "doc_id", "score").union(rest), top)
    names = spark.createDataFrame([(k, r.item) for k, r in enumerate(items)], "k int, item long")
    return found.join(F.broadcast(names), "k").select("item", "rank", "doc_id", "score")


def search(documents: DataFrame, items: DataFrame, top: int = TOP, most_items: int = ITEMS, most_terms: int = TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: of each row of ``items (item_id, text)`` its ``top`` documents with a score above 0.

    Equal scores rank by ascending id, a null id last; rows that repeat an id or
    a text have ranks of their own.  Every row of ``items`` is an item, so
    repeated ones have equal results; a null id stays null.  A null text has no
    terms: such an item finds nothing and such a document is not found.  Texts
    are read whole; other columns are not read; an empty table on either side
    gives an empty result.  More items than ``most_items``, or with more distinct
    terms than about ``most_terms``, take several passes over ``documents``.
    """
    numbered = stored(items.select(
        F.monotonically_increasing_id().alias("item"), "item_id", F.coalesce("text", F.lit("")).cast("binary").alias("bytes")), "items")
    split = stored(numbered.select("item", "bytes").mapInArrow(_item_rows, "item long, terms array<binary>").where(F.size("terms") > 0), "terms")
    total = split.agg(F.count(F.lit(1)).alias("items"), F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("terms")).first()
    passes = max(1, math.ceil(total["items"] / most_items), math.ceil(total.terms / most_terms))
    found = None
    for k in range(passes):
        mine = split.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == k).orderBy("item").collect()
        part = _searched(documents, mine, top)
        part = stored(part, "hits") if passes > 1 else part
        found = part if found is None else found.union(part)
    return found.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")

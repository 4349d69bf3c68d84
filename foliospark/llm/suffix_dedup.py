"""Repeated byte strings, found by bucket-pointer refinement.

A position's bucket is a hash that names the string starting there.  Buckets of
25-grams are refined to 50, 100 and 200 bytes, each time by the bucket found
at the later offset: the 200-byte bucket at ``i`` is the pair of the 100-byte
buckets at ``i`` and ``i + 100``, and every level is reused by the next.  Two
strings share a name if they are equal (names have 64 bits; a clash of
different strings is as likely as one of two random 64-bit numbers).

Sorting all positions of a corpus by their buckets would shuffle many times its
size: 16 bytes a position and level.  Names are hashes instead of ranks, so a
level is refined inside each text without a sort, and *anchors* stand for the
passes that would order all positions and let those alone in their bucket go: in
each 200-byte window, the 100-gram with the smallest bucket.  Equal windows have
equal anchors, so:

1. ``anchors`` counts the anchors' 100-gram buckets; most occur once and are done.
2. Of the others the bucket of everything around them that a window can reach
   is counted.  If it occurs twice, all windows there are repeated.
3. Only anchors whose surroundings are unique although their 100-gram is not
   (the edges of repeats) have their windows refined one by one: those windows
   of which the anchor is the smallest gram, as it is wherever they stand.

Each count is spread over the keys of the positions, never over documents, and
joins on a frequent bucket are split by Spark at run time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from foliospark.llm.common import Rows, binary_values, mixed, paired, row_key, stored

LENGTH = 200

_U = np.uint64
# A fixed random value per byte, and the multiplier of the first level's hash with its inverse modulo 2^64.
_BYTE = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[_U(1)], np.full(max(n - 1, 0), base, dtype=_U)]))


_FORTH, _BACKWARD = _powers(_BASE, 1 << 16), _powers(_BACK, 1 << 16)


def _first_level(text: np.ndarray, q: int) -> np.ndarray:
    """Buckets of the q-grams of a text of at least ``q`` bytes."""
    parts, block = [], len(_FORTH) - q + 1
    for start in range(0, len(text) - q + 1, block):
        piece = text[start:start + block + q - 1]
        sums = np.zeros(len(piece) + 1, dtype=_U)
        np.cumsum(_BYTE[piece] * _FORTH[:len(piece)], out=sums[1:])
        n = len(piece) - q + 1
        parts.append((sums[q:] - sums[:-q]) * _BACKWARD[:n])
    return mixed(np.concatenate(parts))


def _half_level(text: np.ndarray, length: int) -> np.ndarray:
    """Buckets of half the length, refined from grams of an eighth."""
    bucket, size = _first_level(text, length // 8), length // 8
    while size < length // 2:
        bucket = paired(bucket[:-size], bucket[size:])
        size *= 2
    return bucket


def _sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    span = 1
    out = a
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[:-rest], out[rest:]) if rest else out


class _Anchors:
    """The anchors of some texts laid end to end: positions, half-length buckets, buckets of their surroundings."""

    def __init__(self, texts: list[np.ndarray], length: int):
        self.length, half = length, length // 2
        width = length - half + 1
        sizes = np.array([len(t) for t in texts])
        self.begin = np.cumsum(sizes) - sizes
        whole = np.concatenate(texts)
        self.grams = _half_level(whole, length)
        low = _sliding_min(self.grams, width)  # per window, its smallest gram
        for edge in self.begin[1:].tolist():  # windows over two texts don't count
            low[edge - length + 1:edge] = 0
        pad = np.zeros(width - 1, dtype=_U)
        reach = ~_sliding_min(~np.concatenate([pad, low, pad]), width)  # per gram, the largest minimum of a window with it
        self.at = np.nonzero(self.grams == reach)[0]
        self.text = np.searchsorted(self.begin, self.at, side="right") - 1
        self.low = low
        # First and last start of the windows that hold the gram.
        self.first = np.maximum(self.at - half, self.begin[self.text])
        self.last = np.minimum(self.at, (self.begin + sizes)[self.text] - length)
        shape = ((self.at - self.first).astype(_U) << _U(32)) | (self.last - self.first).astype(_U)
        self.key = paired(paired(self.windows(self.first), self.windows(self.last)), shape)

    def windows(self, at: np.ndarray) -> np.ndarray:
        """Full-length buckets at some positions: the last refinement, made only where it is asked for."""
        return paired(self.grams[at], self.grams[at + self.length // 2])

    def marked(self, keys: list[list[int]]) -> np.ndarray:
        """Which anchors have one of their text's keys."""
        own = np.array([k for part in keys for k in part or ()], dtype=np.int64).view(_U)
        text = np.repeat(np.arange(len(keys)), [len(part or ()) for part in keys])
        return np.isin(_keyed(self.key, self.text), _keyed(own, text))

    def covered(self, here: np.ndarray) -> np.ndarray:
        """The window starts that some anchors reach."""
        depth = np.zeros(len(self.low) + 1, dtype=np.int32)
        np.add.at(depth, self.first[here], 1)
        np.add.at(depth, self.last[here] + 1, -1)
        return np.cumsum(depth)[:-1] > 0

    def owned(self, here: np.ndarray) -> np.ndarray:
        """The starts of the windows whose first smallest gram is one of some anchors; each window has one such."""
        starts = np.nonzero(self.covered(here))[0]
        starts = starts[self.low[starts] > 0]
        owner = np.searchsorted(self.at, starts)
        todo = np.arange(len(starts))
        while len(todo := todo[self.grams[self.at[owner[todo]]] != self.low[starts[todo]]]):
            owner[todo] += 1
        return starts[here[owner]]


def _keyed(key: np.ndarray, text: np.ndarray) -> np.ndarray:
    return paired(key, text.astype(_U))


def _signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], names: list[str], size: int = 1 << 16) -> Iterator[tuple[list, ...]]:
    """Some rows at a time, of about ``size`` bytes of text or one longer text: lists of the columns, then the texts."""
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in names]
        block: list[tuple] = []
        total = 0
        for row in zip(*columns, binary_values(batch.column("bytes"))):
            block.append(row)
            total += len(row[-1])
            if total >= size:
                yield tuple(map(list, zip(*block)))
                block, total = [], 0
        if block:
            yield tuple(map(list, zip(*block)))


_ANCHOR = pa.schema([("gram", pa.int64()), ("around", pa.int64()), ("n", pa.int64()), ("row", pa.int64())])


def _anchor_rows(length: int):
    """One row for each text and bucket of surroundings, with the number of places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = Rows(_ANCHOR)
        for keys, texts in _blocks(batches, ["row"]):
            found = _Anchors(texts, length)
            _, at, n = np.unique(_keyed(found.key, found.text), return_index=True, return_counts=True)
            rows.add(_signed(found.grams[found.at[at]]), _signed(found.key[at]), n, np.array(keys, np.int64)[found.text[at]])
            if rows.full():
                yield rows.take()
        if rows.size:
            yield rows.take()
    return run


_WINDOW = pa.schema([("row", pa.int64()), ("bucket", pa.int64()), ("place", pa.int64())])
# A place is a start in the high half and the length of a span, 0 for a single window, in the low half.
_LOW = (1 << 32) - 1


def _window_rows(length: int):
    """Spans known to repeat and single windows still to be counted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = Rows(_WINDOW)
        for keys, whole, edge, shown, texts in _blocks(batches, ["row", "whole", "open", "shown"]):
            found, row = _Anchors(texts, length), np.array(keys, np.int64)
            at = np.nonzero(found.covered(found.marked(whole)))[0]
            if len(at):
                text = np.searchsorted(found.begin, at, side="right") - 1
                cut = np.nonzero((np.diff(at) > length) | (np.diff(text) > 0))[0]
                begin, text = at[np.r_[0, cut + 1]], text[np.r_[0, cut + 1]]
                span = at[np.r_[cut, len(at) - 1]] + length - begin
                # The bucket of a span is its own, so that it counts with nothing else.
                own = _signed(_keyed(row[text].view(_U), begin - found.begin[text]))
                rows.add(row[text], own, begin - found.begin[text] << 32 | span)
            # What repeats here because of other surroundings counts all the same: elsewhere it may have none that repeat.
            at = found.owned(found.marked(edge) | found.marked(shown))
            text = np.searchsorted(found.begin, at, side="right") - 1
            rows.add(row[text], _signed(found.windows(at)), at - found.begin[text] << 32)
            if rows.full():
                yield rows.take()
        if rows.size:
            yield rows.take()
    return run


def _cut(schema: pa.Schema, length: int, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for places, text in zip(batch.column("places").to_pylist(), binary_values(batch.column("bytes"))):
                keep = text
                runs: list[tuple[int, int]] = []
                if places:
                    for place in sorted(places):
                        a = place >> 32
                        b = a + (place & _LOW or length)
                        if runs and a <= runs[-1][1]:
                            runs[-1] = (runs[-1][0], max(b, runs[-1][1]))
                        else:
                            runs.append((a, b))
                    edges = [0, *(x for r in runs for x in r), len(text)]
                    keep = np.concatenate([text[a:b] for a, b in zip(edges[::2], edges[1::2])])
                raw = keep.tobytes()
                for part, value in zip(out, (len(text), len(text) - len(raw), len(runs), hashlib.sha256(raw).hexdigest(), raw)):
                    part.append(value)
            columns = [batch.column("doc_id"), *(pa.array(p, f.type) for p, f in zip(out, list(schema)[1:]))]
            yield pa.RecordBatch.from_arrays(columns[:len(schema)], schema=schema)
    return run


def repeated_windows(keyed: DataFrame, length: int = LENGTH) -> DataFrame:
    """``row, places`` of the rows ``row, bytes``: repeated windows and runs of them."""
    texts = keyed.where(F.length("bytes") >= length)
    anchors = texts.mapInArrow(_anchor_rows(length), "gram long, around long, n long, row long")
    grams = stored(
        anchors.groupBy("gram").agg(
            F.sum("n").alias("times"), (F.min("around") != F.max("around")).alias("edge"),
        ).where("times > 1").select("gram", "edge"), "grams",
    )
    # Only anchors whose gram repeats go on.
    hits = stored(anchors.join(grams, "gram").select("around", "n", "row", "edge"), "hits")
    around = hits.groupBy("around").agg(F.sum("n").alias("times"), F.min("row").alias("one"))
    marks = hits.join(around, "around").select(
        "row", "around",
        (F.col("times") > 1).alias("whole"),
        # One row stands for all that have these surroundings when single windows are compared.
        (F.col("edge") & (F.col("times") > 1) & (F.col("row") == F.col("one"))).alias("shown"),
    )
    # A row's anchors are bounded by its own length.
    by_row = stored(marks.groupBy("row").agg(
        F.collect_set(F.when(F.col("whole"), F.col("around"))).alias("whole"),
        F.collect_set(F.when(~F.col("whole"), F.col("around"))).alias("open"),
        F.collect_set(F.when(F.col("shown"), F.col("around"))).alias("shown"),
    ), "marks")
    windows = texts.join(by_row, "row").select("row", "bytes", "whole", "open", "shown").mapInArrow(
        _window_rows(length), "row long, bucket long, place long")
    counted = windows.selectExpr("row", "place", "count(1) over (partition by bucket) as times")
    return counted.where(f"place & {_LOW}L > 0 or times > 1").groupBy("row").agg(F.collect_set("place").alias("places"))


def remove_repeats(documents: DataFrame, length: int = LENGTH, keep_text: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` (and ``kept`` bytes) per row of ``documents``.

    Every byte covered by a ``length``-byte string that also starts anywhere
    else goes.  ``length`` is a multiple of 8.  A null text is empty; texts below
    the length stay whole; equal rows count as two places and both get a
    result; null ids are kept; other columns are not read; an empty table gives
    an empty result.
    """
    if length % 8:
        raise ValueError("the length must be a multiple of 8")
    keyed = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", row_key("doc_id", "text").alias("row"), F.col("text").cast("binary").alias("bytes")
    )
    found = stored(repeated_windows(keyed.select("row", "bytes"), length), "repeats")
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
        ("kept_sha256", pa.string()), *([("kept", pa.binary())] if keep_text else []),
    ])
    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_text
    return keyed.join(found, "row", "left").select("doc_id", "bytes", "places").mapInArrow(
        _cut(schema, length, keep_text), ddl
    )

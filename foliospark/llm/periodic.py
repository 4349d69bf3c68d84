"""Runs of repeated words, found by difference-cover extensions on a harmonic grid.

``Extensions`` answers how far two places of a word sequence agree.  Only the
suffixes at places whose residue modulo 13 lies in a difference cover are sorted
(4 of 13): tuples of 13 words get names in order, and names are doubled until
all differ.  For any two places some shift below 13 takes both into the cover;
the few words up to there are compared, and from there on the answer is the
least of the neighbouring agreements between two ranks, read from a sparse table.

A run of period ``p`` and length ``3 * p`` or more holds two neighbours of the
grid ``0, p, 2p, ..``, so all runs come from the ``n/1 + n/2 + ..`` pairs of
neighbours: extending a pair both ways gives the stretch around it.  A pair that
starts a run agrees on nine words at least; those that don't go before any
suffix is sorted, and documents without such a pair cost no more than that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from foliospark.llm.common import binary_values

LEAST, TIMES = 24, 3
#: Words that the first pair of a run agrees on: the least of ``max(LEAST, TIMES * p) - 2 * p + 1`` over all periods.
AGREE = min(max(LEAST, TIMES * p) - 2 * p + 1 for p in range(1, LEAST + 1))
#: A difference cover: every number below 13 is a difference of two of these modulo 13.
COVER, MODULUS = (0, 1, 3, 9), 13
#: Words looked at together, and pairs of the grid made at a time.
BLOCK, PAIRS = 1 << 16, 1 << 20

_CLASS = np.full(MODULUS, -1)
_CLASS[list(COVER)] = np.arange(len(COVER))
#: For each difference, the residue in the cover from which it leads into the cover.
_FROM = np.array([next(a for a in COVER if (a + d) % MODULUS in COVER) for d in range(MODULUS)])


class Extensions:
    """Longest common extensions of places of a sequence of whole numbers of 0 or more."""

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        self.words = np.concatenate([words, np.full(2 * MODULUS, -1, words.dtype)])
        # The place behind the last word is a suffix too: every class then ends in a name of its own.
        own = [np.arange(r, self.n + 1, MODULUS) for r in COVER]
        self.first = np.concatenate([[0], np.cumsum([len(p) for p in own])[:-1]])
        place = np.concatenate(own)
        levels = [self._named(place)]
        while levels[-1].max() + 1 < len(place):
            levels.append(self._doubled(levels[-1], 1 << len(levels) - 1))
        self.rank = levels[-1]
        order = np.empty(len(place), np.int64)
        order[self.rank] = np.arange(len(place))
        self.table = self._minima(self._neighbours(place, levels, order))

    def _named(self, place: np.ndarray) -> np.ndarray:
        """Names of the tuples at the places, in the order of the tuples."""
        tuples = [self.words[place + k] for k in range(MODULUS)]
        order = np.lexsort(tuples[::-1])
        new = np.zeros(len(place), bool)
        for column in tuples:
            new[1:] |= column[order[1:]] != column[order[:-1]]
        name = np.empty(len(place), np.int64)
        name[order] = np.cumsum(new)
        return name

    @staticmethod
    def _doubled(name: np.ndarray, step: int) -> np.ndarray:
        """Names of strings of twice the length, from the names here and ``step`` names on."""
        later = np.concatenate([name[step:], np.full(min(step, len(name)), -1)]) + 1
        return np.unique(name * (len(name) + 1) + later, return_inverse=True)[1]

    def _neighbours(self, place: np.ndarray, levels: list[np.ndarray], order: np.ndarray) -> np.ndarray:
        """The agreement of each sorted suffix with the next one."""
        a, b = order[:-1].copy(), order[1:].copy()
        for k in range(len(levels) - 1, -1, -1):
            same = levels[k][a] == levels[k][b]
            a[same] += 1 << k
            b[same] += 1 << k
        whole = (a - order[:-1]) * MODULUS
        return whole + self._compared(place[a], place[b], np.full(len(a), MODULUS))

    def _compared(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Agreement of places, word by word and up to ``most`` below the modulus or equal."""
        length = np.zeros(len(i), np.int64)
        todo = np.arange(len(i))
        for k in range(MODULUS):
            todo = todo[most[todo] > k]
            todo = todo[self.words[i[todo] + k] == self.words[j[todo] + k]]
            if not len(todo):
                break
            length[todo] = k + 1
        return length

    @staticmethod
    def _minima(values: np.ndarray) -> list[np.ndarray]:
        """A sparse table: of each place the minima of 1, 2, 4, .. values."""
        table = [values.astype(np.int32)]
        while 2 << len(table) - 1 <= len(values):
            half = 1 << len(table) - 1
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        return table

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words agree from the places ``i`` and ``j`` on, which differ."""
        i, j = np.minimum(i, j), np.maximum(i, j)
        shift = (_FROM[(j - i) % MODULUS] - i) % MODULUS
        length = self._compared(i, j, shift)
        todo = np.nonzero(length == shift)[0]
        x, y = (i + shift)[todo], (j + shift)[todo]
        a, b = (self.rank[self.first[_CLASS[p % MODULUS]] + p // MODULUS] for p in (x, y))
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        for k in np.unique(level).tolist():
            here = level == k
            at = todo[here]
            length[at] += np.minimum(self.table[k][low[here]], self.table[k][high[here] - (1 << k)])
        return length


def _grid(sizes: np.ndarray, begin: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Neighbours ``i, i + p`` of the grids of all documents and periods, as ``i`` and ``p``, some at a time."""
    most = sizes // TIMES
    doc = np.repeat(np.arange(len(sizes)), most)
    period = np.arange(len(doc)) - np.repeat(np.cumsum(most) - most, most) + 1
    times = (sizes[doc] - 1) // period
    edge = np.searchsorted(np.cumsum(times), np.arange(0, times.sum(), PAIRS), side="right")
    for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(doc)]):
        n = times[a:b]
        p = np.repeat(period[a:b], n)
        k = np.arange(len(p)) - np.repeat(np.cumsum(n) - n, n)
        yield np.repeat(begin[doc[a:b]], n) + k * p, p


def _joined(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The sequences end to end, each with a number of its own behind it, and their beginnings."""
    sizes = np.array([len(t) + 1 for t in texts])
    begin = np.cumsum(sizes) - sizes
    top = max((int(t.max()) for t in texts if len(t)), default=0) + 1
    return np.concatenate([x for k, t in enumerate(texts) for x in (t, [top + k])]).astype(np.int64), begin


def runs_of(texts: list[np.ndarray]) -> list[np.ndarray]:
    """The runs of each sequence as rows ``start, length, period`` in order of start and period.

    A run is a stretch with smallest period ``p`` and length ``max(24, 3 * p)`` or
    more that can't be extended.
    """
    empty = np.zeros((0, 3), np.int64)
    out = [empty] * len(texts)
    if not texts:
        return out
    words, begin = _joined(texts)
    sizes = np.array([len(t) for t in texts])
    words = np.concatenate([words, np.full(AGREE, -1)])
    starts, periods = [], []
    for i, p in _grid(sizes, begin):
        for k in range(AGREE):
            same = words[i + k] == words[i + p + k]
            i, p = i[same], p[same]
        starts.append(i)
        periods.append(p)
    if not starts or not sum(map(len, starts)):
        return out
    at, period = np.concatenate(starts), np.concatenate(periods)
    # Only the documents of these pairs are looked at further.
    doc = np.searchsorted(begin, at, side="right") - 1
    some, doc = np.unique(doc, return_inverse=True)
    at -= begin[some[doc]]
    words, begin = _joined([texts[k] for k in some.tolist()])
    at += begin[doc]
    n = len(words)
    forth, back = Extensions(words), Extensions(words[::-1])
    before = back(n - at, n - at - period)
    length = before + period + forth(at, at + period)
    fits = length >= np.maximum(LEAST, TIMES * period)
    start, length, period, doc = (at - before)[fits], length[fits], period[fits], doc[fits]
    # A stretch is found for multiples of its period too: the smallest one counts.
    order = np.lexsort((period, length, start))
    start, length, period, doc = start[order], length[order], period[order], doc[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    order = np.lexsort((period[first], start[first]))
    found = np.stack([start[first] - begin[doc[first]], length[first], period[first]], axis=1)[order]
    owner = doc[first][order]
    cut = np.searchsorted(owner, np.arange(len(some) + 1))
    for k, text in enumerate(some.tolist()):
        out[text] = found[cut[k]:cut[k + 1]]
    return out


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.binary())])
_FOUND_DDL = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"


def _block(ids: list[int | None], texts: list[list[bytes]]) -> pa.RecordBatch:
    number: dict[bytes, int] = {}
    coded = [np.array([number.setdefault(w, len(number)) for w in words], np.int64) for words in texts]
    spans, kept = [], []
    for words, runs in zip(texts, runs_of(coded)):
        spans.append([dict(zip(("start", "length", "period"), run)) for run in runs.tolist()])
        if len(runs):
            depth = np.zeros(len(words) + 1, np.int64)
            np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
            np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
            stays = np.cumsum(depth)[:-1] == 0
            words = [w for w, stay in zip(words, stays.tolist()) if stay]
        kept.append(b" ".join(words))
    columns = [ids, list(map(len, texts)), spans, kept]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FOUND)], schema=_FOUND)


def _run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids: list[int | None] = []
        texts: list[list[bytes]] = []
        size = 0
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), binary_values(batch.column("bytes"))):
            ids.append(doc_id)
            texts.append(text.tobytes().split())  # splits at the six ASCII white spaces
            size += len(texts[-1])
            if size >= BLOCK:
                yield _block(ids, texts)
                ids, texts, size = [], [], 0
        if ids:
            yield _block(ids, texts)


def periodic_runs(documents: DataFrame) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` per row of ``documents (doc_id, text)``.

    Words are what stands between ASCII white space.  ``runs`` are all stretches
    of words with smallest period ``p`` and a length of ``max(24, 3 * p)`` or more
    that can't be extended, as ``start, length, period`` in order of start, then
    period.  ``collapsed`` are the words that no run holds after its first ``p``
    words, joined by one space (binary).  A null text has no words; a null id
    stays null; equal rows have equal results; texts are read whole, each within
    one task, with memory in proportion to its words; other columns are not read;
    an empty table gives an empty result.
    """
    return documents.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("bytes")).mapInArrow(_run_rows, _FOUND_DDL)


def planted(documents: DataFrame) -> DataFrame:
    """``doc_id, text``: in every tenth document (by a hash of its id) the words from some place on repeat.

    With ``h`` the CRC-32 of the written id and ``g = h div 10``, a document of
    ``n`` words with ``h % 10 = 0`` has from ``a = g % n`` on the period
    ``1 + (n - a) div (3 + g % 8)``.  Without an id or words it stays as it is.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = (F.pmod(h, F.lit(10)) == 0) & F.col("doc_id").isNotNull()
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = documents.select(
        "doc_id", "text", F.when(chosen, words).alias("words"), F.floor(h / 10).alias("g"))
    cut = cut.withColumn("n", F.size("words"))
    a = F.when(F.col("n") > 0, F.col("g") % F.col("n"))
    cut = cut.withColumn("a", a.cast("int"))
    cut = cut.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    again = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(
        F.get(F.col("words"), F.col("a") + (i - F.col("a")) % F.col("p"))))
    return cut.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """The runs of ``periodic_runs`` as one row of numbers and digests per document."""
    def better(best, run):
        # Runs come in order, so of equal exponents the first one stays.
        higher = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | higher, run).otherwise(best)

    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    written = F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    best = found.select("*", F.aggregate("runs", none, better).alias("best"))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(written, "").cast("binary"), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

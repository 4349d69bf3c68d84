"""Per-text statistics that quality operators share; one numpy pass over whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from foliospark.llm.common import binary_values, mixed, row_key, small, stored
from foliospark.llm.minhash import word_hashes

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words", "word_length", "symbols", "duplicate_lines", "repeated_words", "capitals", "digits", "marks", "bars",
    "distinct_words", "top_word", "stops", "lines", "ended_lines", "beyond_ascii", "doubled_words", "punctuation",
)
SCHEMA_DDL = "doc_id long, row long, " + ", ".join(f"{c} long" for c in COUNTS) + ", features array<float>"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("features", pa.list_(pa.float32()))])
_U = np.uint64


def _table(characters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters)] = True
    return out


_SPACE = _table(b"\t\n\x0b\x0c\r ")
_SYMBOL = b"#*$%&|<>"
_CAPITAL, _SMALL, _DIGIT = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789"


def _count(raw: bytes, characters: bytes) -> int:
    return len(raw) - len(raw.translate(None, characters))


def describe(text: np.ndarray) -> tuple[tuple[int, ...], np.ndarray]:
    """The counts and the features of one text; an empty text has zeros."""
    raw = text.tobytes()
    words = word_hashes(text, lower=False)
    n = len(words)
    chars = int(np.count_nonzero(((text & 0xC0) != 0x80) & ~_SPACE[text]))
    symbols = _count(raw, _SYMBOL)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    duplicate = len(lines) - len(set(lines))
    repeated = 0
    if n >= 4:
        windows = mixed(words[:-2] * _U(3) + words[1:-1] * _U(0x9E3779B97F4A7C15) + words[2:])
        _, of, times = np.unique(windows, return_inverse=True, return_counts=True)
        twice = np.concatenate([times[of] > 1, [False, False]])
        twice[1:] |= twice[:-1].copy()
        twice[2:] |= np.concatenate([times[of] > 1, [False]])[:n - 2]
        repeated = int(np.count_nonzero(twice))
    counts = (n, chars, symbols, duplicate, repeated)
    if not n:
        return counts, np.zeros(len(FEATURES), np.float32)
    often = np.unique(words, return_counts=True)[1]
    capitals, small, digits = _count(raw, _CAPITAL), _count(raw, _SMALL), _count(raw, _DIGIT)
    ended = sum(line.rstrip()[-1:] in (b".", b"!", b"?", b'"') for line in lines)
    return counts, np.array([
        np.log1p(n), chars / n, symbols / n, duplicate / len(lines), repeated / n, capitals / max(capitals + small, 1),
        digits / len(raw), _count(raw, b"!?") / n, raw.count(b"|") / n, len(often) / n, often.max() / n,
        _count(raw, b".,;:") / n, len(lines) / n, ended / len(lines), float(np.count_nonzero(text > 127)) / len(raw),
        float(np.count_nonzero(words[1:] == words[:-1])) / n, _count(raw, b"!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~") / len(raw),
    ], np.float32)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, features = [], []
        for text in binary_values(batch.column("bytes")):
            c, f = describe(text)
            counts.append(c)
            features.append(f)
        parts = list(zip(*counts)) or [[] for _ in COUNTS]
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), batch.column("row"), *(pa.array(p, pa.int64()) for p in parts), pa.array(features, pa.list_(pa.float32())),
        ], schema=_SCHEMA)


def described(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``row`` (``row_key("doc_id", "text")``), ``COUNTS`` and ``features`` per row of ``documents (doc_id, text)``."""
    return documents.select("doc_id", row_key("doc_id", "text").alias("row"), F.coalesce("text", F.lit("")).cast("binary").alias("bytes")).mapInArrow(_rows, SCHEMA_DDL)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether labels of this id are kept from training: crc32 of the id as text leaves 2 modulo 4; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(stats: DataFrame, labels: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``most`` labelled rows that are not held out, the same ones each time.

    An id with several labels counts once, with the largest.  Rows are chosen by
    a hash of the id; their number is known first, so few more than ``most`` are
    ordered and sent.
    """
    known = _known(labels)
    labelled = stats.select("doc_id", "features").join(known, "doc_id")
    return _first_rows(labelled.where(_chosen(labelled.count(), most)), most)


def numbered(table: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``table`` stored in order, with ``place`` counted from 0 over all rows and the ``part`` a row is in.

    Parts are ranges of the order; only their sizes reach the driver.
    """
    at = stored(table.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), name)
    part, within = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted((r.part, r.n) for r in at.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    before = [(p, sum(n for _, n in sizes[:k])) for k, (p, _) in enumerate(sizes)]
    offsets = F.broadcast(table.sparkSession.createDataFrame(before, "part long, _before long"))
    return at.withColumn("part", part).join(offsets, "part").withColumn("place", within + F.col("_before")).drop("_at", "_before")


def labelled_rows(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """``place, features, quality`` of every labelled row that is not held out, numbered in the order ``training_rows`` takes them."""
    labelled = stats.select("doc_id", "features").join(_known(labels), "doc_id")
    return numbered(labelled, [F.xxhash64("doc_id"), F.col("doc_id"), F.col("features")], "labelled").select("place", "features", "quality")


def sampled_rows(documents: DataFrame, labels: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """What ``training_rows`` gives, from ``documents (doc_id, text)``: of all rows ids are read, of the chosen ones texts."""
    known = _known(labels)
    n = documents.select("doc_id").join(known, "doc_id").count()
    chosen = stored(known.where(_chosen(n, most)), "labels")
    stats = described(documents.select("doc_id", "text").join(small(chosen).select("doc_id"), "doc_id"))
    return _first_rows(stats.select("doc_id", "features").join(small(chosen), "doc_id"), most)


def _known(labels: DataFrame) -> DataFrame:
    return labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(
        F.max("quality").alias("quality"))


def _chosen(n: int, most: int) -> Column:
    share = min(1.0, 1.2 * most / max(n, 1))
    return F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))


def _first_rows(labelled: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    rows = labelled.orderBy(F.xxhash64("doc_id"), "doc_id", "features").limit(most).select("features", "quality").toPandas()
    x = np.array(rows["features"].tolist(), dtype=np.float32).reshape(-1, len(FEATURES))
    return x, rows["quality"].to_numpy(dtype=np.int64)

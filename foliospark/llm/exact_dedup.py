"""Exact duplicates by composable polynomial fingerprints, confirmed by comparing the texts themselves.

Texts are compared after each run of ASCII white space has become one space.
The fingerprint of bytes ``b0 .. bk`` is ``b0 * B^k + .. + bk`` modulo a prime.
It composes: that of ``x`` followed by ``y`` is that of ``x`` shifted by the
length of ``y`` (times ``B^|y|``) plus that of ``y``.  So a text is hashed in
pieces; the pieces of a long text are rows of their own, hashed by any task, and
put together afterwards.

Equal fingerprint and length only make candidates.  Each task folds its
candidates into one text per group, comparing piece by piece and counting what
is equal; what is left, at most one text per task and group and so few even of
a group with a third of all rows, is sorted by fingerprint and compared in the
same way.  Different texts under one fingerprint become different groups.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from foliospark.llm.common import binary_values, small, stored

#: Bytes hashed and compared at a time; longer texts are cut into rows of this size.
PIECE = 1 << 16
PRIME, BASE = 2**61 - 1, 0x1B873593CC9E2D51 % (2**61 - 1)
#: Bytes of texts a task holds while it folds candidates; what is beyond is folded later.
HELD = 64 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MAPPED = np.where(_SPACE, 32, np.arange(256)).astype(np.uint8)


def normalised(text: np.ndarray) -> np.ndarray:
    """The bytes with every run of white space as one space."""
    space = _SPACE[text]
    again = space[1:] & space[:-1]
    out = _MAPPED[text]
    return out[np.concatenate([[True], ~again])] if again.any() else out


@lru_cache(maxsize=4)
def _powers(prime: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base, highest first, cut into high and low halves so that sums stay below 2^64."""
    power, out = 1, np.zeros(PIECE, np.uint64)
    for k in range(PIECE):
        out[PIECE - 1 - k] = power
        power = power * BASE % prime
    return out >> np.uint64(31), out & np.uint64(2**31 - 1)


def piece_hash(piece: np.ndarray, prime: int = PRIME) -> int:
    """The fingerprint of at most ``PIECE`` bytes."""
    high, low = _powers(prime)
    values, n = piece.astype(np.uint64), len(piece)
    if not n:
        return 0
    return ((int(values @ high[-n:]) << 31) + int(values @ low[-n:])) % prime


def combined(left: int, right: int, right_size: int, prime: int = PRIME) -> int:
    """The fingerprint of two strings laid end to end."""
    return (left * pow(BASE, right_size, prime) + right) % prime


def text_hash(text: np.ndarray, prime: int = PRIME) -> int:
    total = 0
    for start in range(0, len(text), PIECE):
        piece = text[start:start + PIECE]
        total = combined(total, piece_hash(piece, prime), len(piece), prime)
    return total


def same_text(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two texts are equal, compared piece by piece up to the first difference."""
    return len(a) == len(b) and all(
        np.array_equal(a[k:k + PIECE], b[k:k + PIECE]) for k in range(0, len(a), PIECE))


_TEXT = pa.schema([("doc_id", pa.int64()), ("print", pa.int64()), ("size", pa.int64()), ("sha", pa.binary()), ("body", pa.binary())])
_TEXT_DDL = "doc_id long, print long, size long, sha binary, body binary"


def _text_rows(prime: int | None, keep: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each text's fingerprint (none without a prime), size, digest and, if kept, its normalised bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, sizes, digests, bodies = [], [], [], []
            for text in binary_values(batch.column("bytes")):
                body = normalised(text)
                prints.append(None if prime is None else text_hash(body, prime))
                sizes.append(len(body))
                digests.append(hashlib.sha256(body).digest())
                bodies.append(body.tobytes() if keep else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, f.type) for c, f in zip((prints, sizes, digests, bodies), list(_TEXT)[1:]))], schema=_TEXT)
    return run


_PIECE = pa.schema([("long", pa.int64()), ("doc_id", pa.int64()), ("sha", pa.binary()), ("at", pa.int32()), ("print", pa.int64()), ("size", pa.int64())])


def _piece_rows(prime: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = list(binary_values(batch.column("piece")))
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in ("long", "doc_id", "sha", "at")),
                pa.array([piece_hash(p, prime) for p in pieces], pa.int64()), pa.array(list(map(len, pieces)), pa.int64())], schema=_PIECE)
    return run


_WHOLE = pa.schema([("doc_id", pa.int64()), ("print", pa.int64()), ("size", pa.int64()), ("sha", pa.binary())])


def _whole_rows(prime: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, sizes = [], []
            for pieces in batch.column("pieces").to_pylist():
                total = 0
                for piece in pieces:
                    total = combined(total, piece["print"], piece["size"], prime)
                prints.append(total)
                sizes.append(sum(piece["size"] for piece in pieces))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(prints, pa.int64()), pa.array(sizes, pa.int64()), batch.column("sha")], schema=_WHOLE)
    return run


def fingerprints(documents: DataFrame, longest: int = PIECE, prime: int = PRIME) -> DataFrame:
    """``doc_id, print, size, sha`` per row of ``documents (doc_id, text)``, of the normalised text.

    Texts of more than ``longest`` bytes are cut into pieces of that size, which
    are dealt over all tasks and whose hashes are then combined.
    """
    if longest > PIECE:
        raise ValueError(f"a piece has at most {PIECE} bytes")
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("bytes"))
    short = texts.where(F.length("bytes") <= longest).mapInArrow(_text_rows(prime, keep=False), _TEXT_DDL).drop("body")
    whole = texts.where(F.length("bytes") > longest).mapInArrow(_text_rows(None, keep=True), _TEXT_DDL).withColumn(
        "long", F.monotonically_increasing_id())
    # The pieces are made as one array, so that no row carries the whole text beside its piece.
    last = F.greatest(F.lit(0), F.ceil(F.length("body") / longest) - 1).cast("int")
    cut = F.transform(F.sequence(F.lit(0), last), lambda k: F.substring(F.col("body"), k * longest + 1, F.lit(longest)))
    pieces = whole.select("long", "doc_id", "sha", F.posexplode(cut).alias("at", "piece"))
    hashed = pieces.repartition("long", "at").mapInArrow(
        _piece_rows(prime), "long long, doc_id long, sha binary, at int, print long, size long")
    together = hashed.groupBy("long").agg(
        F.first("doc_id").alias("doc_id"), F.first("sha").alias("sha"),
        F.sort_array(F.collect_list(F.struct("at", "print", "size"))).alias("pieces"))
    long = together.select("doc_id", "sha", "pieces").mapInArrow(_whole_rows(prime), "doc_id long, print long, size long, sha binary")
    return short.unionByName(long)


_GROUP = pa.schema([("print", pa.int64()), ("size", pa.int64()), ("sha", pa.binary()), ("times", pa.int64()), ("body", pa.binary())])
_GROUP_DDL = "print long, size long, sha binary, times long, body binary"


def _folded(in_order: bool, most: int = HELD) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Equal texts as one row with their number.

    In any order as far as the held texts stay within bounds; ``in_order`` of
    fingerprint and size completely, and then without the text.
    """
    def batch_of(groups: list[list]) -> pa.RecordBatch:
        columns = list(zip(*groups)) or [()] * len(_GROUP)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _GROUP)], schema=_GROUP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[list]] = {}
        total, done = 0, []

        def emptied() -> list[list]:
            groups = [[*key, sha, times, None if in_order else text.tobytes()] for key, own in held.items() for text, sha, times in own]
            held.clear()
            return groups

        for batch in batches:
            keys = zip(batch.column("print").to_pylist(), batch.column("size").to_pylist())
            for key, sha, times, text in zip(keys, batch.column("sha").to_pylist(), batch.column("times").to_pylist(),
                                             binary_values(batch.column("body"))):
                if in_order and key not in held:
                    done += emptied()
                own = held.setdefault(key, [])
                for group in own:
                    if same_text(group[0], text):
                        group[2] += times
                        break
                else:
                    own.append([text.copy(), sha, times])
                    total += len(text)
                if not in_order and total > most:
                    yield batch_of(emptied())
                    total = 0
            if len(done) > 10_000:
                yield batch_of(done)
                done = []
        yield batch_of(done + emptied())
    return run


def equal_groups(documents: DataFrame, prints: DataFrame, prime: int = PRIME, held: int = HELD) -> DataFrame:
    """``print, size, sha, group_size`` of the texts whose fingerprint is not theirs alone, by comparison."""
    several = stored(prints.groupBy("print", "size").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "candidates")
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("bytes")).mapInArrow(
        _text_rows(prime, keep=True), _TEXT_DDL)
    candidates = texts.join(small(several), ["print", "size"]).select("print", "size", "sha", F.lit(1).cast("long").alias("times"), "body")
    folded = candidates.mapInArrow(_folded(in_order=False, most=held), _GROUP_DDL)
    ordered = folded.repartition("print", "size").sortWithinPartitions("print", "size")
    return ordered.mapInArrow(_folded(in_order=True), _GROUP_DDL).select("print", "size", "sha", F.col("times").alias("group_size"))


def exact_groups(documents: DataFrame, longest: int = PIECE, prime: int = PRIME, held: int = HELD) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` per row of ``documents (doc_id, text)``.

    Texts are equal when identical after each run of ASCII white space has become
    one space.  Of equal texts one row stays: that with the smallest id, a null
    id being larger than all others; of rows that repeat that id, any single one.
    A null text is empty, and empty texts equal each other (not those of white
    space alone, which are one space).  Texts of any length are compared whole;
    other columns are not read; an empty table gives an empty result.
    """
    # The rows' numbers are fixed by writing them.
    rows = stored(fingerprints(documents, longest, prime).withColumn("place", F.monotonically_increasing_id()), "fingerprints")
    key = ["print", "size", "sha"]
    sizes = stored(equal_groups(documents, rows, prime, held), "groups")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "place")).alias("first")
    groups = stored(
        rows.join(small(sizes), key).groupBy(*key).agg(first, F.first("group_size").alias("group_size"))
        .select(*key, "group_size", F.col("first.doc_id").alias("keep_id"), F.col("first.place").alias("stays")), "kept",
    )
    return rows.join(small(groups), key, "left").select(
        "doc_id", F.when(F.col("stays").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("stays") == F.col("place"), F.lit(True)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )

"""Byte-level BPE by a table of last tokens.

For each prefix of a piece the table keeps the last token of that prefix's
encoding.  It is unique: a token that ends the prefix is the last one exactly if
the table's last token of what is before it, followed by this token, is how BPE
would encode the two together.  So appending bytes only adds entries, cutting
drops them, and an edit redoes entries from the edit on.  Encodings are read
off backwards.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from foliospark.llm.common import give_back


class Vocabulary:
    """Token bytes by rank, with the check that two tokens stay two."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=0)
        self.pairs: dict[int, bool] = {}

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})

    def merged(self, piece: bytes) -> list[int]:
        """BPE as defined: the adjacent pair with the lowest rank is merged first, the leftmost of equals."""
        parts = [piece[k:k + 1] for k in range(len(piece))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[k] + parts[k + 1], len(self.ranks) + 1), k) for k in range(len(parts) - 1))
            if rank > len(self.ranks):
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def stays(self, left: int, right: int) -> bool:
        """Whether the two tokens' bytes together are encoded as these two tokens."""
        key = left << 32 | right
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) > 600_000:  # a cache only
                self.pairs.clear()
            found = self.pairs[key] = self.merged(self.tokens[left] + self.tokens[right]) == [left, right]
        return found


class PrefixTable:
    """The last token of every prefix of a piece of text."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.vocabulary = vocabulary
        self.piece = b""
        self.last: list[int] = []
        self.append(piece)

    def append(self, more: bytes) -> None:
        """Encode with ``more`` at the end; the entries before stay as they are."""
        rank, pairs, last = self.vocabulary.ranks.get, self.vocabulary.pairs, self.last
        stays, longest = self.vocabulary.stays, self.vocabulary.longest
        done = len(self.piece)
        self.piece = piece = self.piece + more
        for end in range(done + 1, len(piece) + 1):
            for start in range(max(0, end - longest), end):
                token = rank(piece[start:end])
                if token is None:
                    continue
                if not start:
                    break
                left = last[start - 1]
                if (fits := pairs.get(left << 32 | token)) or fits is None and stays(left, token):
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")
            last.append(token)

    def cut(self, size: int) -> None:
        """Keep the first ``size`` bytes."""
        self.piece = self.piece[:size]
        del self.last[size:]

    def edit(self, start: int, end: int, new: bytes) -> None:
        """Put ``new`` in place of ``piece[start:end]``; entries before the edit are reused."""
        rest = self.piece[end:]
        self.cut(start)
        self.append(new + rest)

    def ids(self) -> list[int]:
        out, end, tokens = [], len(self.piece), self.vocabulary.tokens
        while end:
            token = self.last[end - 1]
            out.append(token)
            end -= len(tokens[token])
        return out[::-1]


class Encoder:
    """Whole texts: each match of the pattern is a piece; repeated pieces come from a bounded cache."""

    def __init__(self, vocabulary: Vocabulary, pattern: str, cache: int = 400_000):
        self.vocabulary, self.pattern, self.cache = vocabulary, regex.compile(pattern), cache
        self._known: dict[str, bytes] = {}

    def _learn(self, pieces: set[str]) -> None:
        """Encode new pieces in order: each keeps the entries of the prefix it shares with the one before."""
        table = PrefixTable(self.vocabulary)
        for raw, text in sorted((p.encode(), p) for p in pieces):
            shared, most = 0, min(len(raw), len(table.piece))
            before = table.piece
            while shared < most and raw[shared] == before[shared]:
                shared += 1
            table.cut(shared)
            table.append(raw[shared:])
            ids = table.ids()
            self._known[text] = struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        if len(self._known) > self.cache:  # frequent pieces come back soon enough
            self._known.clear()
        split = [self.pattern.findall(text) for text in texts]
        self._learn(set(chain.from_iterable(split)).difference(self._known))
        return [b"".join(map(self._known.__getitem__, pieces)) for pieces in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, memoryview(ids).cast("I")))


def _texts(column: pa.Array) -> Iterator[str]:
    """The texts of a batch, few of them as Python strings at a time."""
    for at in range(0, len(column), 256):
        for text in column.slice(at, 256).to_pylist():
            yield text or ""


def _blocks(texts: Iterator[str], size: int = 1_000_000) -> Iterator[list[str]]:
    """Texts of about ``size`` characters together, a longer one alone."""
    block, total = [], 0
    for text in texts:
        block.append(text)
        total += len(text)
        if total >= size:
            yield block
            block, total = [], 0
    if block:
        yield block


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> Encoder:
    """One for each Python worker; the file is on every machine."""
    return Encoder(Vocabulary.read(path), pattern)


def encoded(documents: DataFrame, path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` (and ``ids``) per row of ``documents (doc_id, text)``.

    ``path`` names a file of base64 tokens and ranks.  A null or empty text has no
    tokens and the digests of no bytes; very long texts are one row and are
    encoded whole; equal rows give equal results; null ids stay null; other
    columns are not read; an empty table gives an empty result.
    """
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()),
        *([("ids", pa.binary())] if keep_ids else []),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        for batch in batches:
            out: list[list] = [[] for _ in schema]
            ids_of = (ids for block in _blocks(_texts(batch.column("text"))) for ids in encoder.encode(block))
            for doc, ids in zip(batch.column("doc_id").to_pylist(), ids_of):
                row = (doc, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(encoder.decode(ids)).hexdigest(), ids)
                for part, value in zip(out, row):
                    part.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(p, f.type) for p, f in zip(out, schema)], schema=schema)
            del batch, out, ids_of
            give_back()

    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * keep_ids
    return documents.select("doc_id", "text").mapInArrow(run, ddl)

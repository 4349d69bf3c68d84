"""Repeated strings against a brute-force search."""

import hashlib
import random

import duckdb

from foliospark.llm.oracle import ORACLE
from foliospark.llm.suffix_dedup import remove_repeats

SCHEMA = "doc_id long, text string, row string, bytes string, starts int"


def brute(rows, length=200):
    texts = [(t or "").encode() for _, t in rows]
    seen = {}
    for k, b in enumerate(texts):
        for i in range(len(b) - length + 1):
            seen.setdefault(b[i:i + length], []).append((k, i))
    out = []
    for k, b in enumerate(texts):
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if len(seen[b[i:i + length]]) > 1:
                gone[i:i + length] = [True] * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((rows[k][0], len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def check(spark, rows):
    df = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], SCHEMA)
    assert order(map(tuple, remove_repeats(df).collect())) == order(brute(rows))


def text(rng, n):
    return "".join(rng.choice("abcdé \n") for _ in range(n))


def test_passages_copies_and_edges(spark):
    rng = random.Random(1)
    shared, other = text(rng, 260), text(rng, 700)
    rows = [(k, text(rng, rng.randrange(0, 500)) + shared + text(rng, rng.randrange(0, 300))) for k in range(6)]
    rows += [(10, other), (11, other[:350] + "#" + other[351:]), (12, other[100:]), (13, other[:199]), (14, other[:200])]
    for k in range(15, 30):  # near copies, each with a few edits
        b = list(other)
        for _ in range(rng.randrange(1, 5)):
            b[rng.randrange(len(b))] = rng.choice("XYZ")
        rows.append((k, "".join(b)))
    rows += [(40, "ab" * 300), (41, "a" * 201), (42, "a" * 200), (43, "z" * 199), (44, shared + shared[:150] + shared)]
    check(spark, rows)


def test_nulls_repeats_and_bounds(spark):
    rng = random.Random(2)
    long = text(rng, 70_000)
    rows = [(None, long), (1, None), (1, ""), (1, long[65_000:65_600]), (2, text(rng, 300)), (3, text(rng, 250)), (3, "q" * 10)]
    check(spark, rows + [rows[4]])


def test_empty(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_table_against_sql(spark):
    """In these texts some repeats are covered by another repeat in one place only."""
    path = "/root/testdata/sf0.01/documents.parquet"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{path}'")
    assert order(map(tuple, remove_repeats(spark.read.parquet(path)).collect())) == order(con.sql(ORACLE["op2_suffix_dedup"]).fetchall())

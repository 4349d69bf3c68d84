"""Exact groups against a dictionary of normalised texts."""

import hashlib
import random
import re

import duckdb
import numpy as np

from foliospark.llm import exact_dedup
from foliospark.llm.oracle import ORACLE

SCHEMA = "doc_id long, text string, print long, size string, place int, sha string"


def brute(rows):
    texts = [re.sub(rb"[\x20\x09-\x0D]+", b" ", (t or "").encode()) for _, t in rows]
    groups = {}
    for k, t in enumerate(texts):
        groups.setdefault(t, []).append(k)
    out = []
    for own in groups.values():
        stays = min(own, key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
        out += [(rows[k][0], rows[stays][0], len(own), k == stays, hashlib.sha256(texts[k]).hexdigest()) for k in own]
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def check(spark, rows, **options):
    df = spark.createDataFrame([(i, t, 1, "s", 2, "h") for i, t in rows], SCHEMA).repartition(5)
    assert order(map(tuple, exact_dedup.exact_groups(df, **options).collect())) == order(brute(rows))


def rows_of(rng):
    rows = [(k, "one hot  text") for k in range(100, 160)] + [(k, "one\thot\ntext") for k in range(40, 70)]
    rows += [(k, " ".join(rng.choice("abé") * rng.randrange(1, 4) for _ in range(rng.randrange(0, 12)))) for k in range(200, 400)]
    rows += [(5, None), (6, ""), (7, " "), (8, "\n\t"), (None, "x y"), (9, "x  y"), (None, "lonely"), (None, "twice"), (None, "twice")]
    return rows + [(10, "same"), (10, "same"), (11, "same"), (12, " same"), (13, "same ")]


def test_groups(spark):
    check(spark, rows_of(random.Random(1)))


def test_equal_fingerprints_of_different_texts(spark):
    """Modulo 7 most texts of one length collide; the comparison tells them apart."""
    check(spark, rows_of(random.Random(2))[:150], prime=7)


def test_long_texts_in_pieces(spark):
    rng = random.Random(3)
    long = "".join(rng.choice("abc é\n ") for _ in range(150_000))
    rows = [(1, long), (2, re.sub(r"\s+", " \t", long)), (3, long[:-1] + "#"), (4, "#" + long[1:]), (5, long[:64]), (6, long[:65]), (7, " " * 200)]
    check(spark, rows)
    check(spark, [(i, t and t[:5000]) for i, t in rows], longest=64)


def test_composition():
    rng = np.random.default_rng(4)
    text = rng.integers(0, 256, 200_000).astype(np.uint8)
    whole = 0
    for byte in text[:3000].tolist():
        whole = (whole * exact_dedup.BASE + byte) % exact_dedup.PRIME
    assert exact_dedup.text_hash(text[:3000]) == whole
    for cut in (0, 1, 65_535, 65_536, 70_001, 200_000):
        left, right = text[:cut], text[cut:]
        assert exact_dedup.combined(exact_dedup.text_hash(left), exact_dedup.text_hash(right), len(right)) == exact_dedup.text_hash(text)


def test_held_texts_are_bounded(spark):
    check(spark, rows_of(random.Random(5)), held=10)


def test_without_broadcast_and_empty(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "small", lambda df: df)
    check(spark, rows_of(random.Random(6)))
    assert exact_dedup.exact_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_table_against_sql(spark, sf_dir):
    path = f"{sf_dir}/documents.parquet"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{path}'")
    assert order(map(tuple, exact_dedup.exact_groups(spark.read.parquet(path)).collect())) == order(con.sql(ORACLE["op11_exact_dedup"]).fetchall())

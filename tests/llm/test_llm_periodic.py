"""Runs against a search over all periods and places."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np

from foliospark.llm import periodic

SCHEMA = "doc_id long, text string, words string, n int, runs string, a long"


def brute_runs(words):
    n, found = len(words), {}
    for p in range(1, n // 3 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            e = i
            while e + p < n and words[e] == words[e + p]:
                e += 1
            if e + p - i >= max(24, 3 * p):
                found.setdefault((i, e + p - i), p)
            i = e + 1
    return sorted((s, length, p) for (s, length), p in found.items())


def brute(doc_id, text):
    words = (text or "").encode().split()
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    digest = lambda s: hashlib.sha256(s).hexdigest()
    return (doc_id, len(runs), *best, best[0] is not None and 1000 * best[1] // best[2] if runs else None,
            digest("".join(f"{s},{length},{p}\n" for s, length, p in runs).encode()),
            digest(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def check(spark, rows):
    df = spark.createDataFrame([(i, t, "w", 1, "r", 2) for i, t in rows], SCHEMA)
    got = periodic.digest(periodic.periodic_runs(periodic.planted(df)))
    assert order(map(tuple, got.collect())) == order([brute(*r) for r in rows])


def sequences(rng):
    for _ in range(150):
        kind, n = rng.randrange(4), rng.randrange(0, 160)
        if kind == 0:
            yield [rng.randrange(2) for _ in range(n)]
        elif kind == 1:
            yield [rng.randrange(50) for _ in range(n)]
        else:
            part = [rng.randrange(1 + rng.randrange(9)) for _ in range(rng.randrange(1, 30))]
            whole = part * rng.randrange(2, 9)
            for _ in range(rng.randrange(3)):
                whole[rng.randrange(len(whole))] = 99
            yield [rng.randrange(3) for _ in range(rng.randrange(20))] + whole + [rng.randrange(3) for _ in range(rng.randrange(20))]


def test_runs():
    texts = [np.array(s, np.int64) for s in sequences(random.Random(1))]
    texts += [np.zeros(500, np.int64), np.zeros(0, np.int64), np.arange(500), np.tile(np.arange(70), 8)]
    assert [list(map(tuple, r.tolist())) for r in periodic.runs_of(texts)] == [brute_runs(t.tolist()) for t in texts]


def test_runs_with_pairs_in_parts(monkeypatch):
    monkeypatch.setattr(periodic, "PAIRS", 50)
    texts = [np.array(s, np.int64) for s in sequences(random.Random(2))]
    assert [list(map(tuple, r.tolist())) for r in periodic.runs_of(texts)] == [brute_runs(t.tolist()) for t in texts]


def test_extensions():
    rng = random.Random(3)
    for words in ([rng.randrange(2) for _ in range(300)], [0] * 200, [0, 1, 2] * 60, [5], list(range(30)), [0] * 13 + [1] + [0] * 13):
        n, far = len(words), periodic.Extensions(np.array(words, np.int64))
        pairs = [(i, j) for i in range(n) for j in range(n) if i != j]
        if not pairs:
            continue
        want = []
        for i, j in pairs:
            k = 0
            while max(i, j) + k < n and words[i + k] == words[j + k]:
                k += 1
            want.append(k)
        i, j = np.array(pairs).T
        assert far(i, j).tolist() == want


def test_cover():
    for d in range(periodic.MODULUS):
        a = int(periodic._FROM[d])
        assert a in periodic.COVER and (a + d) % periodic.MODULUS in periodic.COVER
    assert periodic.AGREE == 9


def test_documents(spark):
    rng = random.Random(4)
    rows = [(k, " ".join(rng.choice("ab cé d").strip() or "x" for _ in range(rng.randrange(0, 300)))) for k in range(120)]
    chosen = [k for k in range(4000) if zlib.crc32(str(k).encode()) % 10 == 0][:40]
    rows += [(k, " ".join(f"w{rng.randrange(500)}" for _ in range(rng.randrange(0, 400)))) for k in chosen]
    rows += [(None, "a b " * 40), (None, None), (1, None), (2, ""), (3, " \n\t"), (3, "q " * 30), (3, "q " * 30), (chosen[0], None), (chosen[1], " ")]
    rows += [(7001, "x\x0by\x0cz\r" * 20), (7002, "word " * 23), (7003, "word\n" * 24), (7004, "Word word " * 12)]
    check(spark, rows)


def test_long_text_and_empty_table(spark):
    rng = random.Random(5)
    part = [f"v{rng.randrange(300)}" for _ in range(7_000)]
    chosen = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 10 == 0)
    rows = [(None, " ".join(part * 4)), (chosen, " ".join(part * 3))]
    df = spark.createDataFrame([(i, t, "w", 1, "r", 2) for i, t in rows], SCHEMA)
    got = {r.doc_id: r for r in periodic.digest(periodic.periodic_runs(periodic.planted(df))).collect()}
    assert tuple(got[None])[1:6] == (1, 0, 28_000, 7_000, 4000)
    assert got[None].collapsed_sha256 == hashlib.sha256(" ".join(part).encode()).hexdigest()
    assert got[chosen].n_runs >= 1
    assert periodic.digest(periodic.periodic_runs(spark.createDataFrame([], "doc_id long, text string"))).count() == 0

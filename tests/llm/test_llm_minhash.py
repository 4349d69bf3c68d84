"""Near-duplicates against all pairs of a small table."""

import random
import re

from pyspark.sql import functions as F

from foliospark.llm import minhash


def sets_of(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [sets_of(t) for _, t in rows]
    top = list(range(len(rows)))

    def find(k):
        while top[k] != k:
            k = top[k]
        return k
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                top[find(a)] = find(b)
    groups = {}
    for k, (i, _) in enumerate(rows):
        groups.setdefault(find(k), []).append(i)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [x for x in groups[find(k)] if x is not None]
        low = min(ids) if ids else None
        out.append((i, len(sets[k]), low, i == low))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def check(spark, rows):
    df = spark.createDataFrame([(i, t, 1, "n", 2) for i, t in rows], "doc_id long, text string, node int, bucket string, n int")
    assert order(map(tuple, minhash.near_duplicates(df).collect())) == order(brute(rows))


def edit(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return words


def test_groups_chains_and_passages(spark):
    rng = random.Random(3)
    word = lambda: f"v{rng.randrange(5000)}"
    rows, base = [], [word() for _ in range(120)]
    for k in range(40):  # a group whose copies differ
        rows.append((k, " ".join(edit(rng, base, rng.randrange(0, 4)))))
    chain = [word() for _ in range(100)]
    for k in range(100, 120):  # each resembles only the one before
        rows.append((k, "\t".join(chain)))
        chain = chain[8:] + [word() for _ in range(8)]
    shared = [word() for _ in range(60)]
    for k in range(200, 300):  # different texts around one passage
        rows.append((k, " ".join([word() for _ in range(15)] + shared + [word() for _ in range(15)])))
    rows += [(300, "A b  C"), (301, "a B\nc"), (302, "a b"), (303, "one two three four five"), (304, "ONE two three four five")]
    check(spark, rows)


def test_nulls_empty_and_repeats(spark):
    long = " ".join(str(k * k) for k in range(30_000)) + " " + "x" * 200_000
    check(spark, [(5, None), (6, ""), (7, " \n"), (None, "a b c d e f"), (9, "a b c d e f"), (9, "a b c d e f"),
                  (None, "lonely words of their own kind"), (3, long), (4, long + " y"), (3, long)])
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_estimate(spark):
    rng = random.Random(4)
    a, b = set(range(0, 800)), set(range(200, 1000))  # similarity 0.6
    import numpy as np
    sig = [minhash._packed(minhash._minima(minhash.mixed(np.array(sorted(s), dtype=np.uint64) + np.uint64(rng.randrange(9) * 0 + 77))), 2)
           for s in (a, b)]
    got = spark.createDataFrame([sig], "x array<long>, y array<long>").select(minhash.estimated("x", "y").alias("e"), minhash.estimated("x", "x").alias("s")).first()
    assert abs(got.e - 0.6) < 0.2 and got.s == 1.0


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 400)], "a long, b long")
    got = {(r.node, r.component) for r in minhash.components(edges).collect()}
    assert got == {(k, 0) for k in range(201)} | {(400, 400), (500, 400)}
    assert minhash.components(edges.where(F.lit(False))).count() == 0


def test_known_links_are_not_joined_again(spark, monkeypatch):
    """Links found later join whole components; those inside one take no further work."""
    seen, components = [], minhash.components

    def counted(edges):
        seen.append(edges.count())
        return components(edges)

    monkeypatch.setattr(minhash, "components", counted)
    parts = [[(k, k + 1) for k in range(50)] + [(400, 401), (700, 701)], [(5, 300), (3, 7), (41, 401), (9, 401)], [(2, 300), (700, 701)]]
    found = minhash._Links(None, None, 75)
    for part in parts:
        found.add(minhash.stored(spark.createDataFrame(part, "a long, b long"), "links"))
    assert seen == [52, 2]
    got = {(r.node, r.component) for r in found.label.collect()}
    assert got == {(k, 0) for k in (*range(51), 300, 400, 401)} | {(700, 700), (701, 700)} and found.label.count() == 56


def test_pairs_around_a_passage_are_ruled_out_by_their_odd_shingles(spark, monkeypatch):
    """Of texts that share a passage and some odd shingles, but too few, no pair goes to the full sets after the first turns."""
    rng = random.Random(6)
    word = lambda: f"v{rng.randrange(9000)}"
    passage, extra = [word() for _ in range(70)], [[word() for _ in range(12)] for _ in range(3)]
    rows = [(k, " ".join([word() for _ in range(14)] + extra[k % 3] + passage + [word() for _ in range(14)])) for k in range(90)]
    calls, later, confirmed, across = [], [], minhash._confirmed, minhash._across

    def counted(pairs, *rest):
        calls.append(pairs.count())
        return confirmed(pairs, *rest)

    def noted(*args):
        later.append(len(calls))
        across(*args)

    monkeypatch.setattr(minhash, "FEW", 4)
    monkeypatch.setattr(minhash, "_confirmed", counted)
    monkeypatch.setattr(minhash, "_across", noted)
    check(spark, rows)
    assert later and len(calls) > later[0] and sum(calls[later[0]:]) == 0


def test_odd_shingles_name_a_group_only_if_enough_are_left(spark, monkeypatch):
    """Most odd shingles of copies too far from each other lead to no comparison, and no link is lost."""
    rng = random.Random(1)
    base = [f"v{rng.randrange(9000)}" for _ in range(140)]
    rows = []
    for k in range(80):
        words = list(base)
        for at in rng.sample(range(6, 134, 6), rng.randrange(4, 8)):
            words[at] = f"x{at}_{rng.randrange(60)}"
        rows.append((k, " ".join(words)))
        if k % 8 == 0:  # one that is near to it
            rows.append((100 + k, " ".join([*words[:-1], "end"])))
    begun, opened = [], minhash._open

    def noted(members, turn):
        if turn == 0:
            begun.append(members.count())
        return opened(members, turn)

    monkeypatch.setattr(minhash, "FEW", 2)
    monkeypatch.setattr(minhash, "_open", noted)
    check(spark, rows)
    assert len(begun) == 1 and begun[0] < 3000


def test_least_number_of_shared_odd_shingles(spark):
    """Of linked sets, those that differ from any core share at least so many odd shingles."""
    rng = random.Random(9)
    rows = []
    for _ in range(3000):
        core = set(range(rng.randrange(5, 40)))
        a, b = ({x for x in core if rng.random() < 0.8} | {rng.randrange(50, 60) for _ in range(rng.randrange(9))} or {1} for _ in range(2))
        slacks = [25 * len(s) - 175 * len(s ^ core) for s in (a, b)]
        rows.append((*slacks, len((a ^ core) & (b ^ core)), 100 * len(a & b) >= 75 * len(a | b)))
    df = spark.createDataFrame(rows, "one long, two long, shared int, linked boolean")
    least = minhash._shared_least("one", F.col("two"), 75)
    assert df.where(F.col("linked") != (F.col("shared") >= least)).count() == 0
    assert df.where("linked").count() > 50 and df.where(F.col("linked") & (F.col("shared") == least) & (least > 0)).count() > 0

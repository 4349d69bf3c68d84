"""Ranked search against the score of every pair."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from foliospark.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id long, text string, terms string, n int, length string, item long", "item_id long, text string, doc_id string, terms int"


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=10):
    counts = [Counter(terms(t)) for _, t in docs]
    sizes = [sum(c.values()) for c in counts]
    n_docs, n_terms = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for c in counts for t in c)
    out = []
    for item_id, text in items:
        hits = []
        for (doc_id, _), c, n in zip(docs, counts, sizes):
            score = 0
            for t in set(terms(text)) & set(c):
                m = 10 + 90 * n * n_docs // n_terms
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                hits.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, k + 1, None if missing else doc_id, -score) for k, (score, missing, doc_id) in enumerate(sorted(hits)[:top])]
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def check(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, "t", 1, "l", 2) for i, t in docs], DOCS).repartition(6)
    q = spark.createDataFrame([(i, t, "d", 3) for i, t in items], ITEMS)
    assert order(map(tuple, lexical.search(d, q, **options).collect())) == order(brute(docs, items, options.get("top", 10)))


def tables(rng, n):
    word = lambda: f"w{int(rng.paretovariate(0.6)) % 400}"
    docs = [(k, " ".join(word() for _ in range(rng.randrange(0, 90)))) for k in range(n)]
    items = [(k, " ".join(word() for _ in range(rng.randrange(1, 40)))) for k in range(30)]
    docs += [(1000 + k, "x " + items[k % 30][1] + " " + docs[k][1]) for k in range(60)]
    docs += [(2000 + k, docs[5][1]) for k in range(40)]  # equal scores
    return docs, items


def test_search(spark):
    check(spark, *tables(random.Random(1), 300))


def test_search_in_passes(spark):
    check(spark, *tables(random.Random(2), 120), most_items=13, top=3)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "Äb c-D é_é 9"), (None, "äb C d"), (None, "äb C d"), (4, "É éÉ\x00c"), (4, "c c c C"), (4, "c c c C"),
            (5, "c " * 30_000 + "rare"), (6, "- _ ~"), (-7, "äb C d")]
    items = [(1, "c äb"), (1, "c äb"), (2, None), (None, "rare É d 9"), (3, "unknown words"), (4, "!!"), (5, "É"), (6, " ".join(f"z{k}" for k in range(90)) + " c")]
    check(spark, docs, items)
    empty = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical.search(empty, some).count() == 0
    assert lexical.search(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), some.where("false")).count() == 0
    assert lexical.search(spark.createDataFrame([(1, None)], "doc_id long, text string"), some).count() == 0


@pytest.mark.parametrize("reach", [0, 1])
def test_bounds_keep_every_good_pair(reach):
    """Whatever score is to be beaten, each task's best documents are those of all pairs."""
    rng = np.random.default_rng(3)
    items = lexical.Items(50, [np.sort(rng.choice(50, n, replace=False)) for n in (3, 20, 40)], [rng.integers(0, 9000, n) for n in (3, 20, 40)])
    rows = [np.sort(rng.choice(50, rng.integers(1, 30), replace=False)) for _ in range(500)]
    impacts = [rng.integers(1, 10**6, len(r)) for r in rows]
    dense = np.zeros((500, 50), np.int64)
    for k, (r, x) in enumerate(zip(rows, impacts)):
        dense[k, r] = x
    want, begin = [], []
    for k, (t, w) in enumerate(zip(items.terms, items.weights)):
        score = dense[:, t] @ w
        best = np.lexsort((np.arange(500), -score))[:10]
        begin.append(int(score[best[-1]]) * reach)
        want += [(k, int(d), int(score[d])) for d in best]
    order_by = np.argsort([-float(np.sqrt((x.astype(float) ** 2).sum())) for x in impacts])
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({
        "doc_id": [int(k) for k in order_by], "length": [float(np.sqrt((impacts[k].astype(float) ** 2).sum())) for k in order_by],
        "terms": pa.array([rows[k].tolist() for k in order_by], pa.list_(pa.int32())), "impacts": [impacts[k].tolist() for k in order_by]})
    got = [tuple(r.values()) for out in lexical._hit_rows(items, begin, 10)(iter([batch])) for r in out.to_pylist()]
    assert got == want

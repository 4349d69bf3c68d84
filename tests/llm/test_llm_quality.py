"""URL filters, quality model, rules and the pipeline."""

import re
import zlib
from collections import Counter

import numpy as np

import corpus_pipeline
from foliospark.llm import additive, isolation, statistics, urls

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, features string, n_words int, held_out string"
ODD = ["", None, "a b c a b c a b c", "é # x\né # x\n\n \n # * $ % & | < >", "x" * 100_000, "w " * 60, " ".join(map(str, range(80))), "Aa\x0bBb\x0cCc"]


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "f", 1, "h") for i, t in texts], DOCS)


def test_counts(spark):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, ODD[2]), (2, ODD[2])]
    labels = spark.createDataFrame([(0, 1, 1), (0, 0, 1), (2, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = isolation.judged(docs_of(spark, rows), labels).collect()
    want = []
    for i, t in rows:
        n = counts(t)
        want.append((i, *n, n[0] < 50 or 100 * n[4] > 50 * n[0]))
    assert sorted((tuple(r)[:7] for r in got), key=str) == sorted(want, key=str)
    assert all(not r.kept for r in got if r.base_failed)
    assert isolation.judged(docs_of(spark, []), labels).count() == 0


def test_scores_without_labels(spark):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, "x")]
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = additive.scored(docs_of(spark, rows), none).collect()
    assert {r.score for r in got} == {0.5} and {r.predicted for r in got} == {0}
    assert {r.doc_id: r.held_out for r in got if r.doc_id is not None} == {k: zlib.crc32(str(k).encode()) % 4 == 2 for k in range(len(ODD))}
    assert additive.scored(docs_of(spark, []), none).count() == 0


def test_held_out_quality(spark, sf_dir):
    path = f"{sf_dir}/../sf0.01"
    docs, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = additive.scored(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    held = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) > 0.97
    kept = {r.doc_id: r for r in isolation.judged(docs, labels).collect()}
    passed = [(truth[i], r.kept) for i, r in kept.items() if i in truth and not r.base_failed and zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([k for y, k in passed if y]) > 0.85 and np.mean([k for y, k in passed if not y]) < 0.4


def test_trees():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, len(statistics.FEATURES))).astype(np.float32)
    y = (x[:, 0] * x[:, 1] > 0).astype(int)  # only an interaction tells
    model = additive.AdditiveModel.fit(x, y)
    assert (0, 1) in model.pairs and ((model.score(x) > 0.5) == y).mean() > 0.8
    forest = isolation.IsolationForest.fit(x)
    s = forest.score(np.vstack([x[:50] * 0.2, x[:50] * 6]))
    assert s[:50].max() < s[50:].min()


def plain(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host):])[0]


def test_urls(spark, sf_dir):
    odd = ["http://A.Example.ORG/es/x?q", "http://example.org/en/12", "https://x.org", "http://notorg/", "http://org/", "ftp://z.com/fr/a#b",
           "nothing", None, "", "http://", "http://a.com/de/\nx", "x://y://z.com/fr/", "http://É.com/fr", "http://" + "ab" * 500 + ".net/p"]
    rows = [(k, u) for k, u in enumerate(odd)] + [(None, odd[0]), (3, odd[3]), (3, odd[3])]
    df = spark.createDataFrame([(i, u, None, "t", "s") for i, u in rows], "page_id long, url string, html string, token string, said string")
    got = [tuple(r) for r in urls.judged(df).collect()]
    assert len(got) == len(rows)

    def rule(host, path):
        fit = [(len(t), t, v) for v, t in urls.RULES
               if (host == t.split("/")[0] or host.endswith("." + t.split("/")[0])) and path.startswith(t[t.index("/"):])]
        return max(fit)[1:] if fit else (None, None)

    want = []
    for i, u in rows:
        host, path = plain(u)
        want.append((i, host, path, *rule(host, path)))
    assert sorted((g[:4] for g in got), key=str) == sorted((w[:4] for w in want), key=str)
    said = {w[:4]: w[4] for w in want}
    assert all(g[4] == said[g[:4]] for g in got if g[3]) and {g[4] for g in got} <= {"allow", "block"}
    assert urls.judged(df.limit(0)).count() == 0


def test_segments(spark):
    words = spark.createDataFrame([("casino", 50), ("win", 80), ("free", 70), ("bets", 20), ("the", 500), ("a", 300)], "word string, n long")
    labels = spark.createDataFrame([("casinowin",), ("freebets",), ("qqq",), ("thecasino",)], "label string")
    got = {r.label: r.words for r in urls.segmented(labels, words).collect()}
    assert got == {"casinowin": ["casino", "win"], "freebets": ["free", "bets"], "qqq": ["qqq"], "thecasino": ["the", "casino"]}


def test_bayes(spark):
    spam = [(k, f"http://casinowin{k % 3}.com/de/bets", "<title>casino win</title>") for k in range(30)]
    good = [(100 + k, f"http://newspaper{k % 3}.org/story", "<title>news paper</title>") for k in range(30)]
    asked = [(200, "http://casinowin.net/bets", None), (201, "http://newspaper.net/story", None)]
    df = spark.createDataFrame(spam + good + asked, "page_id long, url string, html string")
    assert {r.page_id: r.verdict for r in urls.judged(df).where("rule is null").collect()} == {200: "block", 201: "allow"}


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    at, before = docs, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, sf_dir)
        assert at.columns == docs.columns, name
        ids = {r.doc_id for r in at.select("doc_id").collect()}
        assert ids and (before is None or ids <= before)
        before = ids
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == before and len(rows) == len(before)


def test_accepted_rows_of_null_and_repeated_ids(spark):
    good = [" ".join(f"word{(k * 7 + j * j) % 211} runs" for j in range(40)) + "." for k in range(60)]
    bad = ["$ # | " * (20 + k) for k in range(60)]
    rows = list(enumerate(good)) + [(100 + k, t) for k, t in enumerate(bad)]
    labels = spark.createDataFrame([(i, int(i < 100), 1) for i, _ in rows if i % 100], "doc_id long, quality int, toxic int")
    rows += [(None, good[0] + " more"), (None, bad[0] + "#"), (None, good[1] + " more"), (None, None), (0, bad[1] + "#"), (100, good[2] + " more"), (100, good[2] + " more")]
    df = docs_of(spark, rows)
    own = spark.createDataFrame([(i if i and i % 100 else 1000 + k, t, "f", 1, "h") for k, (i, t) in enumerate(rows)], DOCS)
    said = {r.doc_id: r.predicted for r in additive.scored(own, labels).collect()}
    kept = [(i, t) for k, (i, t) in enumerate(rows) if said[i if i and i % 100 else 1000 + k]]
    assert (None, good[0] + " more") in kept and (None, bad[0] + "#") not in kept and len(kept) == 64
    got = additive.accepted(df, labels)
    assert got.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(kept, key=str)


def test_near_dedup_of_null_and_repeated_ids(spark):
    word = lambda a, k: f"w{a * 1000 + k}"
    text = lambda a, n=60, end="": " ".join([word(a, k) for k in range(n)]) + end
    rows = [(None, text(k)) for k in range(6)] + [(7, text(k)) for k in range(10, 14)]  # linked with nothing
    rows += [(20, text(20)), (None, text(20, 60, " end")), (7, text(20, 60, " fin"))]  # the repeated id is the smallest
    rows += [(None, text(30)), (None, text(30, 60, " end")), (31, text(31)), (32, text(31)), (31, text(31)), (31, text(32)), (None, text(33)), (None, text(33))]
    rows += [(None, None), (None, ""), (7, " \n"), (41, None), (42, "one two"), (43, "ONE  two")]
    sets = [{tuple(w[k:k + min(5, len(w))]) for k in range(len(w) - min(5, len(w)) + 1) if w} for w in (WORD.findall((t or "").lower()) for _, t in rows)]
    near = lambda a, b: a and b and 100 * len(a & b) >= 75 * len(a | b)
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if near(sets[a], sets[b]):
                group = [group[b] if g == group[a] else g for g in group]
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs_of(spark, rows), "").collect()]
    of = {row: g for row, g in zip(rows, group) if sets[rows.index(row)]}
    wordless = [row for row, s in zip(rows, sets) if not s]
    assert sorted((r for r in got if r not in of), key=str) == sorted(wordless, key=str)
    assert sorted(of[r] for r in got if r in of) == sorted(set(of.values()))
    for row in got:
        if row in of:
            ids = [i for (i, _), g in zip(rows, group) if g == of[row] and i is not None]
            assert row[0] == min(ids, default=None)


def test_words_of_whole_pages(spark):
    long = "abcdefghij" * 3
    html = ["<title>news</title><style>p {color: red}</style><body class='hidden'>Free&nbsp;win <!-- no --><p>win 1 < 2 net</p><script>var x = '<p>';</script >",
            None, "", f"<p>free theran {long}</p><SCRIPT src=a>bad", "plain free"]
    pages = spark.createDataFrame([(h,) for h in html], "html string")
    got = {r.word: r.n for r in urls.unigrams(pages).collect()}
    assert got == {"news": 1, "free": 3, "win": 2, "net": 1, "theran": 1, long: 1, "plain": 1}
    counts = spark.createDataFrame([("free", 70), ("win", 80), ("net", 9), (long, 5), ("the", 500), ("a", 300)], "word string, n long")
    labels = spark.createDataFrame([("freewin",), (f"win{long}net",), ("q" * 40,), ("z",)], "label string")
    split = {r.label: r.words for r in urls.segmented(labels, counts).collect()}
    assert split == {"freewin": ["free", "win"], f"win{long}net": ["win", long, "net"], "q" * 40: ["q" * 40], "z": ["z"]}


def test_host_words_in_no_title(spark):
    rows = [(k, f"http://freewin{k % 3}.com/p", "<title>x</title><body>free net win free win " + "other words here " * 9) for k in range(6)]
    df = spark.createDataFrame([(*r,) for r in rows], "page_id long, url string, html string")
    labels = spark.createDataFrame([("freewin",), ("winnet",)], "label string")
    assert {r.label: r.words for r in urls.segmented(labels, urls.unigrams(df)).collect()} == {"freewin": ["free", "win"], "winnet": ["win", "net"]}
    assert urls.judged(df).count() == 6


def all_splits(word):
    if not word:
        yield []
    for k in range(1, len(word) + 1):
        for rest in all_splits(word[k:]):
            yield [word[:k], *rest]


def test_url_verdicts_in_plain_python(spark):
    """Every split of a host's words is priced, and Bayes is counted by hand."""
    rng = np.random.default_rng(12)
    vocabulary = ["casino", "win", "free", "news", "paper", "art", "a", "cat"]
    texts = [" ".join(rng.choice(vocabulary, rng.integers(3, 12))) for _ in range(60)]
    ends = [".com/de/", ".com/fr/", ".org/", ".net/", ".info/x/"]
    rows = [(k, f"http://{''.join(rng.choice(vocabulary, rng.integers(1, 3)))}{ends[k % 5]}{rng.choice(vocabulary)}{rng.integers(0, 3)}", f"<p>{t}</p>")
            for k, t in enumerate(texts)]
    rows += [(100, "http://xzq.net/7", None), (101, rows[3][1], "<p>cat</p>"), (102, None, "cat cat"), (3, rows[3][1], rows[3][2])]
    counts = Counter(w for *_, h in rows for w in re.findall("[a-z]+", re.sub("<[^>]*>", " ", h or "")))
    total = sum(counts.values())

    def price(word):
        known = np.log(counts[word] / total) if word in counts else -np.inf
        return max(known, np.log(10 / total) - len(word) * np.log(10))

    def tokens(host, path):
        out = []
        for label in re.findall("[a-z]+", host):
            out += ["host:" + w for w in max(all_splits(label), key=lambda split: sum(map(price, split)))]
        return out + ["path:" + ("#" if w.isdigit() else w) for w in re.findall("[a-z]+|[0-9]+", path)]

    def said(host, path):
        fit = [(len(t), v) for v, t in urls.RULES
               if (host == t.split("/")[0] or host.endswith("." + t.split("/")[0])) and path.startswith(t[t.index("/"):])]
        return max(fit)[1] if fit else None

    pages = [(i, *plain(u)) for i, u, _ in rows]
    held = [(i, tokens(h, p), said(h, p)) for i, h, p in pages]
    seen = {v: Counter(t for _, ts, s in held if s == v for t in ts) for v in ("allow", "block")}
    size = len({t for _, ts, _ in held for t in ts})
    prior = np.log(sum(s == "allow" for *_, s in held) / sum(s == "block" for *_, s in held))
    odds = lambda t: (np.log((seen["allow"][t] + 1) / (seen["allow"].total() + size))
                      - np.log((seen["block"][t] + 1) / (seen["block"].total() + size)))
    want = sorted((i, s or ("allow" if prior + sum(map(odds, ts)) >= 0 else "block"), round(prior + sum(map(odds, ts)), 4)) for i, ts, s in held)
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted((r.page_id, r.verdict, round(r.score, 4)) for r in urls.judged(df).collect()) == want
    assert len({v for i, v, _ in want if i in {i for i, _, s in held if s is None}}) == 2  # both without a rule


def test_additive_scores_in_plain_python(spark, sf_dir):
    """Every row's score is the sum of one entry of each table."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    stats = statistics.described(docs).select("doc_id", "features")
    model = additive.AdditiveModel.fit(*statistics.training_rows(stats, labels, additive.SAMPLE))
    again = additive.AdditiveModel.fit(*statistics.sampled_rows(docs, labels, additive.SAMPLE))
    place = lambda value, edges: sum(float(value) > e for e in edges)
    got = {r.doc_id: r.score for r in additive.scored(docs, labels).collect()}
    for r in docs.collect():
        x = statistics.describe(np.frombuffer((r.text or "").encode(), np.uint8))[1]
        total = model.base + sum(table[place(v, e)] for v, e, table in zip(x, model.edges, model.tables))
        total += sum(table[place(x[a], model.coarse[a])][place(x[b], model.coarse[b])] for (a, b), table in zip(model.pairs, model.pair_tables))
        assert np.isclose(got[r.doc_id], 1 / (1 + np.exp(-total)), atol=1e-9)
    assert np.allclose(again.score(np.zeros((1, 17), np.float32)), model.score(np.zeros((1, 17), np.float32))) and again.pairs == model.pairs
    assert {r.doc_id for r in additive.accepted(docs, labels).select("doc_id").collect()} == {i for i, p in got.items() if p >= additive.LIMIT}


def test_forest_in_plain_python(spark, sf_dir):
    """Paths are walked node by node, and every limit between two scores is tried."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    x, y = statistics.training_rows(statistics.described(docs).select("doc_id", "features"), labels, isolation.SAMPLE)
    forest = isolation.fitted(x, y)

    def anomaly(row):
        total = 0.0
        for feature, cut, child, depth in zip(forest.feature, forest.cut, forest.child, forest.depth):
            node = 0
            while feature[node] >= 0:
                node = child[node][int(row[feature[node]] > cut[node])]
            total += depth[node]
        return 2.0 ** (-total / len(forest.feature) / forest.normal)

    got = {r.doc_id: r for r in isolation.judged(docs, labels).collect()}
    for r in docs.collect():
        row = statistics.describe(np.frombuffer((r.text or "").encode(), np.uint8))[1]
        assert np.isclose(got[r.doc_id].anomaly, anomaly(row), atol=1e-9)
        assert got[r.doc_id].kept == (not got[r.doc_id].base_failed and got[r.doc_id].anomaly <= forest.limit)
    half = (np.arange(len(y)) % 2 == 0) & (y == 1)
    scores, good = np.array([anomaly(row) for row in x[~half]]), y[~half] == 1
    gain = lambda limit: (scores[good] <= limit).mean() + (scores[~good] > limit).mean()
    assert np.isclose(gain(forest.limit), max(gain(limit) for limit in scores))


def test_forest_learns_from_all_rows(spark, sf_dir, monkeypatch):
    """All labelled rows set the limit and may be in trees, however many there are."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    stats = statistics.described(docs).select("doc_id", "features")
    x, y = statistics.training_rows(stats, labels, 10**6)
    plain, got = isolation.fitted(x, y), isolation.fitted_on(stats, labels)
    assert got.limit == plain.limit and (got.cut == plain.cut).all() and (got.feature == plain.feature).all()
    rows = statistics.labelled_rows(stats, labels)
    assert sorted(r.place for r in rows.collect()) == list(range(len(y)))
    # More good rows than all trees take: each tree has its own, drawn from all.
    taken, fit = [], isolation.IsolationForest.fit
    monkeypatch.setattr(isolation, "TREES", 3)
    monkeypatch.setattr(isolation, "ROWS", 8)
    monkeypatch.setattr(isolation.IsolationForest, "fit", lambda x, **more: taken.append((len(x), more)) or fit(x, **more))
    forest = isolation.fitted_on(stats, labels)
    assert taken == [(24, {"dealt": True})] and len(forest.feature) == 3
    rest = ~((np.arange(len(y)) % 2 == 0) & (y == 1))
    forest.calibrate(x[rest], y[rest] == 1)
    assert forest.limit == isolation._limit(rows.where("place % 2 = 1 or quality <> 1"), forest)


def test_pipeline_in_plain_python(spark, sf_dir):
    """All five stages over the whole table, each written down again without Spark."""
    import base64
    import hashlib
    from collections import defaultdict

    import public_tokenizers
    import tiktoken

    from foliospark.llm import secrets
    docs = [(r.doc_id, r.text or "", r.source, r.lang) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    model = additive.AdditiveModel.fit(*statistics.sampled_rows(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"), additive.SAMPLE))
    features = np.array([statistics.describe(np.frombuffer(t.encode(), np.uint8))[1] for _, t, *_ in docs], np.float32)
    docs = [d for d, p in zip(docs, model.score(features)) if p >= additive.LIMIT]

    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    grams = lambda w: [tuple(w[i:i + min(5, len(w))]) for i in range(len(w) - min(5, len(w)) + 1)] if w else []
    sets = [set(grams(WORD.findall(lower(t)))) for _, t, *_ in docs]
    group = list(range(len(docs)))
    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and group[a] != group[b]:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    first = {}
    for (i, *_), g in zip(docs, group):
        first[g] = min(first.get(g, i), i)
    docs = [d for d, g, s in zip(docs, group, sets) if not s or d[0] == first[g]]

    items = [Counter(grams(WORD.findall(lower(r.text or "")))) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    by_size = defaultdict(list)
    for item in items:
        if item:
            by_size[item.total() + 4 if len(next(iter(item))) == 5 else len(next(iter(item)))].append(item)
    known = {g for item in items for g in item}

    def leaks(text):
        words = WORD.findall(lower(text))
        if not known & set(grams(words)):
            return False  # all items have five words or more
        for n, own in by_size.items():
            for at in range(max(len(words) - n, 0) + 1):
                window = Counter(grams(words[at:at + n]))
                if any(100 * (window & item).total() >= 75 * (window | item).total() for item in own):
                    return True
        return False

    assert min(by_size) >= 5
    docs = [d for d in docs if not leaks(d[1])]

    patterns = [re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A),
                re.compile("AKIA[A-Z0-9]{16,}"), re.compile("[0-9a-f]{24,}"), re.compile("(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{24,}")]
    found = []
    for i, text, source, lang in docs:
        base = [(m.start(), m.end(), m[2]) for m in patterns[0].finditer(text) if len(m[2]) >= 6]
        base += [(m.start(), m.end(), m[0]) for p in patterns[1:3] for m in p.finditer(text)]
        odd = [(m.start(), m.end(), m[0]) for m in patterns[3].finditer(text) if all(re.search(c, m[0]) for c in ("[0-9]", "[a-z]", "[A-Z]"))]
        found.append(base + [o for o in odd if not any(b[0] < o[1] and o[0] < b[1] for b in base)])
    holders = defaultdict(set)
    for (_, _, source, lang), spans in zip(docs, found):
        for *_, value in spans:
            holders[value].add((source, lang))
    copied = {v for v, h in holders.items() if len({s for s, _ in h}) >= secrets.OWNERS or len(h) >= secrets.REPOSITORIES}
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    tik = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for (i, text, *_), spans in zip(docs, found):
        out, at = "", 0
        for a, b, value in sorted(s for s in spans if s[2] not in copied):
            if a >= at:
                out += text[at:a] + secrets.MARK
            at = max(at, b)
        out += text[at:]
        ids = tik.encode_ordinary(out)
        want.append((i, len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(), hashlib.sha256(out.encode()).hexdigest()))
    got = [tuple(r)[:4] for r in corpus_pipeline.run(spark, sf_dir).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()]
    assert sorted(got) == sorted(want)


def test_empty_pipeline(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

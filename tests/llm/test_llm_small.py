"""BPE, sharding and chat formatting."""

import base64
import hashlib
import random
import zlib

import pytest
import public_tokenizers
import tiktoken

from foliospark.llm import bpe, chat, sharding

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
DOCS = "doc_id long, text string, ids string, slot int, size string"
ODD = ["", " ", "\n\n  a", "don't stop!!  12345 × ñandú 日本語 🙂🙂", "<|endoftext|>", "a" * 3000, " " * 300, "=" * 500 + "x", "thhe" * 40, "　  x"]


@pytest.fixture(scope="module")
def tik():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_rows(spark, tik):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, "the end"), (7, None), (7, "x"), (7, "x")]
    df = spark.createDataFrame([(i, t, "a", 1, "b") for i, t in rows], DOCS)
    got = sorted(map(tuple, bpe.encoded(df, PATH, public_tokenizers.PATTERN).collect()), key=str)
    want = []
    for i, t in rows:
        ids = tik.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe.encoded(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_prefix_table(tik):
    rng = random.Random(1)
    v = bpe.Vocabulary.read(PATH)
    for _ in range(60):
        piece = "".join(rng.choice(["th", "e", "an", "ing", "é", "x", "q"]) for _ in range(rng.randrange(1, 30))).encode()
        table = bpe.PrefixTable(v)
        for k in range(0, len(piece), 3):
            table.append(piece[k:k + 3])
        assert table.ids() == v.merged(piece)
        a = rng.randrange(len(piece))
        b = rng.randrange(a, len(piece) + 1)
        table.edit(a, b, b"tion")
        assert table.piece == piece[:a] + b"tion" + piece[b:] and table.ids() == v.merged(table.piece)
        table.cut(a)
        assert table.ids() == v.merged(piece[:a])


def test_bpe_query(spark, sf_dir, tik):
    from foliospark.llm.queries import QUERIES
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in QUERIES["op10_bpe"](spark, sf_dir).collect():
        assert r.n_tokens == len(tik.encode_ordinary(texts[r.doc_id]))
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_shards(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/../sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = sharding.sharded(docs).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    load = [0] * 24
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
        load[r.shard] += r.size
    assert max(load) - min(load) < max(r.size for r in rows) and max(load) < 1.02 * sum(load) / 24 + max(r.size for r in rows) / 2
    for shard in range(24):
        places = sorted(r.slot for r in rows if r.shard == shard)
        assert places == list(range(len(places)))


def test_shards_of_odd_rows(spark, tmp_path):
    rows = [(None, None, "a", 1, "b")] * 3 + [(1, "", "a", 2, "c"), (1, "é" * 100_000, None, None, None), (2, "x", "", 0, "")] * 2
    df = spark.createDataFrame(rows, DOCS)
    path = str(tmp_path / "map")
    got = sharding.sharded(df, 3, 64, path).collect()
    assert len(got) == 9 and {r.size for r in got} == {8, 200_008, 9}
    assert {r.text_crc32 for r in got if r.doc_id is None} == {0}
    assert sharding.SlotMap.load(spark, path, 0) == sharding.SlotMap.dealt(3, 64)
    assert sharding.SlotMap.load(spark, path, 1).version == 1
    assert sharding.sharded(df.limit(0), 3, 64).count() == 0


def test_law_holds_for_repeated_rows(spark):
    """A third of all rows is one row: the shards stay as equal as whole slots allow."""
    rows = [(None, "copy" * 25, "a", 1, "b")] * 2000 + [(k, "t" * (50 + k % 100), "a", 1, "b") for k in range(4000)] + [(7, "seven", "a", 1, "b")] * 70
    got = sharding.sharded(spark.createDataFrame(rows, DOCS).repartition(7)).collect()
    load, places = [0] * 24, [[] for _ in range(24)]
    for r in got:
        load[r.shard] += r.size
        places[r.shard].append(r.slot)
    assert len(got) == len(rows) and max(load) - min(load) <= max(r.size for r in got)
    assert all(sorted(p) == list(range(len(p))) for p in places)
    again = sharding.sharded(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.size, r.virtual_slot, r.shard, r.slot)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_map_in_plain_python(spark, sf_dir):
    """The stored map is what moving one slot at a time from the heaviest to the lightest shard gives."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sharding.sharded(docs, 5, 64).collect()
    weight = [sum(r.size for r in rows if r.virtual_slot == s) for s in range(64)]
    place = [s % 5 for s in range(64)]
    while True:
        load = [sum(w for w, p in zip(weight, place) if p == shard) for shard in range(5)]
        high, low = load.index(max(load)), load.index(min(load))
        gap = load[high] - load[low]
        mine = [s for s in range(64) if place[s] == high and weight[s]]
        best = min(mine, key=lambda s: (abs(2 * weight[s] - gap), weight[s], s), default=None)
        if best is not None and weight[best] < gap:
            place[best] = low
            continue
        swaps = [(abs(2 * (weight[a] - weight[b]) - gap), a, b) for a in mine for b in range(64)
                 if place[b] == low and weight[b] and 0 < weight[a] - weight[b] < gap]
        if not swaps:
            break
        _, a, b = min(swaps)
        place[a], place[b] = low, high
    assert {(r.virtual_slot, r.shard) for r in rows} == {(s, p) for s, p in enumerate(place) if weight[s]}


def test_rebalancing_moves_little():
    even = sharding.SlotMap.dealt(4, 400)
    assert even.rebalanced({s: 10 for s in range(400)}, 4).shards == even.shards
    grown = even.rebalanced({s: 10 for s in range(400)}, 5)
    moved = [s for s in range(400) if grown.shards[s] != even.shards[s]]
    assert len(moved) == 80 and all(grown.shards[s] == 4 for s in moved)



def test_pairs(spark):
    sys, ask, yes, no = ("system", "s"), ("user", "q<|im_end|>"), ("assistant", "yes"), ("assistant", "nö")
    rows = [(1, [sys, ask, yes], [sys, ask, no, ask]), (2, [ask, yes], [ask, yes]), (3, [ask], [ask, yes]), (4, None, [ask]),
            (None, [], []), (5, [(None, None), yes], [(None, None), no]), (6, [ask, yes], [yes, ask]), (6, [ask, yes], [yes, ask])]
    df = spark.createDataFrame([(*r, "p", 1) for r in rows], f"pair_id long, chosen {chat.TURNS}, rejected {chat.TURNS}, prompt string, text int")

    def write(turns):
        out, spans = "", []
        for role, text in turns or []:
            out += f"<|im_start|>{role or ''}\n"
            start = len(out)
            out += (text or "").replace("<|", "< |") + "<|im_end|>\n"
            if role == "assistant":
                spans.append(f"{start}:{len(out)}")
        return out, ",".join(spans)

    want = []
    for i, c, r in rows:
        c, r = c or [], r or []
        n = 0
        while n < min(len(c), len(r)) and c[n] == r[n]:
            n += 1
        want.append((i, n, write(c[:n])[0], *write(c[n:]), *write(r[n:])))
    assert sorted(map(tuple, chat.format_pairs(df).collect()), key=str) == sorted(want, key=str)
    assert chat.format_pairs(df.limit(0)).count() == 0


def test_answer_pairs(spark):
    turns = [(0, 0, "user", "a", 1), (0, 1, "assistant", "b", 1), (1, 0, "assistant", "c", 1), (1, 1, "user", "d", 1),
             (2, 0, "user", None, 1), (4, 1, "assistant", "x", 1), (4, 1, "assistant", "x", 1)]
    lone = [(None, None, None, None, 1), (None, 1, "assistant", "y", 1), (None, 1, "assistant", "y", 1), (None, 0, "user", "z", 1)]
    df = spark.createDataFrame(turns + lone, "conv_id long, turn long, role string, text string, turns int")
    rows = [(r.pair_id, [t.text for t in r.chosen], [t.text for t in r.rejected]) for r in chat.answer_pairs(df).collect()]
    assert {i: r for i, _, r in rows if i is not None} == {0: ["a", "c"], 1: ["b", "d"], 2: [None], 4: ["x", ""]}
    # Rows without a conversation are conversations of their own and nobody's neighbour.
    assert sorted(((c, r) for i, c, r in rows if i is None), key=str) == sorted([([None], [None]), (["y"], [""]), (["y"], [""]), (["z"], ["z"])], key=str)
    formed = [tuple(r) for r in chat.format_pairs(chat.answer_pairs(df.where("conv_id is null"))).collect()]
    assert sum(r[3] != r[5] for r in formed) == 2
    assert chat.answer_pairs(df.limit(0)).count() == 0


def test_pairs_against_sql(spark):
    import duckdb
    from foliospark.llm.oracle import ORACLE
    rng = random.Random(3)
    turns = [(rng.choice([None, *range(12)]), t, rng.choice(["user", "assistant"]), f"text {rng.randrange(4)}") for t in range(120)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    con = duckdb.connect()
    conversations = df.toPandas().astype({"conv_id": "Int64"})  # noqa: F841
    con.execute("create table conversations as select * from conversations")
    got = chat.format_pairs(chat.answer_pairs(df))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, con.sql(ORACLE["op1_chat"]).select(*got.columns).fetchall()))

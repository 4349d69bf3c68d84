"""b-bit MinHash near-duplicates: bands name candidates, packed low bits estimate, full sets confirm.

``signatures`` takes 128 minima of a document's distinct 5-word shingles.
Bands of four whole minima become bucket keys (a pair at similarity 0.75 misses
all 32 with a probability of 5e-6); of each minimum only the lowest ``bits`` are
kept, packed into longs.  For a candidate pair the share of equal low bits,
corrected for chance (``2^-bits``), estimates the similarity; only pairs far
below the limit (six standard deviations) are left unconfirmed.

No bucket is paired out.  Documents with equal sets are one node.  In each
bucket the nodes are compared with its smallest node, the links give
components, and buckets that then hold a single component are done.  The rest
is compared with another of its nodes, as long as that helps.

What is left are mostly documents around one passage or one text that are not
near enough to each other.  Their buckets are joined to clusters, where pairs
are ruled out without being made (``_across``).  No pair at the limit that meets
in a bucket is left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from foliospark.llm.common import binary_values, discarded, give_back, mixed, paired, row_key, small, stored

WORDS, PERCENT = 5, 75
MINIMA, BAND, BITS = 128, 4, 2
#: Comparing with further nodes ends when a bucket's members would take this many comparisons each, or fewer.
FEW = 48
#: Longs that hold a set's odd shingles as bits, a power of two.
LONGS = 32
#: Most turns of comparing with one node of each bucket; what is left then goes on to clusters.
ROUNDS = 8

_U = np.uint64
_BYTE = np.random.default_rng(5).integers(1, 2**63, 256, dtype=np.uint64)
_PLACE = np.random.default_rng(6).integers(1, 2**63, 1 << 16, dtype=np.uint64) | _U(1)
_SEEDS = np.random.default_rng(7).integers(1, 2**63, (2, MINIMA), dtype=np.uint64) | _U(1)
_STEP = np.random.default_rng(8).integers(1, 2**63, 64, dtype=np.uint64) | _U(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(text: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each word (run of bytes other than ASCII white space), A-Z lower-cased."""
    if not len(text):
        return np.zeros(0, _U)
    if lower:
        text = _LOWER[text]
    inside = np.concatenate([[False], ~_SPACE[text], [False]])
    edge = np.nonzero(inside[1:] != inside[:-1])[0]
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, _U)
    at = np.arange(len(text)) - np.repeat(np.concatenate([[0], start]), np.diff(np.concatenate([[0], start, [len(text)]])))
    weight = _PLACE[at & 0xFFFF] + (at >> 16).astype(_U)
    value = _BYTE[text] * weight
    value[_SPACE[text]] = 0
    return mixed(np.add.reduceat(value, start) + (end - start).astype(_U))


def shingle_hashes(words: np.ndarray, size: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of ``size``-word shingles; fewer words are one shingle, none is the empty set."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    total = np.full(n, size, dtype=_U)
    for k in range(size):
        total += words[k:k + n] * _STEP[k]
    return np.unique(mixed(total))


def _minima(shingles: np.ndarray) -> np.ndarray:
    low = np.full(MINIMA, np.iinfo(np.uint64).max, dtype=_U)
    for a in range(0, len(shingles), 512):
        part = _SEEDS[0][:, None] * shingles[None, a:a + 512]
        part += _SEEDS[1][:, None]
        np.minimum(low, part.min(axis=1), out=low)
    return low >> _U(32)


def _packed(minima: np.ndarray, bits: int) -> list[int]:
    """The lowest ``bits`` of each minimum, packed."""
    each = 64 // bits
    low = (minima & _U((1 << bits) - 1)).reshape(-1, each) << (np.arange(each, dtype=_U) * _U(bits))
    return np.bitwise_or.reduce(low, axis=1).view(np.int64).tolist()


_SIGNATURE = pa.schema([
    ("doc_id", pa.int64()), ("row", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()),
    ("bands", pa.list_(pa.int64())), ("packed", pa.list_(pa.int64())),
])
_SIGNATURE_DDL = "doc_id long, row long, n_shingles long, digest binary, bands array<long>, packed array<long>"


def _signature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    which = mixed(np.arange(1, MINIMA // BAND + 1, dtype=_U))
    for batch in batches:
        n, digests, bands, packed = [], [], [], []
        for text in binary_values(batch.column("bytes")):
            shingles = shingle_hashes(word_hashes(text))
            n.append(len(shingles))
            digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
            if len(shingles):
                low = _minima(shingles)
                key = which
                for k in range(BAND):
                    key = paired(key, low[k::BAND])
                bands.append(key.view(np.int64).tolist())
                packed.append(_packed(low, BITS))
            else:
                bands.append(None)
                packed.append(None)
        columns = [batch.column("doc_id"), batch.column("row"), n, digests, bands, packed]
        yield pa.RecordBatch.from_arrays(
            [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, _SIGNATURE)], schema=_SIGNATURE
        )
        del batch, columns, n, digests, bands, packed
        give_back()


_SET = pa.schema([("node", pa.int64()), ("shingles", pa.list_(pa.int64()))])


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, sets, size = [], [], 0
        for node, text in zip(batch.column("node").to_pylist(), binary_values(batch.column("bytes"))):
            nodes.append(node)
            sets.append(shingle_hashes(word_hashes(text)).view(np.int64))
            size += len(sets[-1])
            if size > 500_000:
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, _SET.field(1).type)], schema=_SET)
                nodes, sets, size = [], [], 0
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, _SET.field(1).type)], schema=_SET)
        del batch, nodes, sets
        give_back()


def signatures(documents: DataFrame) -> DataFrame:
    """``doc_id, row, n_shingles, digest, bands, packed`` per row of ``documents (doc_id, text)``."""
    return documents.select(
        "doc_id", row_key("doc_id", "text").alias("row"), F.coalesce("text", F.lit("")).cast("binary").alias("bytes")
    ).mapInArrow(_signature_rows, _SIGNATURE_DDL)


def estimated(a: str, b: str, bits: int = BITS, minima: int = MINIMA) -> Column:
    """Similarity estimated from two packed signatures: equal low bits, less those equal by chance."""
    mask = {1: -1, 2: 0x5555555555555555, 4: 0x1111111111111111}[bits]

    def unequal(x: Column) -> Column:
        for shift in {1: (), 2: (1,), 4: (1, 2)}[bits]:
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        return F.bit_count(x.bitwiseAND(F.lit(mask).cast("long")))

    longs = minima * bits // 64
    wrong = sum((unequal(F.get(F.col(a), F.lit(k)).bitwiseXOR(F.get(F.col(b), F.lit(k)))) for k in range(longs)), F.lit(0))
    chance = 2.0 ** -bits
    return ((minima - wrong) / F.lit(float(minima)) - chance) / (1 - chance)


def least_estimate(percent: int = PERCENT, bits: int = BITS, minima: int = MINIMA) -> float:
    """The estimate that a pair at ``percent`` falls below with a probability of about 1e-9."""
    chance = 2.0 ** -bits
    share = percent / 100 + (1 - percent / 100) * chance
    return percent / 100 - 6 * (share * (1 - share) / minima) ** 0.5 / (1 - chance)


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for the ends of ``edges (a, b)``.

    Each round takes the smallest label among neighbours and then the label's
    own label, so the rounds grow with the logarithm of the longest path.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.where("a != b").distinct(), "edges")
    label = stored(both.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("component")), "labels")
    while True:
        names = small(label).select("node", "component")
        near = both.join(names.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("component").alias("near"))
        low = names.join(near, "node").select("node", F.least("component", "near").alias("low"), "component")
        own = names.select(F.col("node").alias("low"), F.col("component").alias("next"))
        after = stored(low.join(own, "low", "left").select(
            "node", F.least("low", "next").alias("component"),
            (F.least("low", "next") < F.col("component")).alias("moved"),
        ), "labels")
        still = after.where("moved").isEmpty()
        discarded(label)
        label = after
        if still:
            discarded(both)
            return label


def _confirmed(pairs: DataFrame, packs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Those of the stored ``pairs (node, hub)`` whose full shingle sets reach the limit; few nodes are hubs."""
    packed = small(packs).select("node", "packed")
    likely = stored(
        pairs.join(packed.withColumnRenamed("packed", "mine"), "node")
        .join(packed.select(F.col("node").alias("hub"), F.col("packed").alias("theirs")), "hub")
        .where(estimated("mine", "theirs") >= least_estimate(percent)).select("node", "hub"), "likely",
    )
    wanted = stored(likely.select(F.col("hub").alias("node")).distinct(), "hubs")
    hubs = stored(full.join(small(wanted), "node").select(F.col("node").alias("hub"), F.col("shingles").alias("others")), "hubs")
    common = F.size(F.array_intersect("shingles", "others"))
    sized = full.join(small(likely), "node").join(small(hubs), "hub").select(
        "node", "hub", common.alias("common"), (F.size("shingles") + F.size("others") - common).alias("joint"))
    found = stored(sized.where(F.col("common") * 100 >= F.col("joint") * percent).select(
        F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")), "links")
    discarded(likely, wanted, hubs)
    return found


def _labelled(members: DataFrame, label: DataFrame) -> DataFrame:
    """``members`` with the components of their nodes; a node without a link is its own."""
    return members.drop("component").join(small(label).select("node", "component"), "node", "left").withColumn("component", F.coalesce("component", "node"))


def _open(members: DataFrame, turn: int) -> DataFrame:
    """``bucket, n, hub, hub_component`` of the buckets that hold several components; one pass over ``members``.

    The hub is the node all others of a bucket are compared with; the order is the same everywhere, so pairs recur.
    """
    hub = F.min_by(F.struct("node", "component"), F.xxhash64("node", F.lit(turn)))
    found = members.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("n"), hub.alias("m")).where("low < high")
    return stored(found.select("bucket", "n", F.col("m.node").alias("hub"), F.col("m.component").alias("hub_component")), "open")


def _work(groups: DataFrame) -> float:
    """Comparisons a member would take if the buckets were paired out."""
    n = F.col("n").cast("double")
    found = groups.agg(F.sum(n * n).alias("pairs"), F.sum(n).alias("rows")).first()
    return found.pairs / found.rows if found.rows else 0.0


class _Links:
    """The components of the links found so far."""

    def __init__(self, packs: DataFrame, full: DataFrame, percent: int):
        self.packs, self.full, self.percent = packs, full, percent  # of nodes that share a bucket
        self.label: DataFrame | None = None

    def add(self, links: DataFrame) -> None:
        """Join the components that stored ``links (a, b)`` connect; what was found before is one node for each component."""
        if self.label is None:
            self.label = components(links)
            discarded(links)
            return
        old, name = self.label, small(self.label)
        ends = links
        for end in ("a", "b"):
            known = name.select(F.col("node").alias(end), F.col("component").alias("whole"))
            ends = ends.join(known, end, "left").withColumn(end, F.coalesce("whole", end)).drop("whole")
        between = stored(ends.where("a != b").distinct(), "links")
        if not between.isEmpty():
            merged = components(between)
            into = small(merged).select(F.col("node").alias("component"), F.col("component").alias("into"))
            told = old.select("node", "component").join(into, "component", "left").select("node", F.coalesce("into", "component").alias("component"))
            first = merged.select("node", "component").join(name.select("node"), "node", "left_anti")
            self.label = stored(told.unionByName(first), "labels")
            discarded(merged, old)
        discarded(links, between)

    def compared(self, members: DataFrame, groups: DataFrame, least_turns: int,
                 possible: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame, float]:
        """Compare the nodes of each bucket of ``members (bucket, node, component, ..)`` with its hub, turn by turn.

        Ends when a member's bucket would take few comparisons or the last turn
        did not help.  Gives the members of buckets that still hold several
        components, those buckets, and the comparisons left.  ``possible`` takes
        members with their ``hub`` and leaves those that can be linked with it.
        """
        rest, work = members, None if least_turns else _work(groups)
        for turn in range(ROUNDS):
            if turn >= least_turns and work <= FEW:
                break
            met = rest.join(small(groups), "bucket").where("component != hub_component")
            pairs = stored((possible(met) if possible else met).select("node", "hub").distinct(), "pairs")
            self.add(_confirmed(pairs, self.packs, self.full, self.percent))
            labelled = _labelled(rest, self.label)
            after = _open(labelled, turn + 1)
            left = stored(labelled.join(small(after).select("bucket"), "bucket"), "unsettled")
            discarded(pairs, groups, rest)
            groups, rest = after, left
            before, work = work, _work(groups)
            if not work or before is not None and work > 0.8 * before:
                break
        return rest, groups, work


def _across(rest: DataFrame, groups: DataFrame, found: _Links) -> None:
    """Find all links between different components in the buckets of ``rest (bucket, node, component)``.

    Buckets with one hub make a cluster.  A set differs from the
    cluster's core (that node's set, corrected by what most members have
    otherwise) by ``r`` shingles, own ones and lacking ones, its *odd* shingles.
    With sizes ``n`` and the limit in percent ``p``, two sets are linked if and
    only if they differ by ``d`` with ``(100 + p) * d <= (100 - p) * (n1 + n2)``.

    1. They differ by ``r1 + r2`` at most, so their slacks ``(100 - p) * n -
       (100 + p) * r`` decide: with a sum of 0 or more they are linked.  Whoever
       has such a partner has one in the cluster's set of greatest slack.
    2. All other linked pairs differ by less than ``r1 + r2``, so they share an
       odd shingle.  As they differ by ``n1 * (100 - p) / p`` at most, they share
       one among the first ``n * (100 - p) / p + 1`` of either's odd shingles in
       one order, here the rarest first.  Shingles that one set alone has odd
       take their places there and lead to no pair.  They also share as many as
       ``_shared_least`` says, none of them before the first one.  So a set
       needs an odd shingle only if that many are left from it on, for the
       partner of greatest slack in the cluster and then in the group of equal
       odd shingles, of another component.  These groups are compared with one
       of their nodes as buckets are; of the rest a pair is made if its
       difference, bounded by the odd shingles as bits, can be within the
       limit, and confirmed on the full sets.
    """
    p, full = found.percent, found.full
    members = stored(rest.join(small(groups), "bucket").select(F.col("hub").alias("cluster"), "node", "component").distinct(), "clusters")
    number = stored(members.groupBy("cluster").agg(F.count(F.lit(1)).alias("members")), "sizes")
    cores = stored(full.join(small(number).select(F.col("cluster").alias("node")), "node").select(
        F.col("node").alias("cluster"), F.col("shingles").alias("core")), "cores")
    odd = stored(full.join(small(members), "node").join(small(cores), "cluster").select(
        "cluster", "node", "component", F.size("shingles").alias("size"),
        F.concat(F.array_except("shingles", "core"), F.array_except("core", "shingles")).alias("odd")), "odd")
    each = odd.select("cluster", "node", F.explode("odd").alias("shingle"))
    often = stored(each.groupBy("cluster", "shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1").join(small(number), "cluster").select(
        "cluster", "shingle", "n", (2 * F.col("n") > F.col("members")).alias("most")), "often")
    # What more than half of the members have odd belongs to the core, and is odd in the others.
    turned = stored(often.where("most").groupBy("cluster").agg(F.sort_array(F.collect_list("shingle")).alias("turned")), "turned")
    entry = F.struct("n", "shingle")
    held = each.join(small(often), ["cluster", "shingle"]).groupBy("cluster", "node").agg(
        F.sort_array(F.collect_list(F.when(~F.col("most"), entry))).alias("rare"), F.collect_list(F.when(F.col("most"), F.col("shingle"))).alias("mine"))
    known = odd.join(held, ["cluster", "node"], "left").join(small(turned), "cluster", "left")
    none = F.array().cast("array<bigint>")
    rare = F.transform(F.coalesce("rare", F.array().cast("array<struct<n:bigint,shingle:bigint>>")), lambda x: x["shingle"])
    # Any one order of the shingles is right; rare ones first makes few meet.
    listed = F.concat(rare, F.array_except(F.coalesce("turned", none), F.coalesce("mine", none)))
    seen = F.coalesce(F.size("rare"), F.lit(0)) + F.coalesce(F.size("mine"), F.lit(0))
    profiles = known.select("cluster", "node", "component", "size", (F.size("odd") - seen).alias("alone"), listed.alias("listed"))
    slack = (100 - p) * F.col("size") - (100 + p) * (F.col("alone") + F.size("listed"))
    profiles = stored(profiles.withColumn("slack", slack), "profiles")
    discarded(members, number, cores, odd, often, turned)
    top = stored(profiles.groupBy("cluster").agg(F.max("slack").alias("best"), F.max_by("node", "slack").alias("hub")), "tops")
    sure = profiles.join(small(top), "cluster").where((F.col("slack") + F.col("best") >= 0) & (F.col("node") != F.col("hub")))
    found.add(stored(sure.select(F.col("node").alias("a"), F.col("hub").alias("b")), "links"))
    labelled = _labelled(profiles, found.label)
    # Members are told apart by whether they are in the component of the greatest slack; without others a cluster is done.
    parts = stored(labelled.groupBy("cluster", "component").agg(F.max("slack").alias("slack")), "parts")
    lead = stored(parts.groupBy("cluster").agg(F.max_by("component", "slack").alias("lead")), "leads")
    leads = F.col("component") == F.col("lead")
    several = stored(parts.join(small(lead), "cluster").groupBy("cluster", "lead").agg(
        F.max(F.when(leads, F.col("slack"))).alias("best"), F.max(F.when(~leads, F.col("slack"))).alias("second")).where("second is not null"), "several")
    left = stored(labelled.join(small(several), "cluster").withColumn("leads", leads).drop("lead"), "unsettled")
    needed = _shared_least("slack", F.when(F.col("leads"), F.col("second")).otherwise(F.col("best")), p)
    first = F.least(F.floor(F.col("size") * (100 - p) / p) + 1 - F.col("alone"), F.size("listed") + 1 - needed).cast("int")
    entry = stored(left.where(first > 0).select(
        "cluster", "node", "component", "slack", "leads", F.size("listed").alias("odd"), F.posexplode(F.slice("listed", F.lit(1), first)).alias("at", "shingle")
    ).select(F.xxhash64("cluster", "shingle").alias("bucket"), "cluster", "node", "component", "slack", "leads", (F.col("odd") - F.col("at")).alias("on")), "entries")
    most = lambda which: F.max(F.when(which, F.col("slack")))
    met = stored(entry.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), most(F.col("leads")).alias("best"), most(~F.col("leads")).alias("second")
    ).where("low < high").select("bucket", "best", "second"), "met")
    partner = F.when(F.col("leads"), F.col("second")).otherwise(F.greatest("best", "second"))
    near = stored(entry.join(small(met), "bucket").where(F.col("on") >= _shared_least("slack", partner, p)).select("bucket", "cluster", "node", "component"), "entries")
    discarded(parts, lead, several, entry, met)
    begun = _open(near, 0)
    # A set's odd shingles as bits: two share at most the bits they share and what the set with fewer clashes has in excess.
    known = left.select("cluster", "node", "size", "alone", F.size("listed").alias("odd"), _bits("listed").alias("bits"))
    known = stored(known.withColumn("excess", F.col("odd") - _ones(F.col("bits"))), "odd")

    def possible(met: DataFrame) -> DataFrame:
        """Those that can be near enough to their hub by their odd shingles."""
        met = met.select("cluster", "node", "hub").distinct()
        own, other = (small(known).select("cluster", F.col("node").alias(end), F.struct(*known.columns).alias(side)) for end, side in (("node", "one"), ("hub", "two")))
        return met.join(own, ["cluster", "node"]).join(other, ["cluster", "hub"]).where(_within(p))

    paired_out, groups, _ = found.compared(stored(near.join(small(begun).select("bucket"), "bucket"), "entries"), begun, 0, possible)
    side = stored(paired_out.join(small(known), ["cluster", "node"]), "sides")
    one, two = (lambda c: F.col(f"one.{c}")), (lambda c: F.col(f"two.{c}"))
    # The bound is part of the join: what it rules out is never a row.
    pairs = side.alias("one").join(side.alias("two"), (one("bucket") == two("bucket")) & (one("cluster") == two("cluster"))
                                   & (one("component") < two("component")) & _within(p))
    likely = stored(pairs.select(one("node").alias("node"), two("node").alias("hub")).distinct(), "pairs")
    found.add(_confirmed(likely, found.packs, found.full, p))
    discarded(profiles, top, left, near, known, paired_out, groups, side, likely)


def _shared_least(slack: str, partner: Column, percent: int) -> Column:
    """The fewest odd shingles that sets of these slacks share if they are linked; more for a partner of less slack.

    Linked sets have ``(100 + p) * (r1 + r2 - 2 * shared) <= (100 - p) * (n1 + n2)``, so twice ``100 + p`` for each
    shared one makes up for both slacks.
    """
    return F.ceil(-(F.col(slack) + partner) / (2 * (100 + percent)))


def _within(percent: int) -> Column:
    """Whether the sets ``one`` and ``two`` of a cluster, by their sizes and odd shingles, can reach the limit."""
    one, two = (lambda c: F.col(f"one.{c}")), (lambda c: F.col(f"two.{c}"))
    shared = sum((F.bit_count(F.get(one("bits"), F.lit(k)).bitwiseAND(F.get(two("bits"), F.lit(k)))) for k in range(LONGS)),
                 F.least(one("excess"), two("excess")))
    alone, most = one("alone") + two("alone"), (one("size") + two("size")) * (100 - percent)
    # Cheap to see for most pairs: what one set has odd beyond the number of the other is not shared.
    fewest = alone + F.abs(one("odd") - two("odd"))
    least = alone + one("odd") + two("odd") - 2 * F.least(shared, one("odd"), two("odd"))
    return (fewest * (100 + percent) <= most) & (least * (100 + percent) <= most)


def _bits(names: str) -> Column:
    """Some 64-bit names as one bit each of ``LONGS`` longs."""
    return F.transform(F.sequence(F.lit(0), F.lit(LONGS - 1)), lambda k: F.aggregate(
        F.filter(names, lambda x: x.bitwiseAND(F.lit(LONGS - 1).cast("long")) == k), F.lit(0).cast("long"),
        lambda acc, x: acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(x, 8).bitwiseAND(F.lit(63).cast("long")).cast("int")))))


def _ones(bits: Column) -> Column:
    return F.aggregate(bits, F.lit(0), lambda acc, x: acc + F.bit_count(x))


def near_duplicates(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``documents (doc_id, text)``.

    Documents are linked if ``100 * |A and B| >= percent * |A or B|`` over their
    distinct 5-word shingles (fewer words: the whole sequence as one).  A null or
    wordless text has the empty set and is linked with nothing.  Rows with equal
    sets are linked.  A null id has the component of its links, its own id
    (null) if those have none either, and is kept only in the latter case; rows
    that repeat an id share its links.  Very long texts are read whole.  Other
    columns are not read; an empty table gives an empty result.
    """
    documents = documents.select("doc_id", "text")
    signed = stored(signatures(documents), "signatures")
    wide = stored(
        signed.where("n_shingles > 0").groupBy("digest").agg(
            F.min("doc_id").alias("least"), F.min("row").alias("row"),
            F.first("bands").alias("bands"), F.first("packed").alias("packed"),
        ).withColumn("node", F.coalesce("least", -F.abs(F.xxhash64("digest").bitwiseAND(F.lit(2**62 - 1))) - 2**62)), "nodes",
    )
    # What is needed to the end is kept without signatures.
    rows = stored(signed.select("doc_id", "n_shingles", "digest"), "rows")
    sets = stored(wide.select("digest", "node", "least"), "sets")
    discarded(signed)
    buckets = wide.select("node", F.explode("bands").alias("bucket"))
    # A set is in a bucket once, so buckets of one are done; the smallest node is the first hub.
    shared = stored(buckets.groupBy("bucket").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1").withColumn(
        "hub_component", F.col("hub")), "shared")
    members = stored(buckets.join(small(shared).select("bucket"), "bucket").withColumn("component", F.col("node")), "members")
    some = stored(members.select("node").distinct(), "some")
    wanted = stored(wide.select("node", "row", "packed").join(small(some), "node"), "wanted")
    discarded(wide)
    texts = documents.select(row_key("doc_id", "text").alias("row"), F.col("text").cast("binary").alias("bytes"))
    full = stored(texts.join(small(wanted).select("node", "row"), "row").dropDuplicates(["row"]).select("node", "bytes").mapInArrow(
        _set_rows, "node long, shingles array<long>"), "sets")
    found = _Links(wanted, full, percent)
    rest, groups, work = found.compared(members, shared, 1)
    if work:
        _across(rest, groups, found)
    known = sets.select("digest", "node", "least").join(small(found.label).select("node", "component"), "node", "left").select(
        "digest", "least", F.coalesce("component", "node").alias("component"))
    smallest = known.groupBy("component").agg(F.min("least").alias("component_id"))
    named = stored(known.join(smallest, "component").select("digest", "component_id"), "components")
    discarded(groups, some, wanted, full, sets, rest, found.label)
    return rows.join(
        named.withColumn("linked", F.lit(True)), "digest", "left"
    ).select(
        "doc_id", "n_shingles", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))

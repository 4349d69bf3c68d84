"""Shards by fixed virtual slots and a versioned slot-to-shard map.

A record's slot is a hash and never changes.  Bytes and rows are summed per
slot; the map names each slot's shard.  Rebalancing edits the map: it moves as
few slots as it takes from heavy shards to light ones and stores the result as
the next version, so a reader of an older version still finds its rows.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from foliospark.llm.common import small, stored
from foliospark.session import scratch_path

SLOTS = 8192
#: Rows that repeat an id, size and checksum more often than this are spread by a number of their own.
COPIES = 64
MAP_SCHEMA = "version int, slot int, shard int"


@dataclass(frozen=True)
class SlotMap:
    """One version of the map: the shard of each slot."""

    version: int
    shards: tuple[int, ...]

    @classmethod
    def dealt(cls, n_shards: int, slots: int = SLOTS) -> SlotMap:
        return cls(0, tuple(slot % n_shards for slot in range(slots)))

    def rebalanced(self, weights: dict[int, int], n_shards: int) -> SlotMap:
        """The next version: slots move from the heaviest shard to the lightest while that evens them out.

        The work and memory are those of the slots, whose number is fixed.
        """
        place = list(self.shards)
        load = [0] * n_shards
        own: list[list[tuple[int, int]]] = [[] for _ in range(n_shards)]
        for slot, shard in enumerate(place):
            weight = weights.get(slot, 0)
            load[shard] += weight
            if weight:
                own[shard].append((weight, slot))
        for part in own:
            part.sort()
        for _ in range(4 * len(place)):
            high, low = max(range(n_shards), key=lambda s: (load[s], -s)), min(range(n_shards), key=lambda s: (load[s], s))
            gap = load[high] - load[low]
            # The slot nearest to half the gap; it helps if it is smaller than the gap.
            at = bisect.bisect_right(own[high], (gap // 2, len(place)))
            near = [own[high][k] for k in (at - 1, at) if 0 <= k < len(own[high])]
            weight, slot = min(near, key=lambda x: (abs(2 * x[0] - gap), x), default=(gap, -1))
            if weight >= gap:
                # No single slot helps any more: try one exchange.
                swap = self._swap(own[high], own[low], gap)
                if swap is None:
                    break
                (heavy, out), (light, back) = swap
                self._move(own, load, place, high, low, (heavy, out))
                self._move(own, load, place, low, high, (light, back))
                continue
            self._move(own, load, place, high, low, (weight, slot))
        return SlotMap(self.version + 1, tuple(place))

    @staticmethod
    def _swap(high: list[tuple[int, int]], low: list[tuple[int, int]], gap: int):
        """A slot of each side whose difference is nearest to half the gap and below it."""
        best = None
        for item in high:
            at = bisect.bisect_left(low, (item[0] - gap // 2, -1))
            for k in (at - 1, at):
                if 0 <= k < len(low) and 0 < item[0] - low[k][0] < gap:
                    rank = abs(2 * (item[0] - low[k][0]) - gap)
                    if best is None or rank < best[0]:
                        best = rank, item, low[k]
        return best and best[1:]

    @staticmethod
    def _move(own, load, place, source: int, target: int, item: tuple[int, int]) -> None:
        own[source].remove(item)
        bisect.insort(own[target], item)
        load[source] -= item[0]
        load[target] += item[0]
        place[item[1]] = target

    def save(self, spark: SparkSession, path: str) -> None:
        """Add this version to the stored map."""
        rows = [(self.version, slot, shard) for slot, shard in enumerate(self.shards)]
        spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("append").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, version: int) -> SlotMap:
        rows = spark.read.schema(MAP_SCHEMA).parquet(path).where(F.col("version") == version).orderBy("slot").collect()
        return cls(version, tuple(r.shard for r in rows))


def slotted(documents: DataFrame, slots: int = SLOTS, copies: int = COPIES) -> DataFrame:
    """``doc_id, size, text_crc32, virtual_slot``: size is the text's UTF-8 bytes (null: none) plus 8.

    The slot is a hash of id and checksum.  Rows that repeat both more than
    ``copies`` times are numbered and hashed with their number, so that they
    spread like any others; which of the equal rows has which number makes no
    difference.
    """
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    # The rows' places are fixed by writing them; texts are read once.
    rows = stored(documents.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"), crc.alias("text_crc32"),
    ).withColumn("place", F.monotonically_increasing_id()), "records")
    key = ["doc_id", "size", "text_crc32"]
    repeated = stored(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > copies).drop("n"), "repeated")

    def hashed(*parts: Column | str) -> Column:
        return F.pmod(F.xxhash64(*parts), F.lit(slots)).cast("int").alias("virtual_slot")

    if repeated.isEmpty():
        return rows.select(*key, hashed("doc_id", "text_crc32"))
    same = F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("l.size") == F.col("r.size")) & (F.col("l.text_crc32") == F.col("r.text_crc32"))
    few = rows.alias("l").join(small(repeated).alias("r"), same, "left_anti").select(*key, hashed("doc_id", "text_crc32"))
    # A row's number: those of its kind in earlier parts of the table, and those before it in its own.
    many = rows.alias("l").join(small(repeated).alias("r"), same, "left_semi").withColumn("part", F.shiftright("place", 33))
    parts = many.groupBy(*key, "part").agg(F.count(F.lit(1)).alias("n")).selectExpr(
        *[f"{c} as r_{c}" for c in (*key, "part")], "sum(n) over (partition by doc_id, size, text_crc32 order by part) - n as before")
    within = many.selectExpr(*key, "part", "row_number() over (partition by doc_id, size, text_crc32, part order by place) as own")
    together = F.col("doc_id").eqNullSafe(F.col("r_doc_id")) & (F.col("size") == F.col("r_size")) & (
        F.col("text_crc32") == F.col("r_text_crc32")) & (F.col("part") == F.col("r_part"))
    numbered = within.join(parts, together)
    return few.unionByName(numbered.select(*key, hashed("doc_id", "text_crc32", F.col("before") + F.col("own"))))


def slot_sizes(records: DataFrame) -> dict[int, tuple[int, int]]:
    """Bytes and rows of each slot; at most as many entries as there are slots."""
    sums = records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    return {r.virtual_slot: (r.bytes, r.rows) for r in sums.collect()}


def sharded(documents: DataFrame, n_shards: int = 24, slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot, map_version`` per row.

    The law is ``bytes``: shards are as equal in bytes as whole slots allow.
    ``slot`` is the row's place in its shard, gapless from 0; ``grown_shard`` is
    null under this law.  A null text has 8 bytes and the checksum of no bytes;
    a null id has a slot like any other; equal rows get places of their own, and
    the law holds however many there are: up to a few of them share a virtual
    slot, more are spread over all slots; texts of any length count whole and are
    never moved here; other columns are not read; an empty table gives an empty
    result.
    """
    spark = documents.sparkSession
    path = map_path or scratch_path(spark, "slot-map")
    records = stored(slotted(documents, slots), "slotted")
    sizes = slot_sizes(records)
    first = SlotMap.dealt(n_shards, slots)
    first.save(spark, path)
    SlotMap.load(spark, path, 0).rebalanced({k: v[0] for k, v in sizes.items()}, n_shards).save(spark, path)
    current = SlotMap.load(spark, path, 1)
    begin, rows = [0] * n_shards, []
    for slot, shard in enumerate(current.shards):
        rows.append((slot, shard, begin[shard], current.version))
        begin[shard] += sizes.get(slot, (0, 0))[1]
    # A row for each slot: their number is a parameter and not the data's.
    places = F.broadcast(spark.createDataFrame(rows, "virtual_slot int, shard int, begin long, map_version int"))
    ranked = records.selectExpr(
        "*", "row_number() over (partition by virtual_slot order by doc_id, text_crc32, size) - 1 as place")
    return ranked.join(places, "virtual_slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("begin") + F.col("place")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version",
    )

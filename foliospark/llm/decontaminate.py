"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact confirmation.

A document's windows have as many words as an item; a document with fewer words
is one window.  Shingles are compared as bags, so their order in a window tells
nothing.  A shingle of a document that items of a size hold counts for the
windows of that size around it, repeats as often as one of those items has them
at most; the counts of all starts are summed in one sweep.  Windows that hold
fewer such shingles than the limit asks for can't reach it; all others get a
64-bit SimHash of their shingles.  Fingerprints are cut into 8 blocks; two within a
Hamming distance of 23 differ by at most 2 bits in some block (8 * 3 > 23), so
joining on blocks with up to 2 bits flipped finds all of them.  What is found
is confirmed by the weighted Jaccard similarity of the shingles themselves,
weights being the numbers of occurrences.

Windows are cut out of pieces of a text, so that a long one is the work of many
tasks, and equal windows of a text are fingerprinted once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from foliospark.llm.common import WORD_GAP, row_key, small, stored

WORDS, PERCENT = 5, 75
BLOCKS, FLIPS = 8, 2
RADIUS = BLOCKS * (FLIPS + 1) - 1
#: Words of a text whose windows are cut together.
PIECE = 1024


def _words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lowered, WORD_GAP), lambda w: w != "")


def _shingles(words: Column, size: int) -> Column:
    """Hashes of the runs of ``size`` words, in order."""
    starts = F.sequence(F.lit(0), F.size(words) - size)
    hashes = F.transform(starts, lambda k: F.xxhash64(*(F.get(words, k + j) for j in range(size))))
    return F.when(F.size(words) >= size, hashes).otherwise(F.array().cast("array<bigint>"))


def _own_shingles(words: Column) -> Column:
    """Shingles of a window or item: of five words, or one of all its words if it has fewer."""
    out = F.array().cast("array<bigint>")
    for size in range(1, WORDS + 1):
        fits = F.size(words) == size if size < WORDS else F.size(words) >= size
        out = F.when(fits, _shingles(words, size)).otherwise(out)
    return out


def _fingerprint(shingles: Column) -> Column:
    """64 bits: each is what most shingles (repeats count) have there."""
    ones = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda b: F.size(
        F.filter(shingles, lambda s: F.getbit(s, b) == 1)) * 2 > F.size(shingles))
    return F.aggregate(ones, F.lit(0).cast("long"), lambda acc, one: F.shiftleft(acc, 1).bitwiseOR(one.cast("long")))


def _blocks(fingerprint: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(BLOCKS - 1)), lambda k: F.struct(
        k.alias("block"), F.call_function("shiftrightunsigned", fingerprint, k * (64 // BLOCKS)).bitwiseAND(F.lit(255)).alias("bits")))


def _common(a: Column, b: Column) -> Column:
    """Shingles in both, repeats as often as in the one with fewer."""
    times = lambda array, s: F.size(F.filter(array, lambda x: x == s))
    return F.aggregate(F.array_intersect(a, b), F.lit(0), lambda acc, s: acc + F.least(times(a, s), times(b, s)))


def _starts(marks: DataFrame, percent: int) -> DataFrame:
    """``row, n_words, start`` of the windows that may reach the limit.

    ``marks (row, size, n_words, k, times, gram, pos)`` are the places of items'
    shingles in documents of ``size`` words; an item of ``n_words`` has one at
    most ``times`` times.  A place counts for the windows that hold it and fewer
    than ``times`` of its repeats before it.
    """
    inside = F.least("size", "n_words") - F.col("k") + 1  # shingles of a window
    last = F.greatest(F.lit(0), F.col("size") - F.col("n_words"))
    places = marks.groupBy("row", "size", "n_words", "k", "times", "gram").agg(F.sort_array(F.collect_set("pos")).alias("places"))
    spans = places.withColumn("span", F.explode(F.transform("places", lambda p, i: F.struct(
        F.greatest(F.lit(0), p - inside + 1, F.coalesce(F.get(F.col("places"), i - F.col("times")), F.lit(-1)) + 1).alias("first"),
        F.least(p, last).alias("last"))))).where("span.first <= span.last")
    # The count changes by one where a span begins and behind its end.
    steps = spans.select("row", "size", "n_words", "k", F.explode(F.array(
        F.struct(F.col("span.first").alias("start"), F.lit(1).alias("by")),
        F.struct((F.col("span.last") + 1).alias("start"), F.lit(-1).alias("by")))).alias("s"))
    by_start = steps.groupBy("row", "size", "n_words", "k", "s.start").agg(F.sum("s.by").alias("by"))
    order = Window.partitionBy("row", "n_words").orderBy("start")
    runs = by_start.select("*", F.sum("by").over(order).alias("held"), F.lead("start").over(order).alias("next"))
    enough = F.col("held") * (100 + percent) >= (inside + F.col("n_words") - F.col("k") + 1) * percent
    return runs.where(enough & (F.col("held") > 0)).select(
        "row", "n_words", F.explode(F.sequence("start", F.col("next") - 1)).alias("start"))


def _sized_shingles(split: DataFrame, sizes: list[int]) -> DataFrame:
    """``row, size, k, grams`` of ``split (row, words)``: the shingles of ``k`` words, for each of the sizes."""
    each = F.array(*(F.struct(F.lit(k).alias("k"), _shingles(F.col("words"), k).alias("grams")) for k in sizes)) if sizes else (
        F.array().cast("array<struct<k:int,grams:array<bigint>>>"))
    return split.select("row", F.size("words").alias("size"), F.explode(each).alias("g")).select("row", "size", "g.*")


def leaks(documents: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``row, item_id, start, n_words, common, joint``: windows of documents that are copies of items.

    ``row`` is ``row_key("doc_id", "text")``; ``start`` and ``n_words`` count words.
    Of windows of a document with the same shingles in the same order the first one stands for all.
    """
    items = stored(
        benchmark.select("item_id", row_key("item_id", "text").alias("item"), _words(F.col("text")).alias("words")).distinct()
        .where(F.size("words") > 0).select("item_id", "item", F.size("words").alias("n_words"), _own_shingles(F.col("words")).alias("shingles"))
        .withColumn("fingerprint", _fingerprint(F.col("shingles"))), "items",
    )
    sizes = sorted(r.k for r in items.select(F.least("n_words", F.lit(WORDS)).alias("k")).distinct().collect())
    owned = items.select("item", "n_words", F.least("n_words", F.lit(WORDS)).alias("k"), F.explode("shingles").alias("gram")).groupBy(
        "item", "n_words", "k", "gram").agg(F.count(F.lit(1)).cast("int").alias("times"))
    grams = small(stored(owned.groupBy("n_words", "k", "gram").agg(F.max("times").alias("times")), "grams"))
    texts = documents.select(row_key("doc_id", "text").alias("row"), "text")
    split = texts.select("row", _words(F.col("text")).alias("words"))
    placed = _sized_shingles(split, sizes).select("row", "size", "k", F.posexplode("grams").alias("pos", "gram")).join(grams, ["k", "gram"])
    windows = _starts(placed, percent).select(
        "row", F.least("n_words", F.lit(WORDS)).alias("k"), F.expr(f"start div {PIECE}").cast("int").alias("piece"), "n_words", "start")
    by_piece = stored(windows.groupBy("row", "k", "piece").agg(F.collect_list(F.struct("n_words", "start")).alias("windows")), "windows")
    by_row = stored(by_piece.groupBy("row", "k").agg(F.collect_list("piece").alias("pieces")), "pieces")
    rows = stored(by_row.select("row").distinct(), "rows")
    longest = items.agg(F.max("n_words").alias("n")).first().n or 0
    # A text's shingles are made once; each piece goes on for those of a window that begins at its end.
    begun = texts.join(small(rows), "row").dropDuplicates(["row"]).select("row", _words(F.col("text")).alias("words"))
    pieces = _sized_shingles(begun, sizes).join(small(by_row), ["row", "k"]).select("row", "k", F.explode(F.transform("pieces", lambda p: F.struct(
        p.alias("piece"), F.slice("grams", p * PIECE + 1, F.lit(PIECE + longest)).alias("grams")))).alias("p")).select("row", "k", "p.*")
    cut = pieces.join(by_piece, ["row", "k", "piece"]).select("row", "k", "piece", "grams", F.explode("windows").alias("w")).select(
        "row", "w.n_words", "w.start",
        F.slice("grams", F.col("w.start") - F.col("piece") * PIECE + 1, F.col("w.n_words") - F.col("k") + 1).alias("shingles"))
    once = cut.groupBy("row", "n_words", F.xxhash64("shingles").alias("same")).agg(F.min(F.struct("start", "shingles")).alias("w")).select(
        "row", "n_words", "w.start", "w.shingles")
    prints = stored(once.withColumn("fingerprint", _fingerprint(F.col("shingles"))), "prints")
    flips = F.array(*(F.lit(m) for m in range(256) if m.bit_count() <= FLIPS))
    index = items.select("item", "n_words", F.col("fingerprint").alias("item_print"), F.explode(_blocks(F.col("fingerprint"))).alias("b")).select(
        "item", "n_words", "item_print", "b.block", F.explode(F.transform(flips, lambda m: F.col("b.bits").bitwiseXOR(m.cast("long")))).alias("bits"))
    keys = prints.select("row", "n_words", "start", "fingerprint", F.explode(_blocks(F.col("fingerprint"))).alias("b")).select(
        "row", "n_words", "start", "fingerprint", "b.block", "b.bits")
    near = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_print"))) <= RADIUS
    found = keys.join(small(stored(index, "index")), ["n_words", "block", "bits"]).where(near).select(
        "row", "n_words", "start", "item").distinct()
    both = found.join(prints.select("row", "n_words", "start", "shingles"), ["row", "n_words", "start"]).join(
        small(items).select("item_id", "item", F.col("shingles").alias("own")), "item")
    sized = both.withColumn("common", _common(F.col("shingles"), F.col("own"))).withColumn(
        "joint", F.size("shingles") + F.size("own") - F.col("common"))
    return sized.where(F.col("common") * 100 >= F.col("joint") * percent).select("row", "item_id", "start", "n_words", "common", "joint")


def contaminated(documents: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_items, item_ids, contaminated`` per row of ``documents``; ``item_ids`` are comma-joined in order.

    A null or empty text, or item, contains and matches nothing; items of fewer
    than five words match as a whole; a null item id is written as nothing but
    counts; equal items are all named; equal rows give equal results; texts are
    read whole; other columns are not read; an empty table gives an empty result
    and an empty benchmark finds nothing.
    """
    found = leaks(documents, benchmark, percent).groupBy("row").agg(F.collect_set(F.struct("item_id")).alias("items"))
    items = F.coalesce("items", F.array().cast("array<struct<item_id:bigint>>"))
    return documents.select("doc_id", row_key("doc_id", "text").alias("row")).join(stored(found, "leaks"), "row", "left").select(
        "doc_id", F.size(items).cast("long").alias("n_items"),
        F.array_join(F.transform(F.array_sort(items), lambda i: i["item_id"].cast("string")), ",").alias("item_ids"),
        (F.size(items) > 0).alias("contaminated"),
    )


def clean(documents: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``documents``, all columns, in which no item was found.

    A row with a null or wordless text holds nothing and stays; rows are told
    apart by id and text, so each is judged by its own text, also if its id is
    null or repeated, and equal rows share their fate; long texts are searched
    whole; columns may have any names; an empty table gives an empty result and
    an empty benchmark keeps all rows.
    """
    at = "leak_at" + "_" * max((len(c) for c in documents.columns), default=0)  # a name no column has
    rows = stored(leaks(documents, benchmark, percent).select(F.col("row").alias(at)).distinct(), "leaks")
    return documents.withColumn(at, row_key("doc_id", "text")).join(small(rows), at, "left_anti").drop(at)

"""Secret scans with corpus-wide ownership: who else has the same string.

Patterns find candidates in whole texts.  Each candidate's hash is counted over
the distinct repositories and owners that hold it.  A string that many owners
hold is a copied example; one that a single owner or few hold looks live.
Random-looking strings that no pattern names are added as spans only if they
look live in this sense.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from foliospark.llm.common import is_small, row_key, stored

# Fixed patterns, in the order in which kinds sort.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: 24 or more characters with a digit, a small and a capital letter among them, standing alone.
# It can start at the first of a run's characters only, so each run is looked through once.
RANDOM = (r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])(?=[A-Z0-9+/_=-]*+[a-z])(?=[a-z0-9+/_=-]*+[A-Z])"
          r"[A-Za-z0-9+/_=-]{24,}+")
KINDS = ("assign", "access", "hex", "random")
#: A string with at least this many owners, or this many repositories, is a copied example.
OWNERS, REPOSITORIES = 3, 5
MARK = "[SECRET]"
_SPAN = "array<struct<start:int,kind:int,end:int,hash:bigint>>"


def _matches(text: Column, pattern: str, kind: int, value: Column | None = None, least: int = 0) -> Column:
    """Spans of the pattern's matches, leftmost and without overlap: (start, kind, end, hash of the value).

    Splitting gives the text between matches, so places follow from lengths.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if least else found
    parts = F.arrays_zip(F.split(text, pattern).alias("gap"), found.alias("hit"), values.alias("value"))
    empty = F.array().cast(_SPAN)

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + F.length(part["gap"])
        end = start + F.coalesce(F.length(part["hit"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), F.xxhash64(part["value"]).alias("hash"))
        fits = F.length(part["value"]) >= max(least, 1)
        return F.struct(end.alias("at"), F.when(fits, F.array_append(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    zero = F.struct(F.lit(0).alias("at"), empty.alias("spans"))
    return F.when(text.rlike(pattern), F.aggregate(parts, zero, step, lambda s: s["spans"])).otherwise(empty)


def _written(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def candidates(documents: DataFrame, owner: str = "source", repository: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """``doc_id, row, owner, repository, base, more`` per row: spans of the patterns and of random-looking strings."""
    text = F.coalesce("text", F.lit(""))
    found = documents.select(
        "doc_id", row_key("doc_id", "text", owner, *repository).alias("row"),
        F.coalesce(F.col(owner), F.lit("")).alias("owner"), F.to_json(F.struct(*repository)).alias("repository"),
        F.array_sort(F.concat(_matches(text, ASSIGN, 0, least=6), _matches(text, ACCESS, 1), _matches(text, HEX, 2))).alias("base"),
        _matches(text, RANDOM, 3).alias("random"),
    )
    apart = F.filter("random", lambda r: ~F.exists("base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    return found.select("doc_id", "row", "owner", "repository", "base", apart.alias("more"))


def ownership(found: DataFrame) -> DataFrame:
    """``hash, n_owners, n_repositories`` of every candidate string of ``candidates``."""
    each = found.select("owner", "repository", F.explode(F.concat("base", "more")).alias("s")).select(
        F.col("s.hash").alias("hash"), "owner", "repository").distinct()
    by_owner = each.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"))
    return by_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_repositories"))


def _judged(found: DataFrame) -> DataFrame:
    """``found`` with the hashes of each row's copied examples (``copied``)."""
    often = ownership(found).where((F.col("n_owners") >= OWNERS) | (F.col("n_repositories") >= REPOSITORIES)).select("hash")
    held = found.select("row", F.explode(F.array_distinct(F.transform(F.concat("base", "more"), lambda s: s["hash"]))).alias("hash"))
    copied = held.join(often, "hash").groupBy("row").agg(F.collect_set("hash").alias("copied"))
    return found.join(copied, "row", "left").withColumn("copied", F.coalesce("copied", F.array().cast("array<bigint>")))


def _live(spans: Column | str) -> Column:
    return F.filter(spans, lambda s: ~F.array_contains(F.col("copied"), s["hash"]))


def scanned(documents: DataFrame, owner: str = "source", repository: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied`` per row of ``documents``.

    Places are code points, ends exclusive.  A null text is empty, a null owner
    or language is a value of its own, a null id stays null; equal rows give
    equal results and count as one holder; overlapping spans of different kinds
    all stay; texts are scanned whole; further columns are not read; an empty
    table gives an empty result.
    """
    found = _judged(stored(candidates(documents, owner, repository), "candidates"))
    every = F.array_sort(F.concat("base", _live("more")))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    live = F.size(_live("base")) + F.size(_live("more"))
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"), _written(every).alias("spans"),
        live.cast("long").alias("n_live"), (F.size("base") + F.size(_live("more")) - live).cast("long").alias("n_copied"),
    )


def redacted(documents: DataFrame, owner: str = "source", repository: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """``documents`` with each live-looking secret of ``text`` replaced by a mark; copied examples stay.

    Rows without one are unchanged, a null or empty text among them; all columns
    are kept, whatever their names, and ``text`` alone changes.  Texts are scanned
    and rewritten whole, overlapping spans become one mark; equal rows are equal
    afterwards and count as one holder; a null id makes no difference; an empty
    table gives an empty result.  Few rows hold a secret: their spans are sent to
    the texts, or, beyond a bound, only texts with a candidate are exchanged.
    """
    found = _judged(stored(candidates(documents, owner, repository), "candidates"))
    at = "secrets_at" + "_" * max((len(c) for c in documents.columns), default=0)  # a name no column has
    live = stored(found.select(F.col("row").alias(at), F.array_sort(_live(F.concat("base", "more"))).alias(at + "s"))
                  .where(F.size(at + "s") > 0).dropDuplicates([at]), "live")
    keyed = documents.withColumn(at, row_key("doc_id", "text", owner, *repository))
    if is_small(live):
        joined = keyed.join(F.broadcast(live), at, "left")
    else:
        some = F.lit(False)
        for pattern in (ASSIGN, ACCESS, HEX, RANDOM):
            some |= F.coalesce(F.col("text").rlike(pattern), F.lit(False))
        plain = keyed.where(~some).withColumn(at + "s", F.lit(None).cast(live.schema[at + "s"].dataType))
        joined = keyed.where(some).join(live, at, "left").unionByName(plain)

    def step(state: Column, span: Column) -> Column:
        gap = F.substring(F.col("text"), state["at"] + 1, span["start"] - state["at"])
        inside = span["start"] < state["at"]  # overlaps the one before
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), F.when(inside, state["out"]).otherwise(
            F.concat(state["out"], gap, F.lit(MARK))).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    new = F.aggregate(F.col(at + "s"), zero, step, lambda s: F.concat(s["out"], F.substring(F.col("text"), s["at"] + 1, F.length("text"))))
    text = F.when(F.col(at + "s").isNull(), F.col("text")).otherwise(new)
    return joined.select(*(text.alias("text") if c == "text" else F.col(c) for c in documents.columns))

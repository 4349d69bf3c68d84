"""Cleaning, deduplication and reconciliation of staged sources.

"First" always needs an explicit order: a distributed table has no row order.
Give order columns that are unique per key, or the first row is arbitrary.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from foliospark import constants as K
from foliospark.functions.text import normalize_content


def drop_stubs(df: DataFrame, min_words: int = K.MIN_WORD_COUNT) -> DataFrame:
    return df.where(F.col("word_count") >= min_words)


def drop_empty(df: DataFrame, text: str = "content_normalized") -> DataFrame:
    return df.where(F.length(text) > 0)


def oversized(df: DataFrame, limit: int = K.OVERSIZED_CHARS, key: str = "ra_id",
              length: str = "content_length") -> DataFrame:
    """Rows above ``limit`` characters, longest first."""
    return df.where(F.col(length) > limit).orderBy(F.desc(length), key)


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key.

    Filtering ``row_number() = 1`` lets Spark drop all but one row per key and
    task before the shuffle, so a hot key never gathers in one task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def _repeated_keys(df: DataFrame, keys: list[str], *aggs: Column) -> DataFrame:
    """Keys that occur more than once (counted map-side first)."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *aggs)
    return counted.where("_n > 1").drop("_n")


def _same_keys(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every row whose key occurs more than once.

    A semi join against the repeated keys, not a window count: the join's hot
    partitions can be split, a window's cannot.
    """
    repeated = _repeated_keys(df, keys).alias("r")
    return df.alias("l").join(repeated, _same_keys(keys), "left_semi")


def later_duplicates(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The rows ``keep_first`` drops: those behind the first of their key."""
    firsts = _repeated_keys(df, keys, F.min(F.struct(*order)).alias("_first")).alias("r")
    behind = F.struct(*[F.col(f"l.{o}").alias(o) for o in order]) > F.col("r._first")
    return df.alias("l").join(firsts, _same_keys(keys) & behind).select("l.*")


def append_missing(primary: DataFrame, secondary: DataFrame, key: str = "ra_id") -> DataFrame:
    """Primary rows plus the secondary rows whose key the primary lacks."""
    extra = without_keys(secondary, primary, [key])
    return primary.unionByName(extra.select(*primary.columns))


def without_keys(df: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose key ``known`` lacks; null keys equal each other.

    The known keys are reduced to one row each first: the side an anti join
    searches cannot be split when a key is hot.  The null-safe comparison gives
    both sides their own exchange below the join, which is what lets Spark
    split hot partitions of the other side.
    """
    searched = known.select(*keys).distinct().alias("r")
    return df.alias("l").join(searched, _same_keys(keys), "left_anti")


def overlap(primary: DataFrame, secondary: DataFrame, key: str = "ra_id") -> DataFrame:
    """One row: secondary rows, how many of their keys the primary has, share.

    Both sides are reduced to one row per key before they meet.
    """
    known = primary.select(key).distinct().withColumn("_hit", F.lit(True))
    tally = secondary.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    hits = F.coalesce(F.sum(F.when(F.col("_hit"), F.col("_n"))), F.lit(0))
    rows = F.coalesce(F.sum("_n"), F.lit(0))
    return tally.join(known, key, "left").agg(
        rows.alias("n_secondary"),
        hits.alias("n_overlap"),
        (rows - hits).alias("n_secondary_only"),
        F.round(hits / F.sum("_n"), 6).alias("overlap_share"),
    )


def fill_lookup(lookup: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """First non-null value per key."""
    dated = lookup.where(F.col(value).isNotNull() & F.col(key).isNotNull())
    return keep_first(dated.select(key, value, *[o for o in order if o not in (key, value)]),
                      [key], order).select(key, value)


def gap_fill(df: DataFrame, lookup: DataFrame, key: str = "ra_number",
             value: str = "approval_date", flag: str | None = None) -> DataFrame:
    """Fill nulls of ``value`` from a lookup that is unique per ``key``.

    Never changes a non-null value, adds no rows and touches no other column.
    ``flag`` names a column telling which rows were filled.  Rows without a gap
    match nothing, by a condition beside the key: they still spread over all
    partitions by their key, where a null key would pile them up in one.
    """
    found = lookup.select(
        F.col(key), F.lit(True).alias("_gap"), F.col(value).alias("_fill")
    )
    joined = df.withColumn("_gap", F.col(value).isNull()).join(found, [key, "_gap"], "left")
    columns = [F.coalesce(value, "_fill").alias(c) if c == value else F.col(c) for c in df.columns]
    if flag:
        columns.append(F.col("_fill").isNotNull().alias(flag))
    return joined.select(*columns)


def gap_fill_audit(flagged: DataFrame, value: str = "approval_date",
                   flag: str = "recovered") -> DataFrame:
    """One row: rows, nulls before and after, recovered, percentages."""
    after = F.count_if(F.col(value).isNull())
    recovered = F.count_if(F.col(flag))
    counts = flagged.agg(
        F.count(F.lit(1)).alias("n_rows"),
        (after + recovered).alias("nulls_before"),
        after.alias("nulls_after"),
        recovered.alias("recovered"),
    )

    def pct(part: str, whole: str) -> Column:
        share = F.round(100.0 * F.col(part) / F.col(whole), 4)
        return F.when(F.col(whole) > 0, share).otherwise(F.lit(0.0))

    return counts.select(
        "*",
        pct("recovered", "nulls_before").alias("filled_pct"),
        pct("nulls_before", "n_rows").alias("null_pct_before"),
        pct("nulls_after", "n_rows").alias("null_pct_after"),
    )


def add_normalized(df: DataFrame, text: str = "content_clean") -> DataFrame:
    return df.withColumn("content_normalized", normalize_content(F.col(text)))


def project(df: DataFrame, columns: tuple[str, ...] | list[str] = K.CURATED_COLUMNS) -> DataFrame:
    """Columns in contract order; a missing one raises."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing expected columns: {missing}")
    return df.select(*columns)


def reconcile_counts(primary: DataFrame, secondary: DataFrame, key: str = "ra_id",
                     min_words: int = K.MIN_WORD_COUNT) -> DataFrame:
    """Rows per source and fate: kept, stub, duplicate, overlap.

    Works on keys and word counts only, so the texts are never read.  The
    duplicates are counted, not ranked: solid rows minus distinct keys.
    """
    solid = F.coalesce(F.col("word_count") >= min_words, F.lit(False))
    first = primary.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(solid).alias("solid")
    )
    second = secondary.groupBy(key).agg(F.count(F.lit(1)).alias("extra"))
    # One row per key on either side: no key is hot any more.
    known = F.coalesce(F.col("solid") > 0, F.lit(False))
    counts = first.join(second, key, "full_outer").agg(
        F.sum(F.col("rows") - F.col("solid")).alias("stub"), F.sum("solid").alias("solid"),
        F.count_if(known).alias("kept"), F.sum(F.when(known, F.col("extra"))).alias("overlap"),
        F.sum(F.when(~known, F.col("extra"))).alias("added"),
    ).na.fill(0)
    return counts.select(F.expr(
        "stack(5, 'primary', 'stub', stub, 'primary', 'duplicate', solid - kept, 'primary', 'kept', kept, "
        "'secondary', 'overlap', overlap, 'secondary', 'kept', added) as (origin, fate, n)"
    ))

"""Table merge by key: insert or update, never lose a row."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F, types as T

from foliospark import constants as K

_LOAD_TYPES = {
    "approval_date": T.DateType(),
    "ra_year": T.IntegerType(),
    "content_length": T.IntegerType(),
    "word_count": T.IntegerType(),
}


def prepare_load(df: DataFrame, columns: tuple[str, ...] = K.CURATED_COLUMNS) -> DataFrame:
    """Curated rows in load types; a missing column raises."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"curated table is missing columns: {missing}")
    return df.select(*[
        F.col(c).cast(_LOAD_TYPES[c]).alias(c) if c in _LOAD_TYPES else F.col(c) for c in columns
    ])


def _sides(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Full outer join of both sides as structs ``_t`` and ``_s``.

    A source key that occurs twice fails the job.  The row numbering shares
    the shuffle and the sort of the join, so the check costs no exchange.
    """
    if set(target.columns) != set(source.columns):
        raise ValueError("target and source have different columns")
    twice = F.row_number().over(Window.partitionBy(key).orderBy(key)) > 1
    checked = source.withColumn(
        "_once",
        F.when(twice, F.raise_error(F.concat(F.lit("duplicate source key: "),
                                             F.col(key).cast("string"))).cast("boolean"))
        .otherwise(F.lit(True)),
    )
    left = target.select(key, F.struct(*target.columns).alias("_t"))
    right = checked.select(
        key, F.when(F.col("_once"), F.struct(*target.columns)).alias("_s")
    )
    return left.join(right, key, "full_outer")


def _action():
    return (
        F.when(F.col("_t").isNull(), "inserted")
        .when(F.col("_s").isNotNull(), "updated")
        .otherwise("kept")
    )


def upsert(target: DataFrame, source: DataFrame, key: str = "ra_id",
           action: str | None = None) -> DataFrame:
    """Target after the merge: source rows win where the source has the key.

    Tables bucketed by ``key`` merge without a shuffle.  ``action`` names an
    optional column: kept, inserted or updated.
    """
    merged = _sides(target, source, key)
    row = F.coalesce(F.col("_s"), F.col("_t"))
    columns = [row.getField(c).alias(c) for c in target.columns]
    if action:
        columns.append(_action().alias(action))
    return merged.select(*columns)


def upsert_counts(target: DataFrame, source: DataFrame, key: str = "ra_id") -> DataFrame:
    """Rows kept, inserted and updated by the merge."""
    counts = _sides(target.select(key), source.select(key), key).groupBy(_action().alias("action"))
    return counts.agg(F.count(F.lit(1)).alias("n"))

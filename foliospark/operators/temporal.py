"""Calendar counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def with_parsed_date(df: DataFrame, column: str = "approval_date",
                     name: str = "approval_date_dt") -> DataFrame:
    """Add the column as DATE; text that is no date becomes null."""
    return df.withColumn(name, F.try_to_date(F.col(column), "yyyy-M-d"))


def count_by_year(df: DataFrame, day: Column) -> DataFrame:
    """Rows per year, sorted; rows without a date are left out."""
    years = df.select(F.year(day).cast("long").alias("year")).where("year is not null")
    return years.groupBy("year").agg(F.count(F.lit(1)).alias("n")).orderBy("year")


def _counts_over(df: DataFrame, part: Column, name: str, first: int, last: int) -> DataFrame:
    parts = df.select(part.cast("long").alias(name)).where(F.col(name).isNotNull())
    found = parts.groupBy(name).agg(F.count(F.lit(1)).alias("_n"))
    whole = df.sparkSession.range(first, last + 1, numPartitions=1).withColumnRenamed("id", name)
    # `found` has at most as many rows as there are parts.
    return (
        whole.join(F.broadcast(found), name, "left")
        .select(name, F.coalesce("_n", F.lit(0)).alias("n")).orderBy(name)
    )


def count_by_month(df: DataFrame, day: Column) -> DataFrame:
    """Rows per calendar month; all twelve are present."""
    return _counts_over(df, F.month(day), "month", 1, 12)


def count_by_weekday(df: DataFrame, day: Column) -> DataFrame:
    """Rows per weekday, Monday = 0; all seven are present."""
    return _counts_over(df, F.weekday(day), "weekday", 0, 6)


def weekday_share(df: DataFrame, day: Column, origin: Column) -> DataFrame:
    """Share of every weekday within each origin of the date."""
    parts = df.select(origin.alias("origin"), F.weekday(day).cast("long").alias("weekday"))
    counts = parts.where("weekday is not null").groupBy("origin", "weekday").agg(
        F.count(F.lit(1)).alias("n")
    )
    # At most seven rows per origin are left here.
    total = F.sum("n").over(Window.partitionBy("origin"))
    return counts.select("origin", "weekday", "n", F.round(F.col("n") / total, 6).alias("share"))

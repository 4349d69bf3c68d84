"""Profiles of tables, JSON indexes and page sets."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from foliospark import constants as K
from foliospark.functions.text import render_sample
from foliospark.session import stored

_PERCENTILES = (("p25", 0.25), ("median", 0.5), ("p75", 0.75))


def _stack(labels: list[str], columns: list[list[Column]], names: list[str]) -> Column:
    """``explode`` of one struct per label; one row becomes len(labels) rows."""
    structs = [
        F.struct(F.lit(label).alias("name"), *[c.alias(n) for c, n in zip(group, names)])
        for label, group in zip(labels, columns)
    ]
    return F.explode(F.array(*structs)).alias("s")


def _identity(c: Column) -> Column:
    """Values are compared by digest, whatever their length."""
    return F.sha2(c.cast("string"), 256)


def distinct_counts(df: DataFrame, approximate: bool = False) -> DataFrame:
    """``name, distinct_values`` for every column in one pass.

    Exact counting goes over ``(column, value)`` pairs: they are combined per
    task, spread over all partitions, and long texts travel as digests.
    """
    names = df.columns
    if approximate:
        one = df.agg(*[F.approx_count_distinct(c).alias(c) for c in names])
        return one.select(_stack(names, [[F.col(c)] for c in names], ["distinct_values"])).select("s.*")
    pairs = df.select(_stack(names, [[_identity(F.col(c))] for c in names], ["value"])).select("s.*")
    values = pairs.where(F.col("value").isNotNull()).groupBy("name", "value").agg(F.lit(1).alias("one"))
    return values.groupBy("name").agg(F.count("one").alias("distinct_values"))


def column_profile(df: DataFrame, order: list[str], approximate: bool = False) -> DataFrame:
    """One row per column: type, nulls, null share, distinct values, sample.

    The sample is the rendered value of the first non-null row in ``order``.
    """
    position = F.struct(*order)
    aggs, groups = [F.count(F.lit(1)).alias("_rows")], []
    for at, f in enumerate(df.schema.fields):
        c = F.col(f.name)
        aggs += [
            F.count(c).alias(f"_n{at}"),
            F.min_by(c, F.when(c.isNotNull(), position)).alias(f"_s{at}"),
        ]
        groups.append([
            F.lit(at), F.lit(f.dataType.simpleString()), F.col(f"_n{at}"),
            render_sample(F.when(F.col(f"_n{at}") > 0, F.col(f"_s{at}"))), F.col("_rows"),
        ])
    wide = df.agg(*aggs)
    tall = wide.select(
        _stack(df.columns, groups, ["position", "dtype", "non_null", "sample", "n_rows"])
    ).select("s.*")
    nulls = F.col("n_rows") - F.col("non_null")
    pct = F.when(F.col("n_rows") > 0, F.round(100.0 * nulls / F.col("n_rows"), 2)).otherwise(F.lit(0.0))
    return (
        tall.join(distinct_counts(df, approximate), "name", "left")
        .select(
            "name", "position", "dtype", "non_null", nulls.alias("nulls"), pct.alias("null_pct"),
            F.coalesce("distinct_values", F.lit(0)).alias("distinct_values"), "sample",
        )
    )


def null_issues(profile: DataFrame, high: float = K.HIGH_NULL_PCT) -> DataFrame:
    """Columns with nulls; ``high`` from the given null share on."""
    level = F.when(F.col("null_pct") >= high, "high").otherwise("low")
    rows = F.col("non_null") + F.col("nulls")
    text = F.when(
        level == "high",
        F.format_string("`%s` is %.2f%% null (%d/%d).", "name", "null_pct", "nulls", rows),
    ).otherwise(F.format_string("`%s` has %d null(s) (%.2f%%).", "name", "nulls", "null_pct"))
    return profile.where("nulls > 0").select(
        "name", level.alias("level"), "nulls", "null_pct", text.alias("note")
    )


def _histogram(df: DataFrame, columns: list[str]) -> DataFrame:
    """``name, value, n`` over the numeric values of the columns."""
    pairs = df.select(
        _stack(columns, [[F.col(c).try_cast("double")] for c in columns], ["value"])
    ).select("s.*")
    usable = pairs.where(F.col("value").isNotNull() & ~F.isnan("value"))
    return usable.groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))


#: Distinct values that one task may order.
MOST_VALUES = 100_000


@dataclass
class _Range:
    """A closed range of a column's values that holds wanted ranks; ``before`` rows lie below it."""

    name: str
    low: float
    high: float
    before: int
    values: int
    ranks: list[int]


def numeric_summary(df: DataFrame, columns: list[str], splits: int = 512, most: int = MOST_VALUES) -> DataFrame:
    """Count, min, quartiles, mean and max per column; text is coerced.

    The quartiles are exact and interpolate linearly.  Values are counted first;
    then every range that holds a wanted rank is cut into ``splits`` smaller ones
    and those with the ranks are kept, pass by pass, until no range has more than
    ``most`` distinct values.  Only these are ordered, so no task orders more.
    The driver has one row per column and range.
    """
    spark = df.sparkSession
    hist = stored(_histogram(df, columns), "histogram")
    totals = hist.groupBy("name").agg(
        F.sum("n").alias("count"), F.min("value").alias("low"), F.max("value").alias("high"),
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"), F.count(F.lit(1)).alias("values"),
    ).collect()
    ranges = [_Range(t.name, t.low, t.high, 0, t["values"], sorted({r for _, p in _PERCENTILES for r in _ranks(t["count"], p)[:2]}))
              for t in totals]
    while wide := [r for r in ranges if r.values > most]:
        ranges = [r for r in ranges if r.values <= most] + _cut_ranges(hist, wide, splits)
    found = _values_at(hist, ranges)
    rows = []
    for t in totals:
        quartiles = {}
        for label, p in _PERCENTILES:
            low, high, share = _ranks(t["count"], p)
            a, b = found[t.name, low], found[t.name, high]
            quartiles[label] = a + (b - a) * share if share else a
        rows.append((t.name, t["count"], t.low, quartiles["p25"], quartiles["median"], t["mean"], quartiles["p75"], t.high))
    return spark.createDataFrame(
        rows, "name string, count long, min double, p25 double, median double, mean double, p75 double, max double")


def _ranks(count: int, share: float) -> tuple[int, int, float]:
    """The ranks around a quantile, from 0, and how far it lies between them."""
    at = (count - 1) * share
    return math.floor(at), math.ceil(at), at - math.floor(at)


def _inside(hist: DataFrame, ranges: list[_Range]) -> DataFrame:
    """``range, value, n`` of the values in some ranges, which are a few for each column."""
    listed = hist.sparkSession.createDataFrame(
        [(k, r.name, r.low, r.high, r.before) for k, r in enumerate(ranges)], "range int, name string, low double, high double, before long")
    return hist.join(F.broadcast(listed), "name").where(F.col("value").between(F.col("low"), F.col("high"))).select(
        "range", "value", "n", "before")


def _cut_ranges(hist: DataFrame, ranges: list[_Range], splits: int) -> list[_Range]:
    """The parts of the ranges that hold their wanted ranks."""
    inside = _inside(hist, ranges)
    grid = [i / splits for i in range(1, splits)]
    # One row of `splits` numbers per range: a bounded broadcast.
    cuts = inside.groupBy("range").agg(F.percentile_approx("value", grid, F.lit(10_000)).alias("cuts")).withColumn(
        "coarse", F.filter("cuts", lambda c, i: (i + 1) % _STRIDE == 0))
    parts = inside.join(F.broadcast(cuts), "range").groupBy("range", _part(F.col("value")).alias("part")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("values"), F.min("value").alias("low"), F.max("value").alias("high"),
    ).orderBy("range", "part").collect()
    out, before = [], [r.before for r in ranges]
    for part in parts:
        own, below = ranges[part.range], before[part.range]
        before[part.range] += part.n
        if ranks := [k for k in own.ranks if below <= k < below + part.n]:
            out.append(_Range(own.name, part.low, part.high, below, part["values"], ranks))
    return out


# Every so many cuts form one step of the two-step search.
_STRIDE = 22


def _part(value: Column) -> Column:
    """Number of cuts below ``value``, found by a coarse and a fine step."""
    step = F.size(F.filter("coarse", lambda c: c < value)) * _STRIDE
    return step + F.size(F.filter(F.slice("cuts", step + 1, F.lit(_STRIDE)), lambda c: c < value))


def _values_at(hist: DataFrame, ranges: list[_Range]) -> dict[tuple[str, int], float]:
    """The value at each wanted rank; every range is small enough to be ordered."""
    if not ranges:
        return {}
    order = Window.partitionBy("range").orderBy("value")
    placed = _inside(hist, ranges).select(
        "range", "value", (F.col("before") + F.sum("n").over(order) - 1).alias("last"), "n")
    wanted = hist.sparkSession.createDataFrame([(k, rank) for k, r in enumerate(ranges) for rank in r.ranks], "range int, rank long")
    hits = placed.join(F.broadcast(wanted), "range").where((F.col("rank") <= F.col("last")) & (F.col("rank") > F.col("last") - F.col("n")))
    return {(ranges[h.range].name, h.rank): h.value for h in hits.select("range", "rank", "value").collect()}


def duplicate_values(df: DataFrame, column: str, null_is_value: bool = True) -> DataFrame:
    """One row: rows behind the first of an equal value, counted by digest."""
    groups = df.groupBy(_identity(F.col(column)).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    if not null_is_value:
        groups = groups.where(F.col("v").isNotNull())
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def pattern_counts(df: DataFrame, patterns: dict[str, Column]) -> DataFrame:
    """One row with the number of rows per predicate; null counts as no."""
    return df.agg(*[F.count_if(p).alias(name) for name, p in patterns.items()])


def json_index_profile(entries: DataFrame, label: Column, date_text: Column, doc_id: Column) -> DataFrame:
    """``metric, value`` rows over exploded index entries.

    ``label`` is the number of a matching title or null, ``doc_id`` the id in
    the anchor or null.  What the counts need of ``entries`` is stored, so
    pages are parsed once.
    """
    iso = date_text.rlike(K.ISO_DATE)
    flat = stored(entries.select(
        "page", "entry_size",
        label.try_cast("long").alias("number"),
        F.when(date_text != "", date_text).alias("date"),
        F.when(iso, F.substring(date_text, 1, 4).try_cast("long")).alias("year"),
        (F.col("anchor") != "").alias("has_anchor"), doc_id.alias("doc_id"),
    ), "index")
    per_page = flat.groupBy("page").agg(
        F.count(F.lit(1)).alias("rows"), F.count("number").alias("label"), F.count("date").alias("dated"),
        F.count("year").alias("iso"), F.count_if("has_anchor").alias("anchors"), F.count("doc_id").alias("ids"),
        F.min("number").alias("n0"), F.max("number").alias("n1"), F.min("year").alias("y0"), F.max("year").alias("y1"),
    )
    one = per_page.agg(
        F.count(F.lit(1)).alias("pages"), F.sum("rows").alias("total_rows"),
        F.min("rows").alias("per_page_min"), F.max("rows").alias("per_page_max"),
        F.sum("label").alias("label_rows"), F.sum(F.col("rows") - F.col("label")).alias("other_rows"),
        F.sum("dated").alias("dates_present"), F.sum("iso").alias("dates_iso"),
        F.sum(F.col("dated") - F.col("iso")).alias("dates_non_iso"),
        F.sum("anchors").alias("anchors_present"), F.sum("ids").alias("doc_ids_extracted"),
        F.min("n0").alias("number_min"), F.max("n1").alias("number_max"),
        F.min("y0").alias("year_min"), F.max("y1").alias("year_max"),
    )
    repeated = flat.where("number is not null").groupBy("number").count().agg(
        F.count_if(F.col("count") > 1).alias("duplicate_numbers")
    )
    sizes = flat.groupBy("entry_size").agg(F.count(F.lit(1)).alias("value")).select(
        F.concat(F.lit("entries_of_length_"), F.col("entry_size").cast("string")).alias("metric"), "value"
    )
    return reduce(DataFrame.unionByName, [_tall(one), _tall(repeated), sizes])


def _tall(one_row: DataFrame) -> DataFrame:
    cells = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("long").alias("value")) for c in one_row.columns]
    return one_row.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def page_set_profile(joined: DataFrame, html: str = "html") -> DataFrame:
    """One row over manifest entries with their page: counts and bytes."""
    size = F.octet_length(F.col(html)).cast("long")
    counts = joined.agg(
        F.count(F.lit(1)).alias("manifest_entries"),
        F.count(html).alias("pages_found"),
        F.count_if(F.col(html).isNull()).alias("missing_pages"),
        F.coalesce(F.sum(size), F.lit(0)).alias("total_bytes"),
    )
    average = F.expr("total_bytes div pages_found")
    return counts.withColumn(
        "avg_page_bytes", F.when(F.col("pages_found") > 0, average).otherwise(F.lit(0).cast("long"))
    )


PROFILE_ROW = "part string, name string, metric string, value string"


def staging_counts(df: DataFrame, key: str = "ra_id", year: str = "ra_year",
                   title: str = "title") -> DataFrame:
    """``metric, value`` rows: duplicates, null years, year range, blank titles.

    Null keys are one value among the others, so the second one repeats it.
    """
    blank = F.trim(F.coalesce(F.col(title), F.lit("null"))) == ""
    null_key = F.when(F.count_if(F.col(key).isNull()) > 0, 1).otherwise(0)
    return _tall(df.agg(
        F.count(F.lit(1)).alias("rows"),
        (F.count(F.lit(1)) - F.count_distinct(key) - null_key).alias(f"duplicate_{key}"),
        F.count_if(F.col(year).isNull()).alias(f"null_{year}"),
        F.min(year).alias(f"{year}_min"), F.max(year).alias(f"{year}_max"),
        F.count_if(blank).alias("empty_title"),
    ))


def staging_profile(df: DataFrame, order: list[str], key: str = "ra_id", year: str = "ra_year", title: str = "title",
                    numeric: tuple[str, ...] = ("ra_year", "content_length", "word_count"), digits: int = 6) -> DataFrame:
    """The whole profile of a staged table as ``part, name, metric, value`` rows.

    Parts: ``column`` (type, nulls, distinct values and sample of every column),
    ``numeric`` (the summary of each numeric column, rounded to ``digits``),
    ``derived`` (``staging_counts``) and ``note`` (columns with nulls).  ``df``
    is read several times: give a stored table.  ``order`` decides which value
    is a column's sample.
    """
    columns = stored(column_profile(df, order), "columns")
    numbers = numeric_summary(df, [c for c in numeric if c in df.columns])
    rounded = numbers.select("name", *[F.round(c, digits).alias(c) if c != "count" else F.col(c) for c in numbers.columns if c != "name"])
    counts = staging_counts(df, key, year, title).where(F.col("value").isNotNull())
    return (
        _cells(columns, "column", ["position", "dtype", "non_null", "nulls", "null_pct", "distinct_values", "sample"])
        .unionByName(_cells(rounded, "numeric", ["count", "min", "p25", "median", "mean", "p75", "max"]))
        .unionByName(counts.select(F.lit("derived").alias("part"), F.lit("").alias("name"), "metric", F.col("value").cast("string")))
        .unionByName(_cells(null_issues(columns), "note", ["level", "note"]))
    )


def _cells(df: DataFrame, part: str, metrics: list[str]) -> DataFrame:
    """One row per cell of a table with one row per ``name``; values are written as text."""
    cells = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("string").alias("value")) for m in metrics]
    return df.select(F.lit(part).alias("part"), "name", F.explode(F.array(*cells)).alias("c")).select("part", "name", "c.*")


def curated_summary(df: DataFrame, key: str = "ra_id", year: str = "ra_year",
                    title: str = "title", date_column: str = "approval_date") -> DataFrame:
    """One row: rows, distinct keys and years, year range, nulls; one scan."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias(f"distinct_{key}"),
        F.count_distinct(year).alias("distinct_years"),
        F.min(year).alias("year_min"), F.max(year).alias("year_max"),
        F.count_if(F.col(title).isNull()).alias("null_title"),
        F.count_if(F.col(date_column).isNull()).alias("null_date"),
    )


def source_distribution(df: DataFrame, column: str = "source") -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def profile_schema() -> T.StructType:
    """Schema of ``column_profile`` results, for stored profiles."""
    return T.StructType([
        T.StructField("name", T.StringType()), T.StructField("position", T.IntegerType()),
        T.StructField("dtype", T.StringType()), T.StructField("non_null", T.LongType()),
        T.StructField("nulls", T.LongType()), T.StructField("null_pct", T.DoubleType()),
        T.StructField("distinct_values", T.LongType()), T.StructField("sample", T.StringType()),
    ])

"""Sources: typed scans that leave pruning and push-down to Spark."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from foliospark.contract import Contract
from foliospark.functions.anchors import page_slug

RAW_MARKDOWN = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("year", T.LongType()),
    T.StructField("month", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("basename", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("content", T.StringType()),
])
MANIFEST = T.StructType([
    T.StructField("ra_label", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("date_text", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("source_path", T.StringType()),
])


def read_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_curated(spark: SparkSession, path: str, contract: Contract | None = None) -> DataFrame:
    return read_parquet(spark, path, (contract or Contract.parse()).schema())


def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table, or an empty one with its columns when it is absent."""
    try:
        return read_parquet(spark, path, schema)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_manifest(spark: SparkSession, path: str, schema: T.StructType = MANIFEST) -> DataFrame:
    """A JSON file that holds one list of objects."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_html_files(spark: SparkSession, path: str) -> DataFrame:
    """One row ``(slug, html)`` per page file."""
    return spark.read.text(path, wholetext=True).select(
        F.url_decode(F.substring_index(F.col("_metadata.file_name"), "/", -1)).alias("slug"),
        F.col("value").alias("html"),
    )


def read_json_index(spark: SparkSession, path: str) -> DataFrame:
    """One row ``(page, payload)`` per JSON index page file."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("page"), F.col("value").alias("payload")
    )


def explode_index(pages: DataFrame, page: str = "page", payload: str = "payload") -> DataFrame:
    """Entries of index pages: ``page, pos, entry_size, title, date_text, anchor``.

    ``entry_size`` is -1 for an entry that is not a list.  The entries are
    decoded one by one, because one bad entry would null the whole page under
    a nested schema, and once each: as a generated value the cells are not
    decoded again by every filter on what is read off them.
    """
    entries = pages.select(
        page, F.posexplode(F.from_json(payload, "data array<string>").data).alias("pos", "entry")
    )
    cells = F.when(F.col("entry").startswith("["), F.from_json("entry", T.ArrayType(T.StringType())))
    decoded = entries.select(page, "pos", F.explode(F.array(cells)).alias("cells"))

    def cell(n: int) -> Column:
        return F.try_element_at("cells", F.lit(n))

    return decoded.select(
        F.col(page).alias("page"),
        "pos",
        F.coalesce(F.size("cells"), F.lit(-1)).alias("entry_size"),
        cell(1).alias("title"),
        cell(2).alias("date_text"),
        cell(3).alias("anchor"),
    )


def well_formed(entries: DataFrame) -> DataFrame:
    """Only entries that are lists of at least three elements."""
    return entries.where(F.col("entry_size") >= 3)


def manifest_pages(manifest: DataFrame, pages: DataFrame, path: str = "source_path") -> DataFrame:
    """Manifest entries with their page; entries without a page keep a null."""
    return manifest.withColumn("slug", page_slug(F.col(path))).join(pages, "slug", "left")

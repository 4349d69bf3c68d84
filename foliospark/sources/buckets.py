"""A keyed table in hash buckets, of which a merge rewrites only those it touches.

Every bucket is a folder of files.  A manifest, one line in one small file,
names the folder each bucket has now.  A merge writes new folders for the buckets
that hold a key of the batch and replaces the manifest: readers see the table
before or after it, and all other buckets keep their files.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from foliospark.operators.upsert import upsert
from foliospark.sources import writers

BUCKETS = 64
_BUCKET = "bucket"


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket of a key; a null key has one as well."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _layout(spark: SparkSession, root: str) -> dict | None:
    line = writers._pointed(spark, root)
    return json.loads(line) if line else None


def bucket_folders(spark: SparkSession, root: str) -> dict[int, str]:
    """The folder of each bucket that has rows."""
    layout = _layout(spark, root)
    return {int(b): path for b, path in layout["folders"].items()} if layout else {}


def _write(df: DataFrame, root: str, key: str, buckets: int) -> dict[int, str]:
    """Write rows into fresh folders; gives those of the buckets that have rows."""
    path = writers.snapshot_path(root)
    keyed = df.withColumn(_BUCKET, bucket_of(key, buckets))
    keyed.hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).parquet(path)
    return {int(b): f"{path}/{_BUCKET}={b}" for b in writers.partition_bytes(df.sparkSession, path, _BUCKET)}


def create_buckets(df: DataFrame, root: str, key: str, buckets: int = BUCKETS) -> None:
    """Write the whole table; ``key`` and the number of buckets stay what they are."""
    _publish(df.sparkSession, root, key, buckets, _write(df, root, key, buckets))


def _publish(spark: SparkSession, root: str, key: str, buckets: int, folders: dict[int, str]) -> None:
    layout = {"key": key, "buckets": buckets, "folders": {str(b): folders[b] for b in sorted(folders)}}
    writers._replace_pointer(spark, root.rstrip("/"), json.dumps(layout))


def read_buckets(spark: SparkSession, root: str, schema: T.StructType, only: list[int] | None = None) -> DataFrame:
    """The table, or the rows of some buckets."""
    if _layout(spark, root) is None:
        raise FileNotFoundError(f"nothing published at {root}")
    folders = [path for b, path in bucket_folders(spark, root).items() if only is None or b in only]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def upsert_buckets(source: DataFrame, root: str, key: str, buckets: int = BUCKETS) -> list[int]:
    """Merge ``source`` into the table at ``root`` and give the buckets it rewrote.

    Rows of ``source`` win where it has the key; a key it has twice fails the
    job.  Only the touched buckets are read and written; merging the same rows
    again changes nothing.  A table that is not there yet is created.
    """
    spark = source.sparkSession
    layout = _layout(spark, root)
    if layout is None:
        layout = {"key": key, "buckets": buckets, "folders": {}}
    if layout["key"] != key:
        raise ValueError(f"the table is bucketed by {layout['key']}, not by {key}")
    n = layout["buckets"]
    # At most as many rows as there are buckets.
    touched = sorted(r[0] for r in source.select(bucket_of(key, n)).distinct().collect())
    if not touched:
        return []
    folders = {int(b): path for b, path in layout["folders"].items()}
    old = [folders[b] for b in touched if b in folders]
    target = spark.read.schema(source.schema).parquet(*old) if old else spark.createDataFrame([], source.schema)
    folders |= _write(upsert(target, source, key), root, key, n)
    _publish(spark, root, key, n, folders)
    return touched

"""Sinks: full replace, sets published together, year partitions, CSV, JSON Lines, format comparison."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

# No leading underscore: Spark skips such files when it reads.
_POINTER = "CURRENT"
# About how many bytes of text a CSV file holds: a file with quoted line ends is read by one task.
CSV_FILE_BYTES = 64 << 20


# --- full replace ----------------------------------------------------------

def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def snapshot_path(root: str) -> str:
    """A path below ``root`` that nothing was written to."""
    return f"{root.rstrip('/')}/snapshot-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def write_snapshot(df: DataFrame, root: str, allow_empty: bool = False) -> str:
    """Write ``df`` as an unpublished snapshot below ``root``; returns its path."""
    path = snapshot_path(root)
    df.write.mode("errorifexists").parquet(path)
    if not allow_empty and df.sparkSession.read.schema(df.schema).parquet(path).isEmpty():
        raise RuntimeError(f"refusing to publish an empty table to {root}")
    return path


def promote_snapshot(spark: SparkSession, root: str, path: str) -> None:
    """Make a written snapshot the one readers see, by replacing one small file."""
    _replace_pointer(spark, root.rstrip("/"), path.rstrip("/").rsplit("/", 1)[1])


def publish_snapshot(df: DataFrame, root: str, allow_empty: bool = False) -> str:
    """Replace the table at ``root``; readers see the old or the new rows whole.

    The rows go to a new folder through Spark's committer.  Only when they are
    complete, readable and not empty is the pointer file replaced, so a failed
    write leaves the old table in place and the plan may read ``root`` itself.
    """
    path = write_snapshot(df, root, allow_empty)
    promote_snapshot(df.sparkSession, root, path)
    return path


def _replace_pointer(spark: SparkSession, root: str, name: str) -> None:
    """Replace the one line of the pointer file below ``root``."""
    fs, part = _file_system(spark, f"{root}/{_POINTER}.{uuid.uuid4().hex}.part")
    out = fs.create(part, True)
    try:
        out.write(bytearray(name.encode("utf-8")))
    finally:
        out.close()
    jvm = spark.sparkContext._jvm
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    modes = spark.sparkContext._gateway.new_array(rename, 1)
    modes[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        part.toUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    context.rename(part, jvm.org.apache.hadoop.fs.Path(f"{root}/{_POINTER}"), modes)


def current_snapshot(spark: SparkSession, root: str) -> str | None:
    """Path of the published snapshot, or None before the first publish."""
    name = _pointed(spark, root)
    return None if name is None else f"{root.rstrip('/')}/{name}"


def _pointed(spark: SparkSession, root: str) -> str | None:
    fs, pointer = _file_system(spark, f"{root.rstrip('/')}/{_POINTER}")
    return spark.read.text(pointer.toString()).first()[0].strip() if fs.exists(pointer) else None


def read_snapshot(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    path = current_snapshot(spark, root)
    if path is None:
        raise FileNotFoundError(f"nothing published at {root}")
    return spark.read.schema(schema).parquet(path)


def require_outputs(spark: SparkSession, roots: list[str]) -> None:
    """Gate: every artefact exists and is not empty."""
    missing = []
    for root in roots:
        fs, path = _file_system(spark, root)
        if not fs.exists(path) or fs.getContentSummary(path).getLength() == 0:
            missing.append(root)
    if missing:
        raise RuntimeError(f"missing outputs: {missing}")


# --- sets published together -------------------------------------------------

def publish_set(spark: SparkSession, manifest: str, snapshots: dict[str, str]) -> None:
    """Make a set of written snapshots the one readers see.

    All must be there and hold data.  The manifest names them in one line of one
    small file, which is replaced as a whole: readers find the old set or the new
    one, never parts of both.
    """
    require_outputs(spark, list(snapshots.values()))
    _replace_pointer(spark, manifest.rstrip("/"), json.dumps(snapshots, sort_keys=True))


def published_set(spark: SparkSession, manifest: str) -> dict[str, str]:
    """The published snapshots by name; empty before the first publish."""
    line = _pointed(spark, manifest)
    return json.loads(line) if line else {}


def write_artefacts(df: DataFrame, roots: dict[str, str], year_column: str = "ra_year",
                    curated: str | None = None) -> dict[str, str]:
    """Fresh snapshots of a stored table: ``curated``, ``partitions``, ``csv`` and ``jsonl`` below their roots.

    Nothing that readers see is touched.  ``curated`` may name a snapshot that
    was written already.
    """
    out = {"curated": curated or write_snapshot(df, roots["curated"])}
    out |= {name: snapshot_path(roots[name]) for name in ("partitions", "csv", "jsonl")}
    write_partitions(df, out["partitions"], year_column)
    write_csv(df, out["csv"])
    write_jsonl(df, out["jsonl"])
    return out


def read_artefact(spark: SparkSession, snapshots: dict[str, str], name: str, schema: T.StructType) -> DataFrame:
    """A published artefact in the columns of ``schema``; CSV comes as text."""
    if name not in snapshots:
        raise FileNotFoundError(f"{name} was not published")
    path = snapshots[name]
    if name == "csv":
        return read_csv(spark, path, schema.names)
    if name == "jsonl":
        return read_jsonl(spark, path, schema)
    if name == "partitions":
        return read_partitions(spark, path, schema).drop("year")
    return spark.read.schema(schema).parquet(path)


# --- year partitions -------------------------------------------------------

@dataclass(frozen=True)
class PartitionStats:
    """What a partitioned write has written: rows from the write itself, partitions and bytes from the committed files."""

    n_partitions: int
    years_min: int | None
    years_max: int | None
    rows_written: int
    rows_excluded: int
    bytes: int


def write_partitions(
    df: DataFrame, root: str, source_column: str = "ra_year", partition: str = "year",
    incremental: bool = False,
) -> PartitionStats:
    """Hive-style partitions by year; rows without a year are left out.

    The full write replaces the whole root, which also sweeps years that are
    gone.  ``incremental`` replaces only the years present in ``df``.  The
    rebalance hint makes few files for a small year and splits a huge one over
    many tasks.  Rows are counted while they are written; partitions and bytes
    are those of the committed listing, so after an incremental write of the
    whole root.
    """
    spark, seen = df.sparkSession, Observation()
    year = F.col(source_column)
    counts = [F.count(F.lit(1)).alias("rows"), F.count(year).alias("dated"),
              F.min(year).cast("long").alias("low"), F.max(year).cast("long").alias("high")]
    keyed = df.observe(seen, *counts).where(year.isNotNull()).withColumn(partition, year)
    (
        keyed.hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if incremental else "static")
        .partitionBy(partition)
        .parquet(root)
    )
    sizes = partition_bytes(spark, root, partition)
    # Of a plan found to be empty Spark may run nothing, and then it has observed nothing.
    told = seen.get if sizes else df.agg(*counts).first().asDict()
    return PartitionStats(len(sizes), told["low"], told["high"], told["dated"], told["rows"] - told["dated"], sum(sizes.values()))


def partition_bytes(spark: SparkSession, root: str, partition: str = "year") -> dict[str, int]:
    """Bytes of the data files of each partition folder below ``root``."""
    fs, path = _file_system(spark, root)
    sizes = {}
    for folder in fs.listStatus(path):
        name = folder.getPath().getName()
        if name.startswith(f"{partition}="):
            files = [f for f in fs.listStatus(folder.getPath()) if not f.getPath().getName().startswith(("_", "."))]
            if files:
                sizes[name.split("=", 1)[1]] = sum(f.getLen() for f in files)
    return sizes


def read_partitions(spark: SparkSession, root: str, schema: T.StructType, partition: str = "year",
                    values: list[int] | None = None) -> DataFrame:
    """The partitioned table; ``values`` become partition filters."""
    full = T.StructType([*schema.fields, T.StructField(partition, T.LongType())])
    df = spark.read.schema(full).parquet(root)
    return df if values is None else df.where(F.col(partition).isin(values))


def planned_partitions(df: DataFrame, source_column: str = "ra_year") -> DataFrame:
    """Sorted distinct partition values."""
    keyed = df.where(F.col(source_column).isNotNull())
    return keyed.select(F.col(source_column).cast("long").alias("year")).distinct().orderBy("year")


def stored_bytes(spark: SparkSession, root: str) -> int:
    """Size of everything stored below ``root``."""
    fs, path = _file_system(spark, root)
    return fs.getContentSummary(path).getLength()


# --- text exports ----------------------------------------------------------

def rows_per_file(df: DataFrame, file_bytes: int, looked_at: int = 2_000) -> int:
    """About how many rows make ``file_bytes`` of text, by the first rows; files are sized by it, nothing else."""
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(4 * len(df.columns)))
    mean = df.limit(looked_at).agg(F.avg(width).alias("mean")).first().mean
    return max(1, int(file_bytes / mean)) if mean else 1


def write_csv(df: DataFrame, path: str, file_bytes: int = CSV_FILE_BYTES) -> None:
    """CSV with every field quoted, in files small enough that many tasks can read them."""
    (
        df.write.mode("overwrite")
        .option("header", True).option("quoteAll", True).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", rows_per_file(df, file_bytes))
        .csv(path)
    )


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All-string read-back; only the empty field is null."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return (
        spark.read.schema(schema)
        .option("header", True).option("multiLine", True).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def text_hashes(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Key plus the SHA-256 of every listed text column."""
    return df.select(key, *[F.sha2(F.col(c).cast("string"), 256).alias(f"{c}_sha256") for c in columns])


# --- format comparison -----------------------------------------------------

def compare_formats(df: DataFrame, root: str, year_column: str, timings: bool = True) -> DataFrame:
    """Write and read back four formats; one row per format.

    ``df`` should be a stored table, not a long plan: it is written four times.
    """
    spark = df.sparkSession
    schema, names = df.schema, df.columns
    total = df.agg(F.count(F.lit(1)).alias("n"))
    keyed = df.agg(F.count(year_column).alias("n"))
    formats: list[tuple[str, Callable[[str], None], Callable[[str], DataFrame], DataFrame]] = [
        ("parquet_single", lambda p: df.write.parquet(p),
         lambda p: spark.read.schema(schema).parquet(p), total),
        ("parquet_partitioned", lambda p: write_partitions(df, p, year_column),
         lambda p: read_partitions(spark, p, schema).drop("year"), keyed),
        ("csv", lambda p: write_csv(df, p), lambda p: read_csv(spark, p, names), total),
        ("json_lines", lambda p: write_jsonl(df, p), lambda p: read_jsonl(spark, p, schema), total),
    ]
    out: DataFrame | None = None
    for label, write, read, expected in formats:
        path = f"{root.rstrip('/')}/{label}"
        started = time.perf_counter()
        write(path)
        write_seconds = time.perf_counter() - started
        back = read(path)
        found = back.agg(F.count(F.lit(1)).alias("rows"))
        extra: list[Column] = []
        if timings:
            started = time.perf_counter()
            back.write.format("noop").mode("overwrite").save()
            extra = [
                F.lit(stored_bytes(spark, path)).cast("long").alias("size_bytes"),
                F.lit(round(write_seconds, 3)).alias("write_seconds"),
                F.lit(round(time.perf_counter() - started, 3)).alias("read_seconds"),
            ]
        row = found.select(
            F.lit(label).alias("format"),
            "rows",
            F.lit(back.columns == names).alias("columns_match"),
            (F.col("rows") == expected.scalar()).alias("rows_match"),
            *extra,
        )
        out = row if out is None else out.unionByName(row)
    assert out is not None
    return out

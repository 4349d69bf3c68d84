"""Incremental landing: new files of a folder go into a published table.

The stream's checkpoint is the record of what has landed, so a second run over
the same folder reads nothing.  Every run ends when the folder is exhausted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from foliospark.operators.reconcile import keep_first
from foliospark.sources.buckets import BUCKETS, upsert_buckets


def land_new_files(spark: SparkSession, folder: str, root: str, schema: T.StructType, key: str,
                   order: list[str], checkpoint: str, file_format: str = "parquet", buckets: int = BUCKETS) -> int:
    """Upsert the rows of all new files into the bucketed table at ``root``, rewriting the buckets they touch.

    A batch that is replayed after a failure merges the same rows again and
    changes nothing.  ``order`` picks the row to keep when files repeat a key.
    Returns the number of batches merged, 0 when nothing was new.
    """
    batches: list[int] = []

    def merge(rows: DataFrame, batch: int) -> None:
        upsert_buckets(keep_first(rows, [key], order), root, key, buckets)
        batches.append(batch)

    stream = (
        spark.readStream.schema(schema).format(file_format).load(folder)
        .writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    stream.awaitTermination()
    return len(batches)

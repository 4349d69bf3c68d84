"""Incremental landing over a folder that grows."""

from foliospark.sources import buckets
from foliospark.streaming.landing import land_new_files


def test_land_new_files(spark, tmp_path):
    folder, root, mark = (str(tmp_path / n) for n in ("in", "table", "mark"))
    first = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    first.coalesce(1).write.parquet(folder)

    def run():
        return land_new_files(spark, folder, root, first.schema, "id", ["v"], mark)

    assert run() == 1 and run() == 0
    before = buckets.bucket_folders(spark, root)
    spark.createDataFrame([(2, "z"), (2, "y"), (3, "c")], first.schema).coalesce(1).write.mode("append").parquet(folder)
    assert run() == 1
    after = buckets.bucket_folders(spark, root)
    touched = {b for b in after if after[b] != before.get(b)}
    assert len(touched) <= 2 and set(before) - touched
    rows = buckets.read_buckets(spark, root, first.schema).collect()
    assert sorted(map(tuple, rows)) == [(1, "a"), (2, "y"), (3, "c")]

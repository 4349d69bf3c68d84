"""A key that holds a third of all rows is split at run time."""

import pytest
from pyspark.sql import functions as F

from foliospark.operators import checks, profile, reconcile, upsert

LOW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture()
def small_thresholds(spark):
    before = {k: spark.conf.get(k, None) for k in LOW}
    for k, v in LOW.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_rows(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 2000))
    return spark.range(0, 30000, 1, 6).select("id", key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("text"))


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_hot_duplicates_are_split(spark, small_thresholds):
    found = reconcile.duplicate_rows(hot_rows(spark), ["k"])
    assert len(found.collect()) == 30000
    assert "skew=true" in final_plan(found)


def test_hot_gap_fill_is_split(spark, small_thresholds):
    rows = hot_rows(spark).withColumn("day", F.lit(None).cast("string"))
    lookup = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("k"), F.lit("2000-01-01").alias("day"))
    lookup = lookup.union(spark.createDataFrame([("hot", "1999-09-09")], lookup.schema))
    filled = reconcile.gap_fill(rows, lookup, "k", "day")
    counts = {}
    for r in filled.collect():
        counts[r.day] = counts.get(r.day, 0) + 1
    assert counts == {"1999-09-09": 10000, "2000-01-01": 20000}
    assert "skew=true" in final_plan(filled)


def test_hot_anti_join_is_split(spark, small_thresholds):
    secondary = hot_rows(spark)
    primary = spark.range(500).select("id", F.concat(F.lit("k"), "id").alias("k"), F.lit("t").alias("text"))
    merged = reconcile.append_missing(primary, secondary, "k")
    kept = secondary.where("k = 'hot' or cast(substring(k, 2) as int) >= 500").count()
    assert len(merged.collect()) == 500 + kept
    assert "skew=true" in final_plan(merged)


def test_hot_key_keeps_one_row_per_task(spark, small_thresholds):
    first = reconcile.keep_first(hot_rows(spark), ["k"], ["id"])
    assert first.count() == 2001 and first.where("k = 'hot'").first().id == 0
    # Every task cuts its rows to one per key before the exchange.
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange")[1]


def test_hot_values_are_counted_before_the_exchange(spark, small_thresholds):
    rows = hot_rows(spark).withColumn("ra_id", F.col("k"))
    result = checks.run_rules(rows, [checks.unique_rule(["ra_id"]), checks.source_rule("k")]).collect()
    told = {r.check_name: r for r in result}
    assert told["ra_id_unique"].violations == 30000 and told["source_distribution"].message.startswith("source distribution: {'hot': 10000")
    counted = checks.tally(rows, [checks.unique_rule(["ra_id"])])
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and plan.count("Exchange hashpartitioning") == 1


def test_hot_value_in_a_summary(spark, small_thresholds):
    rows = hot_rows(spark).select(F.when(F.col("k") == "hot", 5.0).otherwise(F.col("id").cast("double")).alias("v"))
    row = profile.numeric_summary(rows, ["v"], splits=16, most=500).first()
    values = sorted(5.0 if i % 3 == 0 else float(i) for i in range(30000))
    middle = (values[14999] + values[15000]) / 2
    assert row["count"] == 30000 and row.median == middle and row.p25 == 5.0


def test_hot_bucket_of_an_upsert_is_split(spark, small_thresholds):
    """Keys of a merge are unique, so no key is hot; a target of one bucket still spreads over many tasks."""
    target = hot_rows(spark).drop("k")
    merged = upsert.upsert(target, target.where("id % 7 = 0").withColumn("text", F.lit("new")), "id")
    assert merged.where("text = 'new'").count() == 4286 and merged.count() == 30000

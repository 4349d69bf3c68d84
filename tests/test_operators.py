"""Reconciling, merging, checking and profiling small tables."""

import random
import re
from datetime import date

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from foliospark import constants as K
from foliospark.contract import CURATED_CONTRACT, Contract
from foliospark.operators import checks, profile, reconcile, upsert
from foliospark.plans import corpus
from foliospark.sources import writers

STAGED = ("ra_id string, ra_number string, ra_year long, title string, approval_date string, content_clean string, "
          "content_length long, word_count long, source string, source_path string")


def staged(spark, rows, source="bettergov_parquet"):
    """Rows of (number, year, day, words, path)."""
    return spark.createDataFrame([
        (f"RA-{n}", n, y, f"Title {n}", d, " ".join(["word"] * w), 5 * w, w, source, p) for n, y, d, w, p in rows
    ], STAGED)


@pytest.fixture()
def sources(spark):
    primary = staged(spark, [("1", 2000, None, 9, "b"), ("1", 2001, "2001-01-01", 9, "c"), ("1", 2002, None, 2, "a"),
                             ("2", 2000, "2000-05-05", 9, "d"), ("3", 2000, None, 1, "e")])
    secondary = staged(spark, [("2", 1999, None, 9, "x"), ("3", 1999, None, 1, "y"), ("4", 1999, None, 9, "z")],
                       "lawphil_html")
    lookup = staged(spark, [("1", 2000, None, 1, "1"), ("1", 2000, "2000-02-02", 1, "2"), ("1", 2000, "2000-03-03", 1, "3"),
                            ("2", 2000, "1990-01-01", 1, "4"), ("4", 2000, "1999-09-09", 1, "5")], "elibrary_json")
    return primary, secondary, lookup


def test_curate(spark, sources):
    got = {r.ra_id: r for r in corpus.curate(*sources).collect()}
    # A stub does not shadow the good row; the secondary only adds keys the primary lost or lacks.
    assert {k: (r.source_path, r.approval_date) for k, r in got.items()} == {
        "RA-1": ("b", "2000-02-02"), "RA-2": ("d", "2000-05-05"), "RA-3": ("y", None), "RA-4": ("z", "1999-09-09")}
    assert list(corpus.curate(*sources).columns) == list(K.CURATED_COLUMNS)


def test_curate_is_layout_free(spark, sources):
    want = sorted(map(tuple, corpus.curate(*sources).collect()))
    spread = [df.repartition(n) for df, n in zip(sources, (3, 5, 7))]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        assert sorted(map(tuple, corpus.curate(*spread).collect())) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_publish(spark, sources, tmp_path):
    clean = [df.where("ra_number <> '3'") for df in sources]
    paths = corpus.CorpusPaths(*[str(tmp_path / n) for n in ("curated", "parts", "csv", "jsonl", "manifest")])
    with pytest.raises(FileNotFoundError):
        corpus.read_published(spark, paths)
    results = corpus.publish(spark, corpus.curate(*clean), paths, today=date(2026, 1, 1))
    assert results.where("status = 'fail'").count() == 0
    before = writers.published_set(spark, paths.manifest)
    want = sorted(r.ra_id for r in corpus.curate(*clean).collect())
    for name in before:
        assert sorted(r.ra_id for r in corpus.read_published(spark, paths, name).collect()) == want
    with pytest.raises(checks.ValidationError, match="content_non_stub"):
        corpus.publish(spark, corpus.curate(*sources), paths, today=date(2026, 1, 1))
    assert writers.published_set(spark, paths.manifest) == before


@pytest.mark.parametrize("broken", ["write_partitions", "write_csv", "write_jsonl", "require_outputs"])
def test_failed_publish_keeps_the_old_set(spark, sources, tmp_path, monkeypatch, broken):
    clean = [df.where("ra_number <> '3'") for df in sources]
    paths = corpus.CorpusPaths(*[str(tmp_path / n) for n in ("curated", "parts", "csv", "jsonl", "manifest")])
    corpus.publish(spark, corpus.curate(*clean), paths, today=date(2026, 1, 1))
    before = writers.published_set(spark, paths.manifest)

    def fails(*_, **__):
        raise OSError("disk is gone")

    monkeypatch.setattr(writers, broken, fails)
    with pytest.raises(OSError):
        corpus.publish(spark, corpus.curate(*[df.where("ra_number = '2'") for df in sources]), paths, today=date(2026, 1, 1))
    monkeypatch.undo()
    assert writers.published_set(spark, paths.manifest) == before
    assert all(corpus.read_published(spark, paths, name).count() == 3 for name in before)


def test_texts_cross_the_network_once(spark, sources):
    """Curating decides on narrow rows; whole texts are exchanged for one join, or not at all if that is small."""
    numbered = corpus.store_staged(spark, numbered=True, primary=sources[0], secondary=sources[1])
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)

    def exchanges():
        curated = corpus.curate(numbered["primary"], numbered["secondary"], sources[2])
        plan = curated._jdf.queryExecution().executedPlan().toString()
        # An exchange shows its columns in the scan or projection below it; texts are read in the plan's branches alone.
        assert len(re.findall(r"ReadSchema: struct<[^\n]*content_clean", plan)) == 2
        return len(re.findall(r"Exchange hashpartitioning", plan)), curated.count()

    small, rows = exchanges()
    try:
        spark.conf.set(threshold, "-1")
        large, again = exchanges()
    finally:
        spark.conf.set(threshold, before)
    # One exchange for the texts and one for the decisions.
    assert small == 0 and large == 2 and rows == again == 4


def test_dedupe_properties(spark):
    rng = random.Random(3)
    rows = [(i, "hot" if rng.random() < 0.4 else f"k{rng.randrange(60)}", None if i % 50 == 0 else i) for i in range(600)]
    df = spark.createDataFrame([(i, k if v is not None else None) for i, k, v in rows], "id int, k string")
    first = {r.k: r.id for r in reconcile.keep_first(df, ["k"], ["id"]).collect()}
    groups = {}
    for r in df.collect():
        groups.setdefault(r.k, []).append(r.id)
    assert first == {k: min(v) for k, v in groups.items()}
    assert sorted(r.id for r in reconcile.duplicate_rows(df, ["k"]).collect()) == sorted(
        i for v in groups.values() if len(v) > 1 for i in v)
    assert sorted(r.id for r in reconcile.later_duplicates(df, ["k"], ["id"]).collect()) == sorted(
        i for v in groups.values() for i in v if i != min(v))


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id", "id div 60 as k")
    plan = reconcile.keep_first(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_gap_fill_properties(spark):
    rows = [(str(i % 7), None if i % 3 else f"2000-01-{i % 28 + 1:02d}", i) for i in range(60)] + [(None, None, 99)]
    base = spark.createDataFrame(rows, "ra_number string, approval_date string, i int")
    lookup = spark.createDataFrame([(str(n), f"1999-01-0{n}") for n in range(1, 5)], "ra_number string, approval_date string")
    got = {r.i: r for r in reconcile.gap_fill(base, lookup, flag="recovered").collect()}
    assert len(got) == len(rows)
    for number, day, i in rows:
        want = day or (f"1999-01-0{number}" if number in {"1", "2", "3", "4"} else None)
        assert got[i].approval_date == want and got[i].recovered == (day is None and want is not None)
    audit = reconcile.gap_fill_audit(reconcile.gap_fill(base, lookup, flag="recovered")).first()
    assert audit.nulls_before - audit.nulls_after == audit.recovered and audit.n_rows == len(rows)


def test_project_needs_all_columns(spark):
    with pytest.raises(ValueError, match="title"):
        reconcile.project(spark.range(1).toDF("ra_id"), ["ra_id", "title"])


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, v string")
    source = spark.createDataFrame([(2, None), (3, "c"), (4, "d")], "id int, v string")
    once = upsert.upsert(target, source, "id")
    want = [(1, "a"), (2, None), (3, "c"), (4, "d")]
    assert sorted(map(tuple, once.collect())) == want
    assert sorted(map(tuple, upsert.upsert(once, source, "id").collect())) == want
    counts = {r.action: r.n for r in upsert.upsert_counts(target, source, "id").collect()}
    assert counts == {"kept": 1, "updated": 2, "inserted": 1}
    again = {r.action: r.n for r in upsert.upsert_counts(once, source, "id").collect()}
    assert again == {"kept": 1, "updated": 3}
    for job in (upsert.upsert, upsert.upsert_counts):
        with pytest.raises(Exception, match="duplicate source key: 2"):
            job(target, source.union(source.where("id = 2")), "id").collect()
    with pytest.raises(ValueError):
        upsert.upsert(target, source.drop("v"), "id")


def curated(spark, **change):
    base = dict(ra_id="RA-1", ra_number="1", ra_year=2000, title="t", approval_date="2000-01-01", content_clean="a b c d e",
                content_normalized="a b c d e", content_length=9, word_count=5, source="bettergov_parquet", source_path="p")
    rows = [{**base, "ra_id": f"RA-{i}", "ra_number": str(i)} for i in range(1, 9)]
    for at, values in change.items():
        rows[int(at[1:])].update(values)
    return spark.createDataFrame([tuple(r[c] for c in K.CURATED_COLUMNS) for r in rows], Contract.parse().schema())


def outcome(spark, df, **kw):
    return {r.check_name: r for r in checks.run_all(df, today=date(2026, 1, 1), **kw).collect()}


def test_clean_table_passes(spark):
    got = outcome(spark, curated(spark))
    assert len(got) == 10 and {r.status for r in got.values()} == {"pass"}
    assert got["approval_date_valid"].message == "All 8 non-null approval_date values are valid ISO dates"
    assert got["source_distribution"].message == "source distribution: {'bettergov_parquet': 8}"
    assert got["year_range"].message == "All ra_year values in [1946, 2027]"
    row = checks.summarize(checks.run_all(curated(spark), today=date(2026, 1, 1))).first()
    assert (row.total_checks, row.passed, row.overall_status) == (10, 10, "pass")


def test_each_rule_fails(spark):
    df = curated(
        spark, r0=dict(ra_id="RA-2"), r2=dict(title=None), r3=dict(ra_year=1900), r4=dict(word_count=4),
        r5=dict(content_normalized=None), r6=dict(ra_number=None, source="x"),
        r7=dict(approval_date="2015-7-6", content_length=600_000), r1=dict(approval_date="soon"),
    )
    got = outcome(spark, df)
    assert got["schema_conformance"].status == "pass"
    assert (got["ra_id_unique"].violations, got["ra_id_unique"].samples) == (2, ["RA-2"])
    assert got["required_non_null"].violations == 3
    assert got["required_non_null"].samples == ["content_normalized: 1 null(s)", "ra_number: 1 null(s)", "title: 1 null(s)"]
    assert (got["year_range"].violations, got["year_range"].samples) == (1, ["1900"])
    assert got["content_non_stub"].samples == ["RA-5"]
    assert got["content_normalized_non_empty"].samples == ["RA-6"]
    assert (got["ra_number_shape"].violations, got["ra_number_shape"].samples) == (1, ["null"])
    # A value that has neither the shape nor a date counts twice.
    assert got["approval_date_valid"].violations == 3
    assert got["approval_date_valid"].samples == ["non-ISO: 2015-7-6", "non-ISO: soon", "unparseable: soon"]
    assert got["source_distribution"].status == "warn"
    assert got["source_distribution"].message == "source distribution: {'bettergov_parquet': 7, 'x': 1}"
    assert (got["oversized_content"].status, got["oversized_content"].samples) == ("warn", ["RA-8 (600,000 chars)"])
    with pytest.raises(checks.ValidationError):
        checks.gate(checks.run_all(df, today=date(2026, 1, 1)))


def test_schema_and_crashes(spark):
    df = curated(spark).drop("word_count").withColumn("extra", F.lit(1)).withColumn("ra_year", F.col("ra_year").cast("int"))
    got = outcome(spark, df, extra=[_broken, _custom])
    assert got["schema_conformance"].violations == 3
    assert got["content_non_stub"].status == "fail" and got["content_non_stub"].message.startswith("check crashed")
    assert got["_broken"].status == "fail" and got["custom"].status == "pass"
    assert got["required_non_null"].samples == ["word_count: column missing"]


def _broken(df):
    raise ValueError("no luck")


def _custom(df):
    return checks.check_row_band(df, 1, 10).withColumn("check_name", F.lit("custom"))


def test_samples_are_bounded_and_counts_are_not(spark):
    df = spark.range(1000).selectExpr("concat('RA-', id) as ra_id", "'' as content_normalized")
    row = checks.run_rules(df, [checks.non_empty_rule()]).first()
    assert row.violations == 1000 and len(row.samples) == 5


def test_report_scans_once(spark, tmp_path):
    path = str(tmp_path / "c")
    curated(spark).write.parquet(path)
    df = checks.run_rules(spark.read.parquet(path), checks.contract_rules(Contract.parse(), list(K.CURATED_COLUMNS)))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1 and "ReusedExchange" in final


def test_contract():
    contract = Contract.parse()
    assert contract.revision == "1.2" and len(contract.columns) == 11 and len(contract.rules) == 10
    assert contract.key == "ra_id" and "approval_date" not in contract.required()
    assert contract.columns["ra_number"].pattern == r"^\d+[a-z]?$"
    assert contract.unique == {"ra_number_year_unique": ("ra_number", "ra_year")}
    odd = {**CURATED_CONTRACT, "schema": {**CURATED_CONTRACT["schema"], "fields": [{"name": "f", "type": "float", "nullable": True}]}}
    with pytest.raises(KeyError):
        Contract.parse(odd)
    assert contract.rules["ra_id_unique"].params == {}


def test_composite_keys_of_nulls_and_separators(spark):
    rows = [("1950", None), (None, "1950"), ("a|b", "c"), ("a", "b|c"), ("x", "y"), ("x", "y")]
    df = spark.createDataFrame(rows, "p string, q string")
    got = checks.run_rules(df, [checks.unique_rule(["p", "q"])]).first()
    assert (got.status, got.violations) == ("fail", 2)


@pytest.mark.parametrize("splits", [4, 512])
def test_percentiles_are_exact(spark, splits):
    rng = np.random.default_rng(5)
    data = {"few": rng.integers(0, 6, 999).astype(float), "many": rng.normal(size=999), "hot": np.zeros(999)}
    data["hot"][:400] = rng.normal(size=400)
    rows = list(zip(*[map(float, v) for v in data.values()]))
    df = spark.createDataFrame(rows + [(None, float("nan"), 0.0)], "few double, many double, hot double").repartition(5)
    got = {r.name: r for r in profile.numeric_summary(df, list(data), splits).collect()}
    data["hot"] = np.append(data["hot"], 0.0)
    for name, values in data.items():
        want = [len(values), values.min(), *np.quantile(values, [0.25, 0.5]), values.mean(), np.quantile(values, 0.75), values.max()]
        assert np.allclose(list(got[name])[1:], want)


def test_column_profile(spark):
    df = spark.createDataFrame([(2, "b|c\nd", None), (1, None, None), (3, "x" * 90, None)], "id int, s string, n int")
    got = {r.name: r for r in profile.column_profile(df, ["id"]).collect()}
    assert (got["s"].nulls, got["s"].null_pct, got["s"].distinct_values, got["s"].sample) == (1, 33.33, 2, "b\\|c d")
    assert (got["n"].non_null, got["n"].distinct_values, got["n"].sample) == (0, 0, "")
    issues = {r.name: r.note for r in profile.null_issues(profile.column_profile(df, ["id"])).collect()}
    assert issues["s"] == "`s` is 33.33% null (1/3)." and set(issues) == {"s", "n"}


def test_listing_is_bounded_and_whole_as_rows(spark):
    df = spark.range(300).selectExpr("cast(id % 150 as string) as source")
    message = checks.run_rules(df, [checks.source_rule()]).first().message
    assert message.count("': 2") == checks.MAX_LISTED and message.endswith(", and 100 more}")
    assert {tuple(r) for r in profile.source_distribution(df).collect()} == {(str(k), 2) for k in range(150)}
    whole = checks.run_rules(df, [checks.source_rule()], max_listed=150).first().message
    assert whole.count("': 2") == 150 and "more" not in whole
    short = checks.run_rules(df, [checks.source_rule()], max_listed=3).first().message
    assert short == "source distribution: {'0': 2, '1': 2, '10': 2, and 147 more}"


def test_null_and_empty_keys_are_apart(spark):
    df = spark.createDataFrame([(None,), ("",), ("a",)], "ra_id string")
    assert checks.run_rules(df, [checks.unique_rule(["ra_id"])]).first().violations == 0
    row = checks.run_rules(df.union(df), [checks.unique_rule(["ra_id"])]).first()
    assert row.violations == 6 and row.samples == ["", "a", "null"]


def test_checks_fail_alone(spark):
    """Checks that fail while they run, in Python, in Spark or when built, become rows; all others stand."""
    @F.pandas_udf("long")
    def fails(column: pd.Series) -> pd.Series:
        raise ValueError("wrong year")

    def in_python(df):
        return checks.check_null_rate(df.where(fails("ra_year") > 0), "title", 0.1)

    def in_spark(df):
        return checks.check_row_band(df.where(F.raise_error(F.concat(F.lit("row "), "ra_id")).isNull()), 0, 9)

    def not_built(df):
        return df.select("no_such_column")

    def good(df):
        return checks.check_row_band(df, 0, 10**6)

    df = curated(spark)
    want = {r.check_name: r for r in checks.run_all(df, today=date(2026, 1, 1)).collect()}
    got = {r.check_name: r for r in checks.run_all(df, today=date(2026, 1, 1), extra=[in_python, good, in_spark, not_built]).collect()}
    assert len(want) == 10 and {k: v for k, v in got.items() if k in want} == want
    assert got["row_band"].status == "pass"
    assert got["in_python"].message == "check crashed: PythonException: ValueError: wrong year" and got["in_python"].status == "fail"
    assert got["in_spark"].message == "check crashed: SparkRuntimeException: USER_RAISED_EXCEPTION"
    assert got["not_built"].message.startswith("check crashed: AnalysisException: UNRESOLVED_COLUMN")


def test_rules_fail_alone(spark, monkeypatch):
    """A row rule that fails on a value takes no other rule with it."""
    rules = checks.contract_rules

    def with_bad_one(*args):
        bad = F.col("ra_year") / F.when(F.col("ra_year") > 0, F.raise_error(F.lit("odd"))).cast("int") > 1
        return [*rules(*args), checks.Rule("odd_rule", "error", "ok", lambda n: F.lit("bad"), bad=[(bad, F.col("ra_id"))])]

    df = curated(spark)
    want = {r.check_name: r for r in checks.run_all(df, today=date(2026, 1, 1)).collect()}
    monkeypatch.setattr(checks, "contract_rules", with_bad_one)
    got = {r.check_name: r for r in checks.run_all(df, today=date(2026, 1, 1)).collect()}
    assert {k: v for k, v in got.items() if k in want} == want
    assert got["odd_rule"].status == "fail" and got["odd_rule"].message.startswith("check crashed: SparkRuntimeException")


def test_schema_report(spark):
    df = spark.createDataFrame([("a", 1, None), ("b", None, None)], "ra_id string, ra_year int, extra string")
    rows = {r.name: r for r in checks.schema_report(df, Contract.parse()).collect()}
    assert len(rows) == 12 and rows["title"].problem == "missing" and rows["title"].non_null == 0
    assert rows["ra_id"].problem is None and rows["ra_id"].non_null == 2
    assert rows["ra_year"].problem == "type" and (rows["ra_year"].found, rows["ra_year"].non_null) == ("int", 1)
    assert rows["extra"].problem == "unexpected" and rows["extra"].expected is None and rows["extra"].non_null == 0


def test_quantiles_by_selection(spark):
    """Ranges are cut until few values are left to order; a third of all rows is one value."""
    rng = np.random.default_rng(6)
    values = np.concatenate([rng.normal(size=4000), np.full(2500, 0.25), 10.0 ** rng.uniform(-8, 8, 1500)])
    df = spark.createDataFrame([(float(v), None if k % 7 else str(k)) for k, v in enumerate(values)], "v double, t string").repartition(6)
    got = {r.name: r for r in profile.numeric_summary(df, ["v", "t"], splits=8, most=40).collect()}
    assert got["v"]["count"] == len(values) and got["t"]["count"] == sum(k % 7 == 0 for k in range(len(values)))
    for name, data in (("v", values), ("t", np.array([k for k in range(len(values)) if k % 7 == 0], float))):
        assert np.allclose([got[name].p25, got[name].median, got[name].p75], np.percentile(data, [25, 50, 75]))
        assert (got[name].min, got[name].max) == (data.min(), data.max()) and np.isclose(got[name].mean, data.mean())
    assert profile.numeric_summary(df.where("v is null"), ["v"]).count() == 0
    one = profile.numeric_summary(spark.createDataFrame([(5.0,)], "v double"), ["v"]).first()
    assert (one.p25, one.median, one.p75) == (5.0, 5.0, 5.0)


def test_only_small_ranges_are_ordered(spark, monkeypatch):
    seen = []
    values_at = profile._values_at
    monkeypatch.setattr(profile, "_values_at", lambda hist, ranges: seen.extend(r["values"] if isinstance(r, dict) else r.values for r in ranges) or values_at(hist, ranges))
    df = spark.range(5000).select(F.pow(F.lit(1.01), F.col("id") % 3000).alias("v"))
    row = profile.numeric_summary(df, ["v"], splits=4, most=25).first()
    assert max(seen) <= 25 and np.isclose(row.median, np.median(1.01 ** (np.arange(5000) % 3000)))


def test_staging_profile(spark):
    df = spark.createDataFrame([("RA-1", 2000, None, 3, "b"), ("RA-1", None, " ", 5, "a")], "ra_id string, ra_year long, title string, word_count long, source_path string")
    rows = {(r.part, r.name, r.metric): r.value for r in profile.staging_profile(df, ["source_path"]).collect()}
    assert rows["derived", "", "duplicate_ra_id"] == "1" and rows["derived", "", "empty_title"] == "1"
    assert rows["numeric", "word_count", "median"] == "4.0" and rows["numeric", "ra_year", "count"] == "1"
    assert rows["column", "ra_year", "nulls"] == "1" and rows["column", "source_path", "sample"] == "a"
    assert rows["note", "ra_year", "note"] == "`ra_year` is 50.00% null (1/2)." and ("note", "ra_id", "note") not in rows

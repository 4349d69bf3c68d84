"""Catalog queries against their SQL twins and their plans."""

import inspect
import re
from types import SimpleNamespace

import duckdb
import pytest

import __spark_entry__ as entry
from foliospark.plans import catalog
from scripts.oracle_check import connect, normal

# One query per family; scripts/oracle_check.py compares all of them.
COMPARED = [
    "json_tuple_explode", "upsert_merge", "landing_manifest", "stage_html", "curated_projection", "row_reconciliation",
    "gap_fill_audit", "validation_report", "check_constraints", "column_profile", "numeric_summary",
    "json_index_profile", "tfidf_weights", "cluster_theme_report", "select_k", "csv_roundtrip_hash",
    "partition_stats", "upsert_bucketed", "full_replace", "published_artefacts", "optional_source", "index_table_links",
    "check_schema", "schema_report", "validation_isolated", "contract_rules", "staging_profile", "cluster_scatter_join",
    "svd_project",
]
# Built without running a job, so their plans are cheap to look at.
LAZY = [
    "scan_parquet_projection", "stage_markdown", "stage_index", "normalize_content", "dedupe_first", "duplicate_groups",
    "merge_primary_secondary", "gap_fill_date", "upsert_merge", "column_profile", "count_by_month", "term_doc_freq",
]


@pytest.fixture(scope="module")
def con(sf_dir) -> duckdb.DuckDBPyConnection:
    return connect(sf_dir)


@pytest.mark.parametrize("name", COMPARED)
def test_against_sql(spark, con, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    twin = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(twin.columns)
    assert normal(df.columns, df.collect()) == normal(twin.columns, twin.fetchall())


@pytest.mark.parametrize("name", LAZY)
def test_plans(spark, sf_dir, name):
    plan = entry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython", plan)
    python = "ArrowEvalPython" in plan or "MapInPandas" in plan
    assert python == (name == "normalize_content")


def test_pushdown(spark, sf_dir):
    plan = entry.queries()["scan_parquet_projection"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "EqualTo(lang,en)" in plan and "ReadSchema: struct<doc_id:bigint,lang:string,source:string,n_chars:bigint>" in plan


def test_entry(spark, sf_dir):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_cluster_metrics_sweeps_all(spark, sf_dir, monkeypatch):
    """The sweep and the final fit are asked for with the operators' defaults."""
    asked, kmeans = {}, catalog.kmeans

    def bound(name):
        signature = inspect.signature(getattr(kmeans, name))

        def record(*args, **more):
            call = signature.bind(*args, **more)
            call.apply_defaults()
            asked[name] = {p: call.arguments.get(p) for p in ("k", "k_min", "k_max", "n_init")}
            if name == "sweep_k":
                rows = [(k, 100.0 / k, 1 - abs(k - 9) / 50) for k in range(call.arguments["k_min"], call.arguments["k_max"] + 1)]
                return spark.createDataFrame(rows, kmeans.SWEEP_SCHEMA)
            return SimpleNamespace(summary=SimpleNamespace(trainingCost=1.0))
        return record

    for name in ("sweep_k", "fit_best"):
        monkeypatch.setattr(kmeans, name, bound(name))
    monkeypatch.setattr(kmeans, "sample_silhouette", lambda *_: 0.5)
    row = catalog.cluster_metrics(spark, sf_dir).first()
    assert asked["sweep_k"] == {"k": None, "k_min": 2, "k_max": 30, "n_init": 10}
    assert asked["fit_best"]["n_init"] == 10 and asked["fit_best"]["k"] in range(5, 31)
    assert row.n_swept == 29 and row.k_in_range and not row.final_fit_agrees

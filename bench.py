"""Time the headline queries; prints one JSON line.

Every query runs to completion into a sink that discards its rows, after one
small warm-up job.  The unit is seconds of wall clock on local[BENCH_CPUS].
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from foliospark.plans.catalog import QUERIES  # noqa: E402
from foliospark.session import build_session  # noqa: E402

HEADLINE = [
    "stage_markdown", "stage_index", "stage_html", "normalize_content", "dedupe_first", "duplicate_groups",
    "curated_projection", "gap_fill_date", "validation_report", "column_profile", "numeric_summary",
    "partition_pruned_read", "csv_roundtrip_hash", "jsonl_roundtrip", "format_comparison", "upsert_merge",
    "term_doc_freq", "tfidf_weights", "text_search_and", "cluster_top_terms", "centroid_distance",
    "silhouette_exact", "kmeans_assign", "count_by_year",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g", "spark.sql.shuffle.partitions": cpus,
    })
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/documents.parquet").groupBy("lang").count().collect()
    seconds: dict[str, float] = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name:26s} {seconds[name]:8.3f}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""Every operator as a named query over the test tables."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import date

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F

from foliospark import constants as K
from foliospark.contract import Contract
from foliospark.functions import anchors, dates, html, text
from foliospark.operators import (
    checks, cluster, kmeans, profile, reconcile, search, stage, temporal, tfidf, upsert,
)
from foliospark.plans import bridge, corpus
from foliospark.session import scratch_path, stored
from foliospark.sources import buckets, landing, readers, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The contract's year rule depends on the day; the queries pin it.
TODAY = date(2026, 1, 1)
STOP_WORDS = K.STOP_WORDS
SEARCH_WORDS = ("the", "with", "from")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- shared inputs ---------------------------------------------------------

def _documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents under the names of the curated table."""
    return bridge.spread(bridge.table(spark, sf, "documents")).select(
        "doc_id", F.col("text").alias("content_clean"), "lang", "source",
        text.char_count(F.col("text")).alias("content_length"),
        text.word_count(F.col("text")).alias("word_count"),
    )


def _staged(spark: SparkSession, sf: str, where: str = "true") -> DataFrame:
    return stage.stage_markdown(bridge.acts(spark, sf).where(where))


def _primary(spark: SparkSession, sf: str) -> DataFrame:
    return _staged(spark, sf, "doc_id % 10 >= 2")


def _secondary(spark: SparkSession, sf: str) -> DataFrame:
    rows = bridge.acts(spark, sf).where("doc_id % 10 < 4")
    return stage.stage_markdown(rows, K.SOURCE_HTML)


def _entries(spark: SparkSession, sf: str) -> DataFrame:
    return readers.explode_index(bridge.index_pages(spark, sf))


def _unclean(spark: SparkSession, sf: str) -> DataFrame:
    """Staged acts as a curated table with stubs and duplicates left in."""
    return reconcile.project(reconcile.add_normalized(_staged(spark, sf)))


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    docs = bridge.table(spark, sf, "documents")
    return docs.join(bridge.table(spark, sf, "labels"), "doc_id", "left")


def _filled_orders(spark: SparkSession, sf: str) -> DataFrame:
    orders = bridge.table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.to_date("o_orderdate")).alias("day")
    )
    items = bridge.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.to_date("l_shipdate").alias("day"),
        "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice",
    )
    order = ["l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
    lookup = reconcile.fill_lookup(items, "o_orderkey", "day", order)
    return reconcile.gap_fill(orders, lookup, "o_orderkey", "day", flag="recovered")


def _joined_samples(results: DataFrame) -> DataFrame:
    return results.withColumn("samples", F.array_join("samples", "; "))


def _rule(spark: SparkSession, sf: str, rule: checks.Rule) -> DataFrame:
    return _joined_samples(checks.run_rules(_unclean(spark, sf), [rule]))


# --- scans, sources, sinks -------------------------------------------------

@query
def scan_parquet_projection(spark, sf):
    docs = bridge.table(spark, sf, "documents")
    return docs.where("lang = 'en' and n_chars > 500").select("doc_id", "source", "n_chars")


@query
def json_tuple_explode(spark, sf):
    return _entries(spark, sf)


@query
def json_field_extract(spark, sf):
    props = F.from_json("props", "k long")
    return bridge.table(spark, sf, "events").select("event_id", props.k.alias("k"))


@query
def pages_manifest_join(spark, sf):
    joined = readers.manifest_pages(bridge.page_manifest(spark, sf), bridge.landed_pages(spark, sf))
    return joined.select(
        "page_id", "slug", F.col("html").isNotNull().alias("found"),
        F.octet_length("html").cast("long").alias("n_bytes"),
    )


def _dated_orders(spark: SparkSession, sf: str) -> DataFrame:
    year = F.when(F.col("o_orderkey") % 20 != 0, F.year("o_orderdate").cast("long"))
    return bridge.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", year.alias("ra_year"))


@query
def partition_stats(spark, sf):
    """What the write says it wrote, beside what its files say when they are read."""
    orders, root = _dated_orders(spark, sf), scratch_path(spark, "partitions")
    stats = writers.write_partitions(orders, root)
    files = writers.read_partitions(spark, root, orders.schema).select(
        "year", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
    each = files.groupBy("file", "size").agg(F.count(F.lit(1)).alias("rows"))
    return each.agg(F.sum("rows").alias("rows_read"), (F.sum("size") == stats.bytes).alias("bytes_match")).select(
        F.lit(stats.n_partitions).cast("long").alias("n_partitions"), F.lit(stats.years_min).cast("long").alias("years_min"),
        F.lit(stats.years_max).cast("long").alias("years_max"), F.lit(stats.rows_written).cast("long").alias("rows_written"),
        F.lit(stats.rows_excluded).cast("long").alias("rows_excluded"), "rows_read", "bytes_match")


@query
def partition_pruned_read(spark, sf):
    orders, root = _dated_orders(spark, sf), scratch_path(spark, "partitions")
    writers.write_partitions(orders, root)
    one = writers.read_partitions(spark, root, orders.schema, values=[1997])
    return one.groupBy("year").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query
def planned_partitions(spark, sf):
    return writers.planned_partitions(_dated_orders(spark, sf))


@query
def csv_roundtrip_hash(spark, sf):
    docs, path = bridge.table(spark, sf, "documents"), scratch_path(spark, "csv")
    writers.write_csv(docs, path)
    back = writers.read_csv(spark, path, docs.columns)
    hashes = writers.text_hashes(back, "doc_id", ["text", "source"])
    return hashes.withColumn("doc_id", F.col("doc_id").cast("long"))


@query
def jsonl_roundtrip(spark, sf):
    rows, path = _labelled(spark, sf), scratch_path(spark, "jsonl")
    writers.write_jsonl(rows, path)
    back = writers.read_jsonl(spark, path, rows.schema)
    return back.select("doc_id", "lang", "n_chars", "quality", F.sha2("text", 256).alias("text_sha256"))


@query
def format_comparison(spark, sf):
    rows = bridge.table(spark, sf, "documents").withColumn("ra_year", 1946 + F.col("doc_id") % 80)
    return writers.compare_formats(rows, scratch_path(spark, "formats"), "ra_year", timings=False)


def _upsert_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    customers = bridge.table(spark, sf, "customer")
    changed = customers.where("c_custkey % 2 = 0 or c_custkey % 3 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    return customers.where("c_custkey % 3 <> 0"), changed


@query
def upsert_merge(spark, sf):
    merged = upsert.upsert(*_upsert_sides(spark, sf), "c_custkey", action="action")
    return merged.withColumn("c_acctbal", F.round("c_acctbal", 2))


@query
def upsert_counts(spark, sf):
    return upsert.upsert_counts(*_upsert_sides(spark, sf), "c_custkey")


@query
def upsert_bucketed(spark, sf):
    """A bucketed table after a merge that touches one customer in ten, and whether the other buckets kept their files."""
    target, _ = _upsert_sides(spark, sf)
    source = bridge.table(spark, sf, "customer").where("c_custkey % 10 = 1").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    root = scratch_path(spark, "buckets")
    buckets.create_buckets(target, root, "c_custkey", 256)
    before = buckets.bucket_folders(spark, root)
    touched = buckets.upsert_buckets(source, root, "c_custkey")
    after = buckets.bucket_folders(spark, root)
    kept = all(after[b] == path for b, path in before.items() if b not in touched)
    rows = buckets.read_buckets(spark, root, target.schema)
    return rows.select("c_custkey", F.round("c_acctbal", 2).alias("c_acctbal"), F.lit(kept).alias("others_kept"))


@query
def full_replace(spark, sf):
    """A table replaced by a plan that reads it; an empty replacement is refused."""
    customers, root = bridge.table(spark, sf, "customer").select("c_custkey", "c_acctbal"), scratch_path(spark, "replaced")
    writers.publish_snapshot(customers.where("c_custkey % 2 = 0"), root)
    old = writers.read_snapshot(spark, root, customers.schema)
    writers.publish_snapshot(old.unionByName(customers.where("c_custkey % 2 = 1")), root)
    try:
        writers.publish_snapshot(old.where("c_custkey < 0"), root)
    except RuntimeError:
        pass
    return writers.read_snapshot(spark, root, customers.schema).select("c_custkey", F.round("c_acctbal", 2).alias("c_acctbal"))


@query
def published_artefacts(spark, sf):
    """Four artefacts published together, seen after a second publish that failed at the third of them."""
    docs = bridge.table(spark, sf, "documents").select("doc_id", "text", (1946 + F.col("doc_id") % 80).alias("ra_year"))
    base = scratch_path(spark, "published")
    roots = {name: f"{base}/{name}" for name in ("curated", "partitions", "csv", "jsonl")}
    first = docs.where("doc_id % 2 = 0")
    writers.publish_set(spark, f"{base}/manifest", writers.write_artefacts(first, roots))
    try:  # CSV can't hold an array
        wrong = docs.withColumn("text", F.array("text"))
        writers.publish_set(spark, f"{base}/manifest", writers.write_artefacts(wrong, roots))
        refused = False
    except AnalysisException:
        refused = True
    snapshots = writers.published_set(spark, f"{base}/manifest")
    told = None
    for name in sorted(roots):
        rows = writers.read_artefact(spark, snapshots, name, first.schema).select(
            F.lit(name).alias("artefact"), F.col("doc_id").cast("long").alias("doc_id"), F.sha2("text", 256).alias("text_sha256"),
            F.lit(refused).alias("refused"))
        told = rows if told is None else told.unionByName(rows)
    return told


@query
def optional_source(spark, sf):
    """Gaps filled from a lookup that is there and from one that is not."""
    orders = bridge.table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.to_date("o_orderdate")).alias("day"))
    items = bridge.table(spark, sf, "lineitem").where("l_linenumber = 1").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min(F.to_date("l_shipdate")).alias("day"))
    path = scratch_path(spark, "lookup")
    items.write.parquet(path)
    told = []
    for origin, place in (("there", path), ("absent", path + "-absent")):
        lookup = readers.read_optional(spark, place, items.schema)
        filled = reconcile.gap_fill(orders, lookup, "o_orderkey", "day", flag="recovered")
        told.append(filled.agg(
            F.lit(origin).alias("lookup"), F.count(F.lit(1)).alias("n_rows"), F.count_if("recovered").alias("recovered"),
            F.count_if(F.col("day").isNull()).alias("nulls_after")))
    return told[0].unionByName(told[1])


@query
def load_prepare(spark, sf):
    ready = upsert.prepare_load(_unclean(spark, sf))
    return ready.select("ra_id", "ra_year", "approval_date", "content_length", "word_count", "source_path")


@query
def landing_pending(spark, sf):
    events = bridge.table(spark, sf, "events")
    landed = events.where("event_id % 3 = 0")
    return landing.pending(events, landed, ["event_id"]).select("event_id", "event_type")


@query
def landing_manifest(spark, sf):
    events = bridge.table(spark, sf, "events").select("event_id", F.expr("event_id div 500").alias("page"))
    listed = events.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("page").alias("pages"))
    landed = events.where("page % 4 <> 3")
    return landing.landing_manifest(
        landed, F.col("page"), listed.select("n").scalar(), listed.select("pages").scalar()
    )


@query
def seeded_sample(spark, sf):
    return landing.seeded_sample(bridge.table(spark, sf, "pages"), "page_id", 40).select("page_id", "url")


# --- staging functions -----------------------------------------------------

@query
def basename_parse(spark, sf):
    name = F.col("basename")
    return bridge.acts(spark, sf).select(
        "doc_id", stage.basename_number(name).alias("ra_number"), stage.basename_year(name).alias("ra_year")
    )


@query
def filter_index_rows(spark, sf):
    return stage.drop_index_rows(bridge.acts(spark, sf)).select("doc_id", "basename")


def _headed(spark: SparkSession, sf: str) -> DataFrame:
    return stage.headed(bridge.acts(spark, sf).select("doc_id", "content"))


@query
def header_extract(spark, sf):
    header = F.col("_header")
    return _headed(spark, sf).select(
        "doc_id", text.header_number(header).alias("number"), text.header_date(header).alias("header_date"),
        F.col("_at").cast("long").alias("line_index"),
    )


@query
def approval_date_extract(spark, sf):
    return _headed(spark, sf).select(
        "doc_id", text.approval_date(F.col("content")).alias("approved_line"),
        F.coalesce(text.approval_date(F.col("content")), text.header_date(F.col("_header"))).alias("approval_date"),
    )


@query
def title_line(spark, sf):
    return _headed(spark, sf).select("doc_id", text.title_line(F.col("_behind"), F.col("_head")).alias("title"))


@query
def body_extract(spark, sf):
    return _headed(spark, sf).select("doc_id", text.clean_markdown(text.strip(F.col("_behind"))).alias("body"))


@query
def clean_markdown(spark, sf):
    return bridge.acts(spark, sf).select("doc_id", text.clean_markdown(F.col("content")).alias("cleaned"))


@query
def clean_markdown_core(spark, sf):
    core = text.strip_bold_links_space(F.col("content"))
    return bridge.acts(spark, sf).select("doc_id", core.alias("cleaned"))


@query
def content_metrics(spark, sf):
    return _documents(spark, sf).select("doc_id", "content_length", "word_count")


def _month_texts(spark: SparkSession, sf: str) -> DataFrame:
    day = "date_add(date'1950-01-01', cast(o_orderkey % 20000 as int))"
    return bridge.table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        f"""case when o_orderkey % 4 = 0 then concat('Sept. ', date_format({day}, 'd, yyyy'))
                 when o_orderkey % 4 = 1 then concat('on ', upper(date_format({day}, 'MMMM d yyyy')))
                 when o_orderkey % 4 = 2 then concat('February ', o_orderkey % 32, ', 2001')
                 else date_format({day}, 'MMMM d, yyyy') end as date_text""",
    )


@query
def parse_month_date(spark, sf):
    return _month_texts(spark, sf).select(
        "o_orderkey", dates.find_month_date(F.col("date_text")).alias("parsed")
    )


def _iso_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with ISO dates, some of them damaged or missing."""
    return bridge.table(spark, sf, "orders").selectExpr(
        "o_orderkey", "concat('RA-', o_orderkey) as ra_id",
        """case when o_orderkey % 11 = 0 then '2015-7-6' when o_orderkey % 13 = 0 then '2015-02-30'
                when o_orderkey % 17 = 0 then 'soon' when o_orderkey % 19 = 0 then null
                else date_format(o_orderdate, 'yyyy-MM-dd') end as approval_date""",
    )


@query
def parse_dates_coerce(spark, sf):
    return temporal.with_parsed_date(_iso_texts(spark, sf)).select("o_orderkey", "approval_date_dt")


@query
def year_from_date(spark, sf):
    return _iso_texts(spark, sf).select(
        "o_orderkey", dates.year_prefix(F.col("approval_date")).alias("year")
    )


@query
def stage_markdown(spark, sf):
    return _staged(spark, sf)


@query
def stage_index(spark, sf):
    return stage.stage_index(_entries(spark, sf))


@query
def stage_html(spark, sf):
    return stage.stage_html(
        bridge.page_manifest(spark, sf), bridge.landed_pages(spark, sf), container="article"
    )


@query
def normalize_content(spark, sf):
    return bridge.acts(spark, sf).select(
        "doc_id", text.normalize_content(F.col("content")).alias("content_normalized")
    )


@query
def label_filter(spark, sf):
    entries = readers.well_formed(_entries(spark, sf))
    number = anchors.label_number(F.col("title")).alias("ra_number")
    return entries.select("page", "pos", number).where("ra_number is not null")


@query
def anchor_title(spark, sf):
    entries = readers.well_formed(_entries(spark, sf))
    title = anchors.descriptive_title(F.col("anchor"), F.col("title"))
    return entries.select("page", "pos", title.alias("title"))


@query
def anchor_path(spark, sf):
    entries = readers.well_formed(_entries(spark, sf))
    return entries.select("page", "pos", anchors.anchor_path(F.col("anchor")).alias("source_path"))


@query
def path_prefix_filter(spark, sf):
    manifest = bridge.page_manifest(spark, sf)
    return manifest.where(~stage.is_rule_document(F.col("source_path"))).select("page_id", "source_path")


@query
def html_title(spark, sf):
    title = stage.html_title_text(F.col("html"))
    return bridge.table(spark, sf, "pages").select(
        "page_id", title.alias("page_title"), stage.html_number(title).alias("ra_number")
    )


@query
def html_meta_title(spark, sf):
    parsed = html.parse_pages(bridge.table(spark, sf, "pages").select("page_id", "html"), container="article")
    return parsed.select(
        "page_id", "page_title",
        stage.html_display_title(F.col("description"), F.col("bolds")).alias("title"),
    )


@query
def html_paragraphs(spark, sf):
    parsed = html.parse_pages(bridge.table(spark, sf, "pages").select("page_id", "html"), container="article")
    kept = parsed.select("page_id", F.posexplode(stage.keep_paragraphs(F.col("paragraphs"))).alias("pos", "paragraph"))
    return kept


@query
def link_extract(spark, sf):
    found = F.regexp_extract_all("html", F.lit(r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']"""), F.lit(1))
    rows = bridge.table(spark, sf, "pages").select("page_id", "url", F.posexplode(found).alias("pos", "href"))
    href = anchors.clean_href(F.col("href"))
    return rows.select("page_id", "pos", href.alias("source_path"), anchors.resolve_url(F.col("url"), href).alias("url"))


@query
def index_table_links(spark, sf):
    return html.parse_index(bridge.index_tables(spark, sf))


# --- reconcile -------------------------------------------------------------

@query
def drop_stubs(spark, sf):
    return reconcile.drop_stubs(_documents(spark, sf)).select("doc_id", "word_count")


@query
def drop_empty_text(spark, sf):
    docs = bridge.acts(spark, sf).select("doc_id", F.col("content").alias("content_normalized"))
    return reconcile.drop_empty(docs).select("doc_id")


def _keyed_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents keyed by the digest of their text: the texts stay behind."""
    docs = bridge.table(spark, sf, "documents")
    return docs.select("doc_id", "lang", "source", F.sha2("text", 256).alias("text_key"))


@query
def dedupe_first(spark, sf):
    return reconcile.keep_first(_keyed_texts(spark, sf), ["text_key"], ["doc_id"]).drop("text_key")


@query
def duplicate_groups(spark, sf):
    return reconcile.duplicate_rows(_keyed_texts(spark, sf), ["text_key"]).select("doc_id")


@query
def duplicate_dropped(spark, sf):
    return reconcile.later_duplicates(_keyed_texts(spark, sf), ["text_key"], ["doc_id"]).select("doc_id")


@query
def exclude_ids(spark, sf):
    listed = ("src3", "src7", "no-such-source")
    docs = bridge.table(spark, sf, "documents")
    return tfidf.exclude_ids(docs, listed, "source").select("doc_id", "source")


@query
def absent_ids(spark, sf):
    return tfidf.absent_ids(bridge.table(spark, sf, "documents"), ("src3", "src7", "no-such-source"), "source")


@query
def oversized_rows(spark, sf):
    docs = _documents(spark, sf)
    return reconcile.oversized(docs, 3000, "doc_id").select("doc_id", "content_length")


@query
def merge_primary_secondary(spark, sf):
    merged = reconcile.append_missing(_primary(spark, sf), _secondary(spark, sf))
    return merged.select("ra_id", "ra_year", "source", "source_path")


@query
def source_overlap(spark, sf):
    return reconcile.overlap(_primary(spark, sf), _secondary(spark, sf))


@query
def row_reconciliation(spark, sf):
    return reconcile.reconcile_counts(_primary(spark, sf), _secondary(spark, sf))


@query
def curated_projection(spark, sf):
    staged = corpus.store_staged(spark, numbered=True, primary=_primary(spark, sf), secondary=_secondary(spark, sf))
    index = stage.stage_index(_entries(spark, sf)).select("ra_number", "approval_date", "source_path")  # all that fills gaps
    lookup = corpus.store_staged(spark, lookup=index)["lookup"]
    return corpus.curate(staged["primary"], staged["secondary"], lookup)


@query
def curated_summary(spark, sf):
    return profile.curated_summary(_staged(spark, sf))


@query
def source_distribution(spark, sf):
    return profile.source_distribution(bridge.table(spark, sf, "documents"))


@query
def gap_fill_date(spark, sf):
    return _filled_orders(spark, sf)


@query
def gap_fill_audit(spark, sf):
    return reconcile.gap_fill_audit(_filled_orders(spark, sf), "day")


@query
def weekday_share_by_origin(spark, sf):
    origin = F.when(F.col("recovered"), "recovered").otherwise("original")
    return temporal.weekday_share(_filled_orders(spark, sf), F.col("day"), origin)


# --- contract checks -------------------------------------------------------

def _drifted(spark: SparkSession, sf: str) -> DataFrame:
    """Acts in a schema that departs from the contract."""
    return bridge.acts(spark, sf).select(
        F.col("path").alias("source_path"), F.col("yr").cast("int").alias("ra_year"),
        F.when(F.col("doc_id") % 3 != 0, F.col("basename")).alias("basename"),
    )


@query
def check_schema(spark, sf):
    return _joined_samples(checks.check_schema(_drifted(spark, sf), Contract.parse()))


@query
def schema_report(spark, sf):
    return checks.schema_report(_drifted(spark, sf), Contract.parse())


@query
def check_unique(spark, sf):
    return _rule(spark, sf, checks.unique_rule(["ra_id"]))


@query
def check_unique_composite(spark, sf):
    return _rule(spark, sf, checks.unique_rule(["ra_number", "ra_year"], "ra_number_year_unique"))


@query
def check_required_non_null(spark, sf):
    rows = _labelled(spark, sf)
    rule = checks.required_rule(["doc_id", "text", "quality", "toxic", "missing_one"], rows.columns)
    return _joined_samples(checks.run_rules(rows, [rule]))


@query
def check_year_range(spark, sf):
    return _rule(spark, sf, checks.year_rule(1950, 2020))


@query
def check_content_non_stub(spark, sf):
    return _rule(spark, sf, checks.stub_rule(K.MIN_CONTENT_LENGTH, 200))


@query
def check_non_empty(spark, sf):
    return _rule(spark, sf, checks.non_empty_rule())


@query
def check_pattern(spark, sf):
    return _rule(spark, sf, checks.pattern_rule(r"^[1-9]\d{0,1}$"))


@query
def check_date_valid(spark, sf):
    return _joined_samples(checks.run_rules(_iso_texts(spark, sf), [checks.date_rule()]))


@query
def check_source_distribution(spark, sf):
    return _joined_samples(checks.run_rules(bridge.table(spark, sf, "documents"), [checks.source_rule()]))


@query
def check_oversized(spark, sf):
    return _rule(spark, sf, checks.oversized_rule(5000))


@query
def check_constraints(spark, sf):
    return _joined_samples(checks.run_rules(_unclean(spark, sf), checks.table_constraints()))


@query
def check_null_rate(spark, sf):
    return _joined_samples(checks.check_null_rate(_unclean(spark, sf), "approval_date", 0.005))


@query
def check_row_band(spark, sf):
    return _joined_samples(checks.check_row_band(bridge.table(spark, sf, "documents"), 11_000, 13_000))


@query
def validation_report(spark, sf):
    return _joined_samples(checks.run_all(_unclean(spark, sf), today=TODAY))


@query
def validation_summary(spark, sf):
    return checks.summarize(checks.run_all(_unclean(spark, sf), today=TODAY))


def year_not_there(df: DataFrame) -> DataFrame:
    """A custom check that fails while it runs, in Spark."""
    bad = F.when(F.col("ra_year") > 0, F.raise_error(F.lit("no such year")).cast("int"))
    return df.agg(F.sum(bad).alias("n")).select(
        F.lit("never").alias("check_name"), F.lit("error").alias("severity"), F.lit("pass").alias("status"),
        F.col("n").cast("string").alias("message"), F.lit(0).cast("long").alias("violations"), F.array().cast("array<string>").alias("samples"))


def broken_udf(df: DataFrame) -> DataFrame:
    """A custom check that fails while it runs, in Python."""
    @F.pandas_udf("long")
    def fails(column: pd.Series) -> pd.Series:
        raise ValueError("not a year")

    return year_not_there(df.where(fails("ra_year") > 0))


def few_nulls(df: DataFrame) -> DataFrame:
    return checks.check_null_rate(df, "title", 0.005)


@query
def validation_isolated(spark, sf):
    """The report with three custom checks, of which two fail while they run."""
    rows = stored(_unclean(spark, sf), "unclean")
    return _joined_samples(checks.run_all(rows, today=TODAY, extra=[year_not_there, few_nulls, broken_udf]))


@query
def contract_rules(spark, sf):
    """What the contract says of each rule, beside its verdict on the data."""
    contract = Contract.parse()
    listed = spark.createDataFrame(
        [(at, name, rule.severity, json.dumps(rule.params, sort_keys=True)) for at, (name, rule) in enumerate(contract.rules.items(), 1)],
        "rule_id int, check_name string, declared string, params string")
    low, high = contract.years(TODAY)
    told = checks.run_all(_unclean(spark, sf), contract, TODAY).select("check_name", "status", "violations")
    return listed.join(told, "check_name").select(
        "*", F.lit(contract.revision).alias("revision"), F.lit(len(contract.required())).alias("n_required"),
        F.lit(low).alias("year_low"), F.lit(high).alias("year_high"))


# --- profiles --------------------------------------------------------------

@query
def column_profile(spark, sf):
    return profile.column_profile(_labelled(spark, sf), ["doc_id"])


@query
def null_issues(spark, sf):
    return profile.null_issues(profile.column_profile(_labelled(spark, sf), ["doc_id"]))


def _rounded(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query
def numeric_summary(spark, sf):
    events = bridge.table(spark, sf, "events").select("value", F.from_json("props", "k string").k.alias("k"))
    return _rounded(profile.numeric_summary(events, ["value", "k"]), ["p25", "median", "mean", "p75"])


@query
def duplicate_content_count(spark, sf):
    return profile.duplicate_values(bridge.table(spark, sf, "documents"), "text")


@query
def regex_count_profile(spark, sf):
    acts = bridge.acts(spark, sf)
    return profile.pattern_counts(acts, {
        "index_basename_rows": stage.is_index_row(F.col("basename")),
        "header_rows": F.col("content").rlike("(?i)republic act"),
        "approved_rows": F.col("content").rlike(K.APPROVED_LINE),
    })


@query
def json_index_profile(spark, sf):
    return profile.json_index_profile(
        _entries(spark, sf), anchors.label_number(F.col("title")), F.col("date_text"),
        text.none_if_empty(F.regexp_extract("anchor", K.ANCHOR_DOC_ID, 1)),
    )


@query
def page_set_profile(spark, sf):
    joined = readers.manifest_pages(bridge.page_manifest(spark, sf), bridge.landed_pages(spark, sf))
    return profile.page_set_profile(joined)


@query
def staging_profile(spark, sf):
    return profile.staging_profile(stored(_staged(spark, sf), "staged"), ["source_path"])


# --- calendar --------------------------------------------------------------

@query
def count_by_year(spark, sf):
    return temporal.count_by_year(bridge.table(spark, sf, "orders"), F.col("o_orderdate"))


@query
def count_by_month(spark, sf):
    return temporal.count_by_month(bridge.table(spark, sf, "orders"), F.col("o_orderdate"))


@query
def count_by_weekday(spark, sf):
    return temporal.count_by_weekday(bridge.table(spark, sf, "orders"), F.col("o_orderdate"))


# --- term statistics and search --------------------------------------------

def _texts(spark: SparkSession, sf: str) -> DataFrame:
    return bridge.spread(bridge.table(spark, sf, "documents").select("doc_id", "lang", "text"))


def _vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return tfidf.vocabulary(_texts(spark, sf), "text", stop_words=STOP_WORDS)


def _weights(spark: SparkSession, sf: str) -> DataFrame:
    return tfidf.tfidf_weights(_texts(spark, sf), "doc_id", "text", _vocabulary(spark, sf), STOP_WORDS)


def _stored_weights(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Vocabulary and weights, each computed once and read back."""
    vocab = corpus.store_staged(spark, vocabulary=_vocabulary(spark, sf))["vocabulary"]
    weights = tfidf.tfidf_weights(_texts(spark, sf), "doc_id", "text", vocab, STOP_WORDS)
    return vocab, corpus.store_staged(spark, weights=weights)["weights"]


@query
def tokenize_terms(spark, sf):
    return tfidf.term_counts(_texts(spark, sf), "doc_id", "text", STOP_WORDS)


@query
def term_doc_freq(spark, sf):
    return tfidf.term_doc_freq(_texts(spark, sf), "text")


@query
def vocabulary_select(spark, sf):
    return _rounded(_vocabulary(spark, sf), ["idf"])


@query
def tfidf_weights(spark, sf):
    return _rounded(_weights(spark, sf), ["weight"])


@query
def tfidf_matrix_stats(spark, sf):
    vocab, weights = _stored_weights(spark, sf)
    return tfidf.matrix_stats(weights, bridge.table(spark, sf, "documents"), vocab)


@query
def text_search_and(spark, sf):
    path = scratch_path(spark, "index")
    n = bridge.table(spark, sf, "documents").agg(F.count(F.lit(1)).alias("n"))
    search.write_index(search.inverted_index(_texts(spark, sf), "doc_id", "text"), path, "doc_id", n.first().n)
    return search.search_all(spark.read.parquet(path), list(SEARCH_WORDS), "doc_id", n)


# --- clusters --------------------------------------------------------------

def _embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return bridge.table(spark, sf, "embeddings")


def _lang_clusters(spark: SparkSession, sf: str) -> DataFrame:
    code = F.expr("case lang when 'de' then 0 when 'en' then 1 when 'es' then 2 when 'fr' then 3 else 20 end")
    return bridge.table(spark, sf, "documents").select(
        "doc_id", code.alias("cluster"), (1946 + F.col("doc_id") % 80).alias("ra_year")
    )


@query
def cluster_top_terms(spark, sf):
    _, weights = _stored_weights(spark, sf)
    centers = cluster.term_centroids(weights, _lang_clusters(spark, sf), "doc_id", "cluster")
    return _rounded(cluster.top_terms(centers, "cluster"), ["weight"])


@query
def cluster_summary(spark, sf):
    return cluster.cluster_summary(_lang_clusters(spark, sf), "cluster")


@query
def cluster_theme_report(spark, sf):
    _, weights = _stored_weights(spark, sf)
    assigned = _lang_clusters(spark, sf)
    centers = cluster.term_centroids(weights, assigned, "doc_id", "cluster")
    centers = corpus.store_staged(spark, centers=centers)["centers"]
    distances = cluster.term_distances(weights, assigned, centers, "doc_id", "cluster")
    return cluster.theme_report(
        cluster.cluster_summary(assigned, "cluster"), cluster.top_terms(centers, "cluster"),
        cluster.representatives(distances, "cluster", "doc_id"), "cluster",
        bridge.table(spark, sf, "documents").withColumn("ra_year", 1946 + F.col("doc_id") % 80), "doc_id", "text",
        themes={0: "German prose", 1: "English prose", 3: "French prose"},
    )


@query
def cluster_scatter_join(spark, sf):
    """Points with the texts of their documents; their place must lie within their vector's length."""
    vectors = _embeddings(spark, sf).select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    placed = kmeans.project_svd(_points(spark, sf), "vec_id")
    points = vectors.join(placed, "vec_id").select(F.col("vec_id").alias("doc_id"), F.col("label").alias("cluster"), "x", "y", "v")
    docs = bridge.table(spark, sf, "documents").select(
        "doc_id", F.col("text").alias("title"), (1946 + F.col("doc_id") % 80).alias("ra_year")
    )
    length = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x * x)
    within = F.col("x") * F.col("x") + F.col("y") * F.col("y") <= length * (1 + 1e-9)
    return cluster.scatter_join(points, docs, "doc_id").select(
        "doc_id", "cluster", "title_short", "year_str", within.alias("within_length"))


@query
def cluster_sizes(spark, sf):
    return cluster.cluster_sizes(_embeddings(spark, sf), "label")


@query
def centroid_distance(spark, sf):
    rows = cluster.centroid_distances(_embeddings(spark, sf), "embedding", "label")
    return rows.select("vec_id", "label", F.round("distance2", 6).alias("distance2"))


@query
def cluster_representatives(spark, sf):
    rows = cluster.centroid_distances(_embeddings(spark, sf), "embedding", "label")
    return cluster.representatives(rows, "label", "vec_id").select("label", "rank", "vec_id")


@query
def cluster_inertia(spark, sf):
    return _rounded(cluster.inertia(_embeddings(spark, sf), "embedding", "label"), ["inertia"])


@query
def silhouette_exact(spark, sf):
    return _rounded(cluster.silhouette_exact(_embeddings(spark, sf), "vec_id", "embedding", "label"), ["silhouette"])


SWEEP_KS = range(2, 11)


def _label_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """A sweep over given groupings: labels merged modulo k, for k = 2..10."""
    points = _embeddings(spark, sf)
    group = F.explode(F.array(*[F.lit(k) for k in SWEEP_KS])).alias("k")
    each = points.select("vec_id", "embedding", "label", group).withColumn(
        "cluster", F.concat_ws("/", "k", F.col("label") % F.col("k"))
    )
    spread = cluster.centroid_distances(each, "embedding", "cluster").groupBy("k").agg(
        F.round(F.sum("distance2"), 6).alias("inertia")
    )
    sample = landing.seeded_sample(points, "vec_id", K.SILHOUETTE_SAMPLE).select(
        "vec_id", "embedding", *[(F.col("label") % k).alias(str(k)) for k in SWEEP_KS])
    scores = cluster.silhouettes(sample, "vec_id", "embedding", [str(k) for k in SWEEP_KS]).withColumn("k", F.col("labels").cast("int"))
    return spread.join(scores, "k").select("k", "inertia", F.round("silhouette", 6).alias("silhouette"))


@query
def label_sweep(spark, sf):
    return _label_sweep(spark, sf)


@query
def elbow_k(spark, sf):
    return cluster.elbow(_label_sweep(spark, sf))


@query
def select_k(spark, sf):
    return _rounded(cluster.select_k(_label_sweep(spark, sf)), ["silhouette_margin"])


# --- fitted models -----------------------------------------------------------
# Start centres and signs are a fit's own, so the queries state what must hold for any fit, measured on all rows.

def _points(spark: SparkSession, sf: str) -> DataFrame:
    vector = array_to_vector(F.col("embedding").cast("array<double>"))
    return _embeddings(spark, sf).select("vec_id", vector.alias("features"))


@query
def kmeans_assign(spark, sf):
    points = kmeans.fixed_layout(_points(spark, sf), "vec_id").persist()
    try:
        model = kmeans.fit_best(points, 10)
        return stored(kmeans.nearest(points, model, "vec_id").select("vec_id", "is_nearest"), "assigned")
    finally:
        points.unpersist()


@query
def k_sweep(spark, sf):
    points = kmeans.fixed_layout(_points(spark, sf), "vec_id").persist()
    try:
        models = kmeans.fit_sweep(points)
        return stored(kmeans.certificate(points, models, "vec_id", kmeans.score_sweep(points, "vec_id", models)), "certificate")
    finally:
        points.unpersist()


@query
def cluster_metrics(spark, sf):
    """The record of a whole run over TF-IDF rows: sweep, choice, final fit."""
    vectors, points = _term_points(spark, sf)
    points = kmeans.fixed_layout(points, "doc_id").persist()
    try:
        sweep = kmeans.sweep_k(points, "doc_id")
        choice = cluster.select_k(sweep)
        k = choice.first()["k_final"]
        model = kmeans.fit_best(points, k)
        score = kmeans.sample_silhouette(points, "doc_id", model)
        metrics = kmeans.run_metrics(
            sweep, choice, model.summary.trainingCost, score, len(vectors.terms), points.count(),
            {"k_min": K.K_MIN, "k_max": K.K_MAX, "n_init": K.N_INIT, "seed": K.SEED, "min_df": K.MIN_DF, "max_df": K.MAX_DF,
             "max_features": K.MAX_FEATURES},
        )
    finally:
        points.unpersist()
    curve = F.from_json("sweep", "array<struct<k:int,inertia:double,silhouette:double>>")
    chosen = F.element_at(F.filter(curve, lambda p: p["k"] == F.col("k_final")), 1)
    return metrics.select(
        "n_docs_fit", "vocabulary_size", "parameters", F.size(curve).alias("n_swept"), F.lit(K.K_FLOOR).alias("k_floor"),
        F.col("k_final").between(K.K_FLOOR, K.K_MAX).alias("k_in_range"),
        (F.abs(F.col("final_inertia") - chosen["inertia"]) <= 1e-6 * chosen["inertia"]).alias("final_fit_agrees"),
        F.col("final_silhouette").between(-1.0, 1.0).alias("silhouette_valid"))


def _term_points(spark: SparkSession, sf: str) -> tuple[tfidf.TfidfVectors, DataFrame]:
    """The vectorizer and the stored TF-IDF rows ``doc_id, features``."""
    docs = _texts(spark, sf)
    vectors = tfidf.fit_vectors(docs, "text", stop_words=STOP_WORDS)
    points = vectors.transform(docs).select("doc_id", "features")
    return vectors, corpus.store_staged(spark, vectors=points)["vectors"]


@query
def svd_project(spark, sf):
    return kmeans.projection_certificate(_term_points(spark, sf)[1], "doc_id")


@query
def svd_explained(spark, sf):
    """The share of variance from the singular values, beside the one measured on the projected rows."""
    points = _term_points(spark, sf)[1]
    return kmeans.explained_certificate(points, "doc_id")

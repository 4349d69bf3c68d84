"""Sources, sinks and staging of small files."""

import json
import os
import re

import pytest
from pyspark.sql import functions as F, types as T

from foliospark import constants as K
from foliospark.functions import html
from foliospark.operators import stage
from foliospark.sources import buckets, landing, readers, writers


def test_optional_source(spark, tmp_path):
    schema = T.StructType([T.StructField("ra_number", T.StringType())])
    empty = readers.read_optional(spark, str(tmp_path / "absent"), schema)
    assert empty.columns == ["ra_number"] and empty.count() == 0
    spark.createDataFrame([("1",)], schema).write.parquet(str(tmp_path / "there"))
    assert readers.read_optional(spark, str(tmp_path / "there"), schema).count() == 1


def test_json_index(spark, tmp_path):
    host = K.INDEX_HOST

    def entry(number, day, doc, title="An act about something long"):
        return [f"REPUBLIC ACT NO. {number}", day, f"<a href='https://{host}/thebookshelf/showdocs/2/{doc}'>{title}</a>"]

    (tmp_path / "page_0002.json").write_text(json.dumps({"data": [entry(5, "2001-01-02", 9)], "recordsTotal": 3}))
    (tmp_path / "page_0001.json").write_text(json.dumps({"data": [
        entry(5, "1999-01-02", 1), "bare", ["REPUBLIC ACT NO. 6", "x"], entry(7, "", 2, "tiny"),
        ["IRR of REPUBLIC ACT NO. 5", "2000-01-01", "<a>"], entry(8, None, 3), {"a": 1}, [],
    ]}))
    entries = readers.explode_index(readers.read_json_index(spark, str(tmp_path)))
    sizes = [r.entry_size for r in entries.orderBy("page", "pos").collect()]
    assert sizes == [3, -1, 2, 3, 3, 3, -1, 0, 3]
    rows = {r.ra_id: r for r in stage.stage_index(entries).collect()}
    assert set(rows) == {"RA-5", "RA-7", "RA-8"}
    assert rows["RA-5"].approval_date == "1999-01-02" and rows["RA-5"].ra_year == 1999
    assert rows["RA-5"].source_path == "thebookshelf/showdocs/2/1"
    assert rows["RA-7"].title == "REPUBLIC ACT NO. 7" and rows["RA-7"].approval_date is None
    assert rows["RA-8"].ra_year is None
    assert list(stage.stage_index(entries).columns) == list(K.STAGED_COLUMNS)


def test_index_entries_are_decoded_once(spark):
    """Filters on what is read off an entry do not decode it again: one parse of the page, one of the entry."""
    pages = spark.createDataFrame([("p", '{"data":[["REPUBLIC ACT NO. 1","","x"]]}')], "page string, payload string").repartition(2)
    plan = stage.stage_index(readers.explode_index(pages))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 2


def test_markdown_staging(spark):
    rows = [
        ("ra1946", "index page", "p/0"), (None, "**Republic Act No. 12** May 1, 1950\nA title of good length\nbody", "p/1"),
        ("ra_10_1946", "**Republic Act No. 11**\nshort", "p/2"), ("irr_5", "nothing", "p/3"),
        ("RA_10960A_2015", "Approved: July 16, 2015", "p/4"), ("notes", "Republic Act No. 3\nno year", "p/5"),
    ]
    df = stage.stage_markdown(spark.createDataFrame(rows, "basename string, content string, path string"))
    got = {r.ra_id: r for r in df.collect()}
    assert set(got) == {"RA-12", "RA-10", "RA-10960A"}
    assert got["RA-12"].ra_year == 1950 and got["RA-12"].approval_date == "1950-05-01"
    assert got["RA-10"].title == "Republic Act No. 10" and got["RA-10"].word_count == 1
    assert got["RA-10960A"].approval_date == "2015-07-16"


PAGE = """<html><head><title>Republic Act No. 116</title>
<meta name="description" content="Republic Acts - AN ACT NAMING A SCHOOL"></head><body><p>outside</p>
<blockquote><p><b>REPUBLIC ACT No. 116</b></p><p>AN ACT &amp; MORE<p>Be it enacted by the Senate:</p>
<dir>Nested <p>inner   text</p></dir><script>x()</script><p>Last <b>bold words that are long</b> one.</p>
</blockquote><blockquote><p>second</p></blockquote></body></html>"""


def test_html_staging(spark):
    manifest = spark.createDataFrame([
        ("l", "u", "June 14, 1956", "Listed", "ra1956/ra_116_1956.html"),
        ("l", "u", "June 15, 1956", "Listed two", "ra1956/ra_117a_1956.html"),
        ("l", "u", "", "IRR", "x/IRR_1_2000.html"), ("l", "u", "", "gone", "x/ra_9_2000.html"),
        ("l", "u", "no date", "none", "x/other.html"),
    ], readers.MANIFEST)
    pages = spark.createDataFrame([
        ("ra1956__ra_116_1956.html", PAGE), ("ra1956__ra_117a_1956.html", "<p>no container</p>"),
        ("x__IRR_1_2000.html", PAGE), ("x__other.html", "<title>Other</title>"),
    ], "slug string, html string")
    got = {r.ra_id: r for r in stage.stage_html(manifest, pages).collect()}
    assert set(got) == {"RA-116", "RA-117a"}
    first = got["RA-116"]
    assert first.title == "AN ACT NAMING A SCHOOL" and first.ra_year == 1956 and first.approval_date == "1956-06-14"
    assert first.content_clean == "AN ACT & MORE\n\nNested inner text\n\ninner text\n\nLast bold words that are long one."
    assert got["RA-117a"].title == "Listed two" and got["RA-117a"].content_clean == ""


def test_html_bold_title(spark):
    page = "<blockquote><b>Republic Act No. 5</b><p><b>tiny</b><b>A bold title that counts</b></p></blockquote>"
    parsed = html.parse_pages(spark.createDataFrame([(1, page)], "id int, html string"))
    title = parsed.select(stage.html_display_title(F.col("description"), F.col("bolds")).alias("t")).first().t
    assert title == "A bold title that counts"


INDEX = """<table id="other"><tr class="xy"><td><a href="no">n</a></td><td>x</td></tr></table>
<table id="s-menu"><tr><td>head</td><td>h</td></tr>
<tr class="xy"><td><a href="ra2024/ra_1_2024.html'"> RA <b>1</b></a><br>June 14, 2024</td><td>Title <i>one</i></td></tr>
<tr class="a xy"><td>no link</td><td>t</td></tr><tr class="xy"><td><a href="z">only</a></td></tr>
<tr class="xy"><td><a href="/abs.html">RA 2</a></td><td>Two</td></tr></table>"""


def test_index_table(spark):
    pages = spark.createDataFrame([("https://h.org/acts/index.html", INDEX)], "url string, html string")
    rows = [tuple(r) for r in html.parse_index(pages).collect()]
    assert rows == [
        ("RA 1", "https://h.org/acts/ra2024/ra_1_2024.html", "June 14, 2024", "Title one", "ra2024/ra_1_2024.html"),
        ("RA 2", "https://h.org/abs.html", "", "Two", "/abs.html"),
    ]
    bare = spark.createDataFrame([("https://h.org/", "<p>none</p>")], "url string, html string")
    with pytest.raises(Exception, match="no table with id"):
        html.parse_index(bare).collect()
    assert html.parse_index(bare, missing="skip").count() == 0


def test_html_files_and_manifest(spark, tmp_path):
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "a__b c.html").write_text("<p>1\n2</p>")
    (tmp_path / "m.json").write_text(json.dumps([{"ra_label": "x", "source_path": "a/b c.html"}]))
    joined = readers.manifest_pages(
        readers.read_manifest(spark, str(tmp_path / "m.json")), readers.read_html_files(spark, str(tmp_path / "pages"))
    )
    assert joined.first().html == "<p>1\n2</p>"


def test_snapshot_replace(spark, tmp_path):
    root = str(tmp_path / "table")
    one = spark.range(3).toDF("id")
    writers.publish_snapshot(one, root)
    read = writers.read_snapshot(spark, root, one.schema)
    # The plan reads the table it replaces.
    writers.publish_snapshot(read.union(read), root)
    assert writers.read_snapshot(spark, root, one.schema).count() == 6
    before = writers.current_snapshot(spark, root)
    with pytest.raises(RuntimeError, match="empty"):
        writers.publish_snapshot(one.where("id > 9"), root)
    broken = one.select(F.assert_true(F.col("id") < 2).cast("string").alias("x"), "id")
    with pytest.raises(Exception):
        writers.publish_snapshot(broken, root)
    assert writers.current_snapshot(spark, root) == before
    assert not [n for n in os.listdir(root) if n.endswith(".part")]
    with pytest.raises(FileNotFoundError):
        writers.read_snapshot(spark, str(tmp_path / "none"), one.schema)


def test_partitions(spark, tmp_path):
    root = str(tmp_path / "parts")
    df = spark.createDataFrame([(1, 2000), (2, 2000), (3, 2001), (4, None)], "id int, ra_year long")
    stats = writers.write_partitions(df, root)
    size = sum(f.stat().st_size for f in (tmp_path / "parts").rglob("*.parquet"))
    assert stats == writers.PartitionStats(2, 2000, 2001, 3, 1, size)
    assert sorted(n for n in os.listdir(root) if n.startswith("year=")) == ["year=2000", "year=2001"]
    writers.write_partitions(df.where("id = 3").withColumn("id", F.lit(9)), root, incremental=True)
    back = writers.read_partitions(spark, root, df.schema)
    assert sorted(r.id for r in back.collect()) == [1, 2, 9]
    writers.write_partitions(df.where("ra_year = 2000"), root)
    assert [n for n in os.listdir(root) if n.startswith("year=")] == ["year=2000"]
    one = writers.read_partitions(spark, root, df.schema, values=[2000])
    assert re.search(r"PartitionFilters: \[[^\]]*year#", one._jdf.queryExecution().toString())
    writers.require_outputs(spark, [root])
    with pytest.raises(RuntimeError, match="missing outputs"):
        writers.require_outputs(spark, [root, str(tmp_path / "gone")])


def test_text_round_trips(spark, tmp_path):
    rows = [("1", 'q"uote, comma'), ("2", "line\nbreak\r\n x "), ("3", ""), ("4", None), ("5", "\\n \\\" é")]
    df = spark.createDataFrame(rows, "id string, text string")
    writers.write_csv(df, str(tmp_path / "c"))
    back = {r.id: r.text for r in writers.read_csv(spark, str(tmp_path / "c"), df.columns).collect()}
    assert back == {k: (v or None) for k, v in rows}
    writers.write_jsonl(df, str(tmp_path / "j"))
    assert {r.id: r.text for r in writers.read_jsonl(spark, str(tmp_path / "j"), df.schema).collect()} == dict(rows)


def test_partition_stats_of_nothing(spark, tmp_path):
    df = spark.createDataFrame([(4, None)], "id int, ra_year long")
    assert writers.write_partitions(df, str(tmp_path / "p")) == writers.PartitionStats(0, None, None, 0, 1, 0)


def test_csv_is_read_by_many_tasks(spark, tmp_path):
    """One year of data, written by one task, with line ends in its fields."""
    df = spark.range(0, 3000, 1, 1).select("id", F.lit(2000).alias("ra_year"), F.repeat(F.lit("a line\nand more "), 20).alias("text"))
    writers.write_csv(df, str(tmp_path / "c"), file_bytes=200_000)
    files = list((tmp_path / "c").glob("*.csv"))
    assert 4 <= len(files) <= 8 and max(f.stat().st_size for f in files) < 400_000
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300k")
        back = writers.read_csv(spark, str(tmp_path / "c"), df.columns)
        assert back.select(F.spark_partition_id().alias("p")).distinct().count() > 1 and back.count() == 3000
        assert back.select("text").distinct().count() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_bucketed_upsert(spark, tmp_path):
    root = str(tmp_path / "t")
    schema = "id long, v string"
    buckets.create_buckets(spark.createDataFrame([(i, "old") for i in range(500)] + [(None, "none")], schema), root, "id", 32)
    files = lambda: {f: f.stat().st_mtime_ns for f in tmp_path.rglob("*.parquet")}
    before, folders = files(), buckets.bucket_folders(spark, root)
    batch = spark.createDataFrame([(3, "new"), (900, "new")], schema)
    touched = buckets.upsert_buckets(batch, root, "id")
    after = buckets.bucket_folders(spark, root)
    assert 1 <= len(touched) <= 2 and all(after[b] == folders[b] for b in folders if b not in touched)
    assert {f: files()[f] for f in before} == before  # nothing is overwritten in place
    rows = sorted((r.id is None, r.id, r.v) for r in buckets.read_buckets(spark, root, batch.schema).collect())
    want = sorted([(False, i, "new" if i == 3 else "old") for i in range(500)] + [(False, 900, "new"), (True, None, "none")], key=str)
    assert sorted(rows, key=str) == want
    buckets.upsert_buckets(batch, root, "id")
    assert buckets.read_buckets(spark, root, batch.schema).count() == 502
    assert buckets.upsert_buckets(batch.where("id < 0"), root, "id") == []
    with pytest.raises(ValueError, match="bucketed by id"):
        buckets.upsert_buckets(batch, root, "v")
    with pytest.raises(Exception, match="duplicate source key"):
        buckets.upsert_buckets(batch.union(batch), root, "id")
    assert buckets.read_buckets(spark, root, batch.schema).count() == 502
    fresh = str(tmp_path / "fresh")
    assert len(buckets.upsert_buckets(batch, fresh, "id", 8)) <= 2 and buckets.read_buckets(spark, fresh, batch.schema).count() == 2


def test_format_comparison(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 2000), (2, "b", 2001)], "id int, text string, ra_year long")
    rows = writers.compare_formats(df, str(tmp_path / "f"), "ra_year").collect()
    assert [r.format for r in rows] == ["parquet_single", "parquet_partitioned", "csv", "json_lines"]
    assert all(r.rows == 2 and r.columns_match and r.rows_match and r.size_bytes > 0 for r in rows)


def test_landing(spark):
    listing = spark.range(10).toDF("id")
    landed = listing.where("id < 6").withColumn("page", F.expr("id div 3"))
    assert landing.pending(listing, landed, ["id"]).count() == 4
    done = landing.landing_manifest(landed, F.col("page"), F.lit(6), F.lit(2))
    assert tuple(done.first()) == (2, 6, 6, True, False)
    assert landing.skip_if_complete(done, listing).count() == 0
    sample = landing.landing_manifest(landed, F.col("page"), F.lit(6), F.lit(2), is_sample=True)
    assert not sample.first().complete
    assert landing.skip_if_complete(sample, listing).count() == 10


def test_sample_is_layout_free(spark):
    df = spark.range(500).toDF("id")
    picked = [[r.id for r in landing.seeded_sample(df.repartition(n), "id", 20).collect()] for n in (1, 7)]
    assert picked[0] == picked[1] and len(set(picked[0])) == 20
    assert [r.id for r in landing.seeded_sample(df, "id", 20, seed=7).collect()] != picked[0]

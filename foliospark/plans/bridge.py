"""Corpus-shaped inputs derived from the generic test tables.

``acts`` turns every document into a markdown act with header, title, section
and approval line; ``index_pages`` lists the same acts as JSON index pages;
``page_manifest`` lists the web pages.  All of them grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from foliospark import constants as K

# Index pages hold at most this many entries.
PAGE_ENTRIES = 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows of a table of less than one scan split, dealt out over the cores.

    Such a file is one row group, read by one task; the text work behind it
    should not stay there.  A larger table is split by its scan and passes
    unchanged, in however few files it lies.
    """
    spark = df.sparkSession
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes"))
    if int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) >= split:
        return df
    return df.repartition(spark.sparkContext.defaultParallelism)


def acts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, no, yr, d, basename, content, path``."""
    keyed = spread(table(spark, sf_dir, "documents")).selectExpr(
        "*",
        "cast(doc_id - case when doc_id % 40 = 39 then 1 else 0 end as string) as no",
        "1946 + doc_id % 80 as yr",
        "date_add(date'1946-01-01', cast((doc_id * 7) % 28000 as int)) as d",
    ).withColumn("day", F.date_format("d", "MMMM d, yyyy"))
    return keyed.selectExpr(
        "doc_id", "no", "yr", "d",
        """case when doc_id % 50 = 49 then concat('ra', yr)
                when doc_id % 50 = 48 then concat('notes_', doc_id)
                else concat('ra_', no, '_', yr) end as basename""",
        r"""case when doc_id % 45 = 44 then '' else
            concat('**Republic Act No. ', no, '** ', day, '\n\n',
                   '**An Act Number ', no, ' concerning ', source, ' matters**', '\n\n',
                   '**Section 1.** ', text,
                   case when doc_id % 3 <> 0 then concat('\n\n', 'Approved: ', day) else '' end)
            end as content""",
        "concat('docs/', lang, '/', doc_id, '.md') as path",
    )


def index_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, page, entry``: one JSON entry per document, some malformed."""
    rows = table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "doc_id div 50 as page", "text as inner_text",
        "doc_id - case when doc_id % 40 = 39 then 1 else 0 end as no",
        "cast(date_add(date'1946-01-01', cast((doc_id * 7) % 28000 as int)) as string) as day",
    )
    title = F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("IRR of REPUBLIC ACT NO. "), "no")).otherwise(
        F.concat(F.lit("REPUBLIC ACT NO. "), "no")
    )
    day = F.when(F.col("doc_id") % 9 == 0, "").otherwise(F.col("day"))
    anchor = F.concat(
        F.lit(f"<a href='https://{K.INDEX_HOST}/thebookshelf/showdocs/2/"), "doc_id", F.lit("'>"),
        "inner_text", F.lit("</a>"),
    )
    entry = (
        F.when(F.col("doc_id") % 89 == 88, F.lit('"bare"'))
        .when(F.col("doc_id") % 97 == 96, F.to_json(F.array(title, day)))
        .otherwise(F.to_json(F.array(title, day, anchor)))
    )
    return rows.select("doc_id", "page", entry.alias("entry"))


def index_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page, payload``: JSON pages of at most ``PAGE_ENTRIES`` entries."""
    ordered = F.array_sort(F.collect_list(F.struct("doc_id", "entry")))
    entries = F.array_join(F.transform(ordered, lambda e: e.entry), ",")
    return index_entries(spark, sf_dir).groupBy("page").agg(
        F.concat(F.lit('{"data":['), entries, F.lit("]}")).alias("payload")
    )


def page_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, ra_label, url, date_text, title, source_path``."""
    return table(spark, sf_dir, "pages").selectExpr(
        "page_id", "concat('Republic Act No. ', page_id) as ra_label", "url",
        "date_format(date_add(date'1950-01-01', cast(page_id % 20000 as int)), 'MMMM d, yyyy') as date_text",
        "concat('Listed title ', page_id) as title",
        """concat('ra', page_id % 50, '/', case when page_id % 7 = 0 then 'IRR_' else 'ra_' end,
                  page_id, '_', 1950 + page_id % 70, '.html') as source_path""",
    )


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``slug, html`` of the manifest's pages; one in ten has not landed."""
    html = spread(table(spark, sf_dir, "pages").select("page_id", "html"))
    return page_manifest(spark, sf_dir).where("page_id % 10 <> 3").join(html, "page_id").select(
        F.replace("source_path", F.lit("/"), F.lit("__")).alias("slug"), "html"
    )


def index_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``url, html``: the acts of a hundred documents as one page with a table of links, some rows damaged."""
    rows = table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "doc_id div 100 as page",
        """concat('<tr class="', case when doc_id % 23 = 0 then 'head' else 'odd xy' end, '"><td>',
                  case when doc_id % 17 = 0 then 'no link' else
                    concat('<a href="ra', 1946 + doc_id % 80, '/ra_', doc_id, '.html', chr(39), '"> RA <b>No. ', doc_id, '</b></a><br> ',
                           date_format(date_add(date'1950-01-01', cast(doc_id % 20000 as int)), 'MMMM d, yyyy')) end,
                  '</td>', case when doc_id % 19 = 0 then '' else concat('<td>An act on <i>', source, '</i> &amp; ', lang, '</td>') end,
                  '</tr>') as line""",
    )
    ordered = F.array_sort(F.collect_list(F.struct("doc_id", "line")))
    lines = F.array_join(F.transform(ordered, lambda e: e.line), "\n")
    return rows.groupBy("page").agg(lines.alias("lines")).select(
        F.concat(F.lit("https://acts.example.org/index/"), "page", F.lit(".html")).alias("url"),
        F.concat(F.lit('<html><table id="other"><tr class="xy"><td><a href="x">x</a></td><td>y</td></tr></table><table id="s-menu">'),
                 "lines", F.lit("</table></html>")).alias("html"),
    )

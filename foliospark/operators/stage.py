"""Staging: three raw sources to one ten-column table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from foliospark import constants as K
from foliospark.functions import anchors, html, text
from foliospark.functions.dates import find_month_date, year_prefix
from foliospark.operators.reconcile import keep_first
from foliospark.sources.readers import manifest_pages, well_formed


def ra_id(number: Column) -> Column:
    return F.concat(F.lit("RA-"), number)


def basename_number(c: Column) -> Column:
    return text.none_if_empty(F.regexp_extract(c, K.BASENAME, 1))


def basename_year(c: Column) -> Column:
    return F.regexp_extract(c, K.BASENAME, 2).try_cast("long")


def is_index_row(basename: Column) -> Column:
    """Year catalogue rows; a null name is a normal row."""
    return F.coalesce(basename.rlike(K.INDEX_BASENAME), F.lit(False))


def drop_index_rows(df: DataFrame, basename: str = "basename") -> DataFrame:
    return df.where(~is_index_row(F.col(basename)))


def _measured(df: DataFrame, source: str) -> DataFrame:
    """Add the metrics and provenance and fix the column order."""
    out = df.withColumns({
        "content_length": text.char_count(F.col("content_clean")),
        "word_count": text.word_count(F.col("content_clean")),
        "source": F.lit(source),
    })
    return out.select(*K.STAGED_COLUMNS)


def stage_markdown(raw: DataFrame, source: str = K.SOURCE_MARKDOWN, italics: bool = True) -> DataFrame:
    """Stage markdown rows ``basename, content, path``.

    Number: file name, else header line.  Year: file name, else header date.
    Rows without either are dropped.  Each step is one projection over the
    previous one, so the text is searched for its header once.
    """
    clean = text.clean_markdown if italics else text.strip_bold_links_space
    dated = headed(drop_index_rows(raw)).withColumn("_header_date", text.header_date(F.col("_header")))
    number = F.coalesce(basename_number(F.col("basename")), text.header_number(F.col("_header")))
    year = F.coalesce(basename_year(F.col("basename")), year_prefix(F.col("_header_date")))
    title = text.title_line(F.col("_behind"), F.col("_head"))
    rows = dated.select(
        number.alias("ra_number"), year.alias("ra_year"), title.alias("title"),
        F.coalesce(text.approval_date(F.col("content")), F.col("_header_date")).alias("approval_date"),
        clean(text.strip(F.col("_behind"))).alias("content_clean"), F.col("path").alias("source_path"),
    )
    # As one generated row a document keeps what was found: a filter on plain columns
    # would be pushed below the search and repeat it.
    found = rows.select(F.explode(F.array(F.struct(*rows.columns))).alias("r")).select("r.*").where(
        F.col("ra_number").isNotNull() & F.col("ra_year").isNotNull())
    fallback = F.concat(F.lit("Republic Act No. "), F.col("ra_number"))
    return _measured(found.withColumns({"ra_id": ra_id(F.col("ra_number")), "title": F.coalesce("title", fallback)}), source)


def headed(raw: DataFrame, content: str = "content") -> DataFrame:
    """Rows with their ``_header`` line, its number ``_at``, the text ``_behind`` it and that text's ``_head`` lines."""
    cut = raw.withColumn("_flat", text.one_line_end(F.col(content))).withColumn("_pieces", text.cut_at_header(F.col("_flat")))
    pieces = F.col("_pieces")
    parts = cut.withColumns({
        "_header": text.header_line(F.col("_flat"), pieces), "_at": text.header_index(pieces), "_behind": text.behind_header(pieces),
    }).drop("_flat", "_pieces")
    return parts.withColumn("_head", text.head_lines(F.col("_behind")))


def stem(path: Column) -> Column:
    """File name of a page path without its ending."""
    return F.replace(anchors.last_segment(path), F.lit(".html"), F.lit(""))


def is_rule_document(path: Column) -> Column:
    """Implementing rules, not acts: last path segment starts with ``irr_``."""
    return F.lower(anchors.last_segment(path)).startswith("irr_")


def html_number(page_title: Column) -> Column:
    return text.none_if_empty(F.regexp_extract(page_title, text.java(K.HTML_TITLE_NUMBER), 1))


def html_title_text(page: Column) -> Column:
    """Text of the ``<title>`` element of raw HTML."""
    return F.regexp_extract(page, r"(?is)<title[^>]*>(.*?)</title>", 1)


def html_display_title(description: Column, bolds: Column) -> Column:
    """Meta description without its prefix, else the first usable bold text."""
    meta = text.strip(F.regexp_replace(description, text.java(K.META_PREFIX), ""))
    usable = F.filter(
        bolds,
        lambda b: (F.length(b) > K.TITLE_MIN_CHARS) & ~b.rlike(text.java("^" + K.HTML_TITLE_NUMBER)),
    )
    return F.coalesce(F.when(F.length(meta) > 10, meta), F.try_element_at(usable, F.lit(1)))


def keep_paragraphs(paragraphs: Column) -> Column:
    """Paragraphs without act headers and short enactment clauses."""
    enact = lambda p: p.rlike(text.java(K.ENACT_PARAGRAPH)) & (F.length(p) < K.ENACT_PARAGRAPH_MAX)
    return F.filter(paragraphs, lambda p: ~p.rlike(text.java("^" + K.HTML_TITLE_NUMBER)) & ~enact(p))


def html_body(paragraphs: Column) -> Column:
    joined = F.array_join(keep_paragraphs(paragraphs), "\n\n")
    blanks = F.regexp_replace(joined, r"[ \t]+", " ")
    return text.strip(F.regexp_replace(blanks, r"\n{3,}", "\n\n"))


def stage_html(manifest: DataFrame, pages: DataFrame, source: str = K.SOURCE_HTML,
               container: str = "blockquote") -> DataFrame:
    """Stage manifest entries whose page ``(slug, html)`` is there.

    Number: page title, else file name.  Year: file name, else the listed
    date.  Entries without a page or a number are dropped.
    """
    wanted = manifest.where(~is_rule_document(F.col("source_path")))
    joined = manifest_pages(wanted, pages).where(F.col("html").isNotNull()).select(
        "source_path", "date_text", F.col("title").alias("listed_title"), "html"
    )
    parsed = html.parse_pages(joined, "html", container)
    file_stem = stem(F.col("source_path"))
    listed = find_month_date(F.coalesce("date_text", F.lit("")))
    numbered = parsed.withColumns({
        "ra_number": F.coalesce(
            html_number(F.col("page_title")),
            text.none_if_empty(F.regexp_extract(file_stem, K.FILE_STEM, 1)),
        ),
        "approval_date": listed,
    }).where(F.col("ra_number").isNotNull())
    shaped = numbered.select(
        ra_id(F.col("ra_number")).alias("ra_id"), "ra_number",
        F.coalesce(F.regexp_extract(file_stem, K.STEM_YEAR, 1).try_cast("long"),
                   year_prefix(F.col("approval_date"))).alias("ra_year"),
        F.coalesce(html_display_title(F.col("description"), F.col("bolds")),
                   F.col("listed_title")).alias("title"),
        "approval_date", html_body(F.col("paragraphs")).alias("content_clean"), "source_path",
    )
    return _measured(shaped, source)


def stage_index(entries: DataFrame, source: str = K.SOURCE_JSON, host: str = K.INDEX_HOST) -> DataFrame:
    """Stage exploded index entries: strict labels with a valid document path.

    The first entry per act in (page, position) order wins.
    """
    shaped = well_formed(entries).select(
        "page", "pos",
        anchors.label_number(F.col("title")).alias("ra_number"),
        F.when(F.col("date_text") != "", F.col("date_text")).alias("approval_date"),
        anchors.descriptive_title(F.col("anchor"), F.col("title")).alias("title"),
        anchors.anchor_path(F.col("anchor"), host).alias("source_path"),
    ).where(F.col("ra_number").isNotNull() & F.col("source_path").isNotNull())
    rows = shaped.withColumns({
        "ra_id": ra_id(F.col("ra_number")),
        "ra_year": year_prefix(F.col("approval_date")),
        "content_clean": F.col("title"),
    })
    return _measured(keep_first(rows, ["ra_id"], ["page", "pos"]), source)

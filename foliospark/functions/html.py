"""HTML pages to fields, one Arrow batch at a time.

Spark has no HTML parser, so this is the place where rows go through Python.
The parser only cuts a page into pieces; every rule about the pieces (which
paragraph counts, which title wins) is a Column expression in the operators.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

# Opening one of these ends an open paragraph, as browsers do.
_ENDS_PARAGRAPH = frozenset(
    "p div dir ul ol dl table blockquote article section center form hr pre h1 h2 h3 h4 h5 h6".split()
)
_SILENT = frozenset(("script", "style"))
# Pages that are held as Python objects at a time, and their bytes.
PIECE_ROWS, PIECE_BYTES = 200, 2 << 20
PAGE_FIELDS = "page_title string, description string, bolds array<string>, paragraphs array<string>"
INDEX_FIELDS = "ra_label string, url string, date_text string, title string, source_path string"


class _PageParser(HTMLParser):
    """Collects title, description, bold texts and paragraphs of a container."""

    def __init__(self, container: str) -> None:
        super().__init__(convert_charrefs=True)
        self.container = container
        self.title: str | None = None
        self.description: str | None = None
        self.bolds: list[list[str]] = []
        self.paragraphs: list[list[str]] = []
        self._open: list[tuple[str, list[str]]] = []
        self._depth = 0
        self._seen = False
        self._silent = 0
        self._in_title = False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _SILENT:
            self._silent += 1
        elif tag == "title" and self.title is None:
            self._in_title, self.title = True, ""
        elif tag == "meta" and self.description is None:
            found = dict(attrs)
            if found.get("name") == "description":
                self.description = found.get("content")
        if tag == self.container and (self._depth or not self._seen):
            self._depth += 1
            self._seen = True
            return
        if not self._depth:
            return
        if tag in _ENDS_PARAGRAPH:
            self._close("p")
        if tag in ("p", "dir", "b"):
            pieces: list[str] = []
            (self.bolds if tag == "b" else self.paragraphs).append(pieces)
            self._open.append((tag, pieces))

    def handle_endtag(self, tag: str) -> None:
        if tag in _SILENT:
            self._silent = max(0, self._silent - 1)
        elif tag == "title":
            self._in_title = False
        if tag == self.container and self._depth:
            self._depth -= 1
            if not self._depth:
                self._open.clear()
        elif self._depth and tag in ("p", "dir", "b"):
            self._close(tag)

    def handle_data(self, data: str) -> None:
        if self._in_title:
            self.title = (self.title or "") + data
        if self._silent or not self._depth:
            return
        text = data.strip()
        if text:
            for _, pieces in self._open:
                pieces.append(text)

    def _close(self, tag: str) -> None:
        for at in range(len(self._open) - 1, -1, -1):
            if self._open[at][0] == tag:
                del self._open[at:]
                return


class _IndexParser(HTMLParser):
    """Rows of one link table: cells with their texts, link and line breaks."""

    def __init__(self, table_id: str, row_class: str) -> None:
        super().__init__(convert_charrefs=True)
        self.table_id, self.row_class = table_id, row_class
        self.found = False
        self.rows: list[list[dict]] = []
        self._depth = 0
        self._row: list[dict] | None = None
        self._link: list[str] | None = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        found = dict(attrs)
        if tag == "table" and (self._depth or (not self.found and found.get("id") == self.table_id)):
            self._depth += 1
            self.found = True
        if not self._depth:
            return
        if tag == "tr":
            self._row = [] if self.row_class in (found.get("class") or "").split() else None
            if self._row is not None:
                self.rows.append(self._row)
        elif tag == "td" and self._row is not None:
            self._link = None
            self._row.append({"text": [], "href": None, "label": [], "date": None, "br": False})
        elif self._row:
            cell = self._row[-1]
            if tag == "a" and "href" in found and cell["href"] is None:
                cell["href"] = found["href"] or ""
                self._link = cell["label"]
            elif tag == "br" and cell["date"] is None:
                cell["br"] = True
            elif cell["br"] and cell["date"] is None:
                cell["br"] = False

    def handle_endtag(self, tag: str) -> None:
        if tag == "table" and self._depth:
            self._depth -= 1
        elif tag == "a":
            self._link = None
        elif tag == "tr":
            self._row = None

    def handle_data(self, data: str) -> None:
        if not self._depth or not self._row:
            return
        cell = self._row[-1]
        if cell["br"] and cell["date"] is None:
            cell["date"] = data.strip()
        if data.strip():
            cell["text"].append(data.strip())
            if self._link is not None:
                self._link.append(data.strip())


def parse_pages(pages: DataFrame, html: str = "html", container: str = "blockquote") -> DataFrame:
    """Replace the ``html`` column by the page's fields; other columns stay."""
    kept = [c for c in pages.columns if c != html]
    ddl = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in kept)
    fields = pa.schema([("page_title", pa.string()), ("description", pa.string()), ("bolds", pa.list_(pa.string())), ("paragraphs", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in _pieces(batch.column(html)):
                parsed = []
                for text in texts:
                    parser = _PageParser(container)
                    parser.feed(text or "")
                    parser.close()
                    parsed.append((
                        parser.title,
                        parser.description,
                        [" ".join(x) for x in parser.bolds],
                        [" ".join(x) for x in parser.paragraphs],
                    ))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(start, len(parsed)) for c in kept), *(pa.array(v, f.type) for v, f in zip(zip(*parsed), fields))],
                    names=[*kept, *fields.names])

    return pages.mapInArrow(run, f"{ddl}, {PAGE_FIELDS}")


def _pieces(texts: pa.Array) -> Iterator[tuple[int, Iterator[str | None]]]:
    """Some texts of a batch at a time, with the place of the first: few, and of bounded size together unless a single one is longer."""
    start = 0
    sizes = [n or 0 for n in pc.binary_length(texts).to_pylist()]
    while start < len(texts):
        end, total = start + 1, sizes[start]
        while end < len(texts) and end - start < PIECE_ROWS and total + sizes[end] <= PIECE_BYTES:
            total += sizes[end]
            end += 1
        yield start, (value.as_py() for value in texts.slice(start, end - start))
        start = end


def parse_index(
    pages: DataFrame, html: str = "html", base_url: str = "url",
    table_id: str = "s-menu", row_class: str = "xy", missing: str = "error",
) -> DataFrame:
    """Entries of the link table on every index page.

    Rows with fewer than two cells or without a link are skipped.  A page
    without the table is an error unless ``missing="skip"``.
    """
    from foliospark.functions.anchors import clean_href

    raw_schema = "base string, ra_label string, href string, date_text string, title string"

    schema = pa.schema([(name, pa.string()) for name in ("base", "ra_label", "href", "date_text", "title")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in _pieces(batch.column(html)):
                out = []
                for at, text in enumerate(texts, start):
                    base = batch.column(base_url)[at].as_py()
                    parser = _IndexParser(table_id, row_class)
                    parser.feed(text or "")
                    parser.close()
                    if not parser.found and missing == "error":
                        raise RuntimeError(f"no table with id {table_id!r} on {base}")
                    for row in parser.rows:
                        if len(row) >= 2 and row[0]["href"] is not None:
                            first = row[0]
                            out.append((base, " ".join(first["label"]), first["href"],
                                        first["date"] or "", " ".join(row[1]["text"])))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(v, pa.string()) for v in zip(*out)], schema=schema)

    @F.pandas_udf("string")
    def join_url(base: pd.Series, href: pd.Series) -> pd.Series:
        return pd.Series([urljoin(b, h) for b, h in zip(base, href)], dtype=object)

    rows = pages.select(html, base_url).mapInArrow(run, raw_schema)
    rows = rows.withColumn("source_path", clean_href(F.col("href")))
    return rows.select(
        "ra_label", join_url("base", "source_path").alias("url"), "date_text", "title", "source_path"
    )

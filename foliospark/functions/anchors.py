"""Functions over links and anchors."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from foliospark import constants as K
from foliospark.functions.text import collapse_ws, java, none_if_empty


def label_number(c: Column) -> Column:
    """Number in a strict index label, null for any other label."""
    return none_if_empty(F.regexp_extract(c, java(K.LABEL), 1))


def anchor_text(c: Column) -> Column:
    """Inner text of the first anchor, white space collapsed."""
    return collapse_ws(F.regexp_extract(F.coalesce(c, F.lit("")), K.ANCHOR_INNER, 1))


def descriptive_title(anchor: Column, label: Column) -> Column:
    """Anchor text when it is long enough to describe, else the label."""
    text = anchor_text(anchor)
    return F.when(F.length(text) >= K.TITLE_MIN_CHARS, text).otherwise(label)


def anchor_path(c: Column, host: str = K.INDEX_HOST) -> Column:
    """Provider-relative document path of an anchor on ``host``, or null."""
    pattern = rf"""href=['"]https?://{re.escape(host)}(/[^'"]+)['"]"""
    path = F.regexp_extract(c, pattern, 1)
    return F.when(path.rlike(K.ANCHOR_PATH_SHAPE), F.ltrim(path, F.lit("/")))


def clean_href(c: Column) -> Column:
    """Trimmed NFKC href without any quote character."""
    from foliospark.functions.text import strip
    from foliospark.functions.unicode import nfkc

    return F.translate(strip(nfkc(F.coalesce(c, F.lit("")))), K.QUOTE_CHARS, "")


def last_segment(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def page_slug(path: Column) -> Column:
    return F.replace(path, F.lit("/"), F.lit("__"))


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute form of ``href`` on page ``base`` (dot segments stay)."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    no_fragment = F.regexp_extract(base, r"^([^#]*)", 1)
    folder = F.regexp_extract(page, r"^(.*://[^/]*/(?:.*/)?)", 1)
    folder = F.when(folder == "", F.concat(origin, F.lit("/"))).otherwise(folder)
    return (
        F.when(href == "", base)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(origin, href))
        .when(href.startswith("?"), F.concat(page, href))
        .when(href.startswith("#"), F.concat(no_fragment, href))
        .otherwise(F.concat(folder, href))
    )

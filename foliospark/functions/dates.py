"""Date functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from foliospark import constants as K


def find_month_date(c: Column) -> Column:
    """ISO text of the first ``Month d, yyyy`` in ``c``; invalid dates are null.

    Only the first hit counts: a hit with an unknown month gives null, it does
    not move the search on.
    """
    pattern = "(?U)" + K.MONTH_DATE
    hit = F.regexp_extract(c, pattern, 0)
    parts = F.concat_ws(" ", *[F.regexp_extract(hit, pattern, g) for g in (1, 2, 3)])
    # The pattern letters accept abbreviations nowhere: MMMM is full names only.
    day = F.try_to_date(parts, "MMMM d yyyy")
    return F.when(F.year(day) >= 1, day).cast("string")


def iso_date(c: Column) -> Column:
    """Lenient parse of ISO-like text to DATE; anything else becomes null."""
    return F.try_to_date(c, "yyyy-M-d")


def year_prefix(c: Column) -> Column:
    """Year from the first four characters of an ISO date."""
    return F.substring(c, 1, 4).try_cast("long")

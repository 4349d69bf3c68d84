"""Unicode NFKC, the one text step Spark has no expression for."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from foliospark import constants as K


@F.pandas_udf(T.StringType())
def _nfkc_batch(values: pd.Series) -> pd.Series:
    return values.map(lambda s: unicodedata.normalize("NFKC", s), na_action="ignore")


def nfkc(c: Column) -> Column:
    """NFKC form of ``c``.

    Only rows holding a character NFKC could change travel to Python; all
    others are sent as nulls and keep their JVM value.
    """
    # Plain ASCII is told by its byte length; the range in front of the
    # intersection rejects ASCII characters of other texts in one step.
    needs_work = (F.octet_length(c) > F.length(c)) & c.rlike(
        rf"[\x{{A0}}-\x{{10FFFF}}&&[^{K.NFKC_INERT}]]"
    )
    return F.coalesce(_nfkc_batch(F.when(needs_work, c)), c)

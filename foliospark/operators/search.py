"""Full-text search over an inverted index of exact tokens."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from foliospark.operators.tfidf import idf, term_counts


def inverted_index(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``term, key, tf`` postings, built row by row without a shuffle."""
    return term_counts(docs, key, text).select("term", key, "tf")


# Postings of one term that one partition holds on average, at most.
POSTINGS = 200_000


def slices_for(n_docs: int, postings: int = POSTINGS) -> int:
    """Partitions for the commonest term: it has one posting for each document at most."""
    return max(1, math.ceil(n_docs / postings))


def write_index(index: DataFrame, path: str, key: str, n_docs: int) -> None:
    """Store postings sorted by term, so that a query skips to its pages.

    A term is spread over partitions by document, as many as the number of
    documents asks for, because a common one may hold a large part of all
    postings.  Hashing needs no sampling pass, which would tokenize everything
    twice.
    """
    slices = slices_for(n_docs)
    slice_no = F.pmod(F.xxhash64(key), F.lit(slices))
    placed = index.repartition("term", slice_no).sortWithinPartitions("term", key)
    placed.write.mode("errorifexists").parquet(path)


def search_all(index: DataFrame, words: list[str], key: str, n_docs: DataFrame) -> DataFrame:
    """Documents holding every word, ``key, score``, best first.

    The score is the sum of tf times idf.  ``n_docs`` is a one-row count.  The
    word filter reaches the scan of a stored index.
    """
    wanted = sorted({w.lower() for w in words})
    hits = index.where(F.col("term").isin(wanted))
    total = n_docs.scalar()
    # One row per query word, so a bounded broadcast.
    freq = hits.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    scored = hits.join(F.broadcast(freq), "term").groupBy(key).agg(
        F.count(F.lit(1)).alias("_found"),
        F.sum(F.col("tf") * idf(total, F.col("df"))).alias("_score"),
    )
    return scored.where(F.col("_found") == len(wanted)).select(
        key, F.round("_score", 6).alias("score")
    ).orderBy(F.desc("score"), key)

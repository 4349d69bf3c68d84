"""The training-data pipeline: documents in, encoded documents out.

Each stage works on what the one before it kept; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from foliospark.llm import additive, bpe, decontaminate, minhash, secrets
from foliospark.llm.common import discarded, row_key, small, stored

#: A byte that belongs to a word.
NO_GAP = r"[^\x20\x09-\x0D]"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; see ``additive.accepted`` for null, empty and repeated rows."""
    return additive.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest id, one without an id only if none has one.

    Rows are told apart by id and text, so texts that share an id or have none
    are judged each on its own.  Equal rows are one document; a null or wordless
    text is linked with nothing and stays.  What goes is decided on keys alone,
    and texts are joined with the keys to drop once.
    """
    at = "dedup_at" + "_" * max((len(c) for c in docs.columns), default=0)  # a name no column has
    keyed = docs.withColumn(at, row_key("doc_id", "text"))
    worded = keyed.where(F.coalesce("text", F.lit("")).rlike(NO_GAP))
    rows = worded.groupBy("doc_id", at).agg(F.count(F.lit(1)).alias("times"))
    # Under the key as its id, a row shares links with equal rows only.
    groups = minhash.near_duplicates(worded.select(F.col(at).alias("doc_id"), "text")).select(F.col("doc_id").alias(at), "component_id")
    told = stored(rows.join(groups.distinct(), at), "groups")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", at)).alias("first")
    stays = told.groupBy("component_id").agg(first).select(F.col(f"first.{at}").alias(at))
    dropped = stored(told.select(at).join(stays, at, "left_anti"), "dropped")
    repeated = stored(told.where("times > 1").select(at).join(stays, at, "left_semi"), "repeated")
    out = keyed.join(small(dropped), at, "left_anti")
    if not repeated.isEmpty():
        out = out.join(small(repeated), at, "left_anti").unionByName(out.join(small(repeated), at, "left_semi").dropDuplicates([at]))
    return out.drop(at)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; see ``decontaminate.clean`` for null, empty and repeated rows."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking secrets are replaced by a mark; ``n_chars`` follows the text."""
    return secrets.redacted(docs).withColumn("n_chars", F.length("text").cast("long"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, one row each: ``doc_id`` and the digests of ``bpe.encoded``.

    A null or empty text has no tokens, a null id stays null, equal rows have
    equal results, long texts are encoded whole, further columns go, and an
    empty table gives an empty result.
    """
    return bpe.encoded(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality", quality), ("near_dedup", near_dedup), ("decontamination", decontamination),
    ("secret_scan", secret_scan), ("encoding", encoding),
]

#: A fitted model, signatures and BPE are beyond SQL; a test compares all rows of a small table with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, sf_dir), name)
        discarded(before)
    return STAGES[-1][1](spark, docs, sf_dir)

"""A training-data pipeline over ``documents``: language ID, line dedup, near-dedup, substring dedup, packing.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept, and returns
documents with the same columns; the last one returns packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcast.llm import langid, lines, minhash, packing, substring
from tripcast.llm.queries import vocabulary
from tripcast.llm.rounds import written

MIN_SCORE = 0.05  # of language ID: what is further from all profiles than any prose goes


def _apart(docs: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """work on docs, with their further columns out of the way of an operator's own columns."""
    names = [c if c in ("doc_id", "text", "lang") else f"further{i}" for i, c in enumerate(docs.columns)]
    return work(docs.toDF(*names)).select(*names).toDF(*docs.columns)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is known; profiles are learned as in operator 8."""
    profiles = langid.learn(docs.where(~langid.held_out()))
    known = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_SCORE)
    return _apart(docs, lambda d: langid.identify(d, profiles).where(known))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that ten or more documents hold."""
    return _apart(docs, lines.line_dedup)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near duplicates (five words, similarity 0.8)."""
    gone = minhash.near_duplicates(docs).where("not kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove passages of 13 or more words that an earlier document holds; all other bytes stay."""
    return _apart(docs, lambda d: substring.substring_dedup(d, joined=False))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of power-of-two length, at most 1024 tokens."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), added=True)


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("minhash_dedup", near_stage),
    ("substring_dedup", substring_stage),
    ("packing", packing_stage),
]

# Rank-order profiles, tokens and links by Jaccard similarity have no practical SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written as Parquet to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs

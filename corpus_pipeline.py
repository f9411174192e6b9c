"""A training corpus from raw documents: classify, de-duplicate, mix, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame.  All but the last
return the columns of ``docs``; every stage works on all rows that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gleanmark.llm import bpe, minhash, mixing, quality
from gleanmark.llm.common import importable, read, stage


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the table ``labels``."""
    importable(spark)
    return quality.accepted(docs, read(spark, sf_dir, "labels").select("doc_id", "quality"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    importable(spark)
    return minhash.without_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    importable(spark)
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of what they decode to."""
    importable(spark)
    return bpe.encoded_documents(docs, keep_ids=True)


STAGES = [
    ("quality classifier", classify),
    ("minhash near-dedup", deduplicate),
    ("mixing sources", mix),
    ("bpe encoding and decoding", encode),
]

# The fit of the first stage and the merges of the last are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table ``documents``, each written and read again for the next."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

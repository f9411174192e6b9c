"""Parquet corpora: scans, per-split sinks and read-back checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanmark.operators.expectations import expect_columns
from gleanmark.schemas import TABLES


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the known tables under its declared schema."""
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def load_split(
    df: DataFrame, text: str, label: str, row_id: str | None = None, limit: int | None = None
) -> DataFrame:
    """``text, label`` as strings; with ``limit`` the first rows by ``row_id``."""
    expect_columns(df, [text, label])
    if limit is not None:
        if row_id is None:
            raise ValueError("a limit needs a row order")
        df = df.orderBy(row_id).limit(limit)
    return df.select(
        *([row_id] if row_id else []),
        F.col(text).cast("string").alias("text"),
        F.col(label).cast("string").alias("label"),
    )


def union_splits(splits: dict[str, DataFrame]) -> DataFrame:
    """All splits as one table with a ``split`` column."""
    out = None
    for name, df in splits.items():
        part = df.withColumn("split", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def write_splits(df: DataFrame, path: str, split: str = "split") -> None:
    """One folder per split, so that reading a split prunes the others."""
    df.write.mode("overwrite").partitionBy(split).parquet(path)


def read_splits(spark: SparkSession, path: str, schema: str, split: str = "split") -> DataFrame:
    return spark.read.schema(f"{schema}, {split} string").parquet(path)


def verify_written(written: DataFrame, path: str, split: str = "split") -> DataFrame:
    """One row: do the columns and the row count of the table on disk match?"""
    back = written.sparkSession.read.parquet(path)
    same = sorted((f.name, f.dataType.simpleString()) for f in written.schema) == sorted(
        (f.name, f.dataType.simpleString()) for f in back.schema
    )
    both = written.select(F.lit(1).alias("_w"), F.lit(0).alias("_r")).unionByName(
        back.select(F.lit(0).alias("_w"), F.lit(1).alias("_r"))
    )
    return both.agg(
        F.lit(same).alias("same_schema"),
        F.sum("_w").alias("n_written"),
        F.sum("_r").alias("n_read"),
        (F.lit(same) & (F.sum("_w") == F.sum("_r"))).alias("ok"),
    )


def count_per_split(df: DataFrame, splits: Sequence[str], split: str = "split") -> DataFrame:
    """``split, n`` for the named splits, zero included."""
    wide = df.agg(*[F.count_if(F.col(split) == s).alias(s) for s in splits])
    return wide.unpivot([], list(splits), split, "n")

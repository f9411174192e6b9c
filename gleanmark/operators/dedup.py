"""Keep-first de-duplication and duplicate counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanmark.functions.keys import content_key
from gleanmark.session import lookup


def repeated_keys(df: DataFrame, key: Column, row_id: str) -> DataFrame:
    """``_key, _first`` of every key that occurs more than once.

    Counting combines on the map side, so a key that fills a third of the table
    still reaches the shuffle as one row per task.
    """
    return (
        df.groupBy(key.alias("_key"))
        .agg(F.count("*").alias("_n"), F.min(row_id).alias("_first"))
        .where("_n > 1")
        .select("_key", "_first")
    )


def keep_first(
    df: DataFrame, keys: Sequence[str], row_id: str, hashed: str | None = None
) -> DataFrame:
    """The row with the least ``row_id`` of each key; null keys are equal.

    ``hashed`` names a column that already holds ``content_key(*keys)``; with it
    the key columns are not read.

    Only repeated keys are looked up.  When they are few the look-up is broadcast
    by its measured size and the table is not shuffled; otherwise the join
    shuffles and adaptive execution splits a hot key.  The keys are hashes, so
    the first pass reads the key columns alone and moves 40 bytes per distinct key.
    """
    key = F.col(hashed) if hashed else content_key(*keys)
    keyed = df.withColumn("_key", key)
    repeated = lookup(repeated_keys(df, key, row_id), "repeated")
    return (
        keyed.join(repeated, "_key", "left")
        .where(F.col("_first").isNull() | (F.col("_first") == F.col(row_id)))
        .select(*df.columns)
    )


def duplicates_beyond_first(*cols: str, hashed: str | None = None) -> Column:
    """Aggregate: rows that repeat an earlier row on ``cols``.

    ``hashed`` names a column that already holds ``content_key(*cols)``.
    """
    return F.count("*") - F.count_distinct(F.col(hashed) if hashed else content_key(*cols))

"""Equi-joins whose hot keys are dealt over several tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanmark.session import lookup

# Rows of one key on the large side that one copy of its rows on the other side serves.
SALT_ROWS = 100_000


def salts(rows: DataFrame, key: str, salt_rows: int = SALT_ROWS) -> DataFrame:
    """``key, salts``: how many copies a key needs, for the keys that need several.

    There are at most ``rows / salt_rows`` of them.
    """
    counted = rows.groupBy(key).agg(F.count("*").alias("_n"))
    return counted.where(F.col("_n") > salt_rows).select(key, F.ceil(F.col("_n") / salt_rows).cast("int").alias("salts"))


def salted_join(
    large: DataFrame,
    index: DataFrame,
    key: str,
    spread: Sequence[str],
    salt_rows: int = SALT_ROWS,
    most: int | None = None,
) -> DataFrame:
    """Inner join of two tables on ``key``.

    Where ``large`` holds a key often, the rows of ``index`` with that key are repeated
    and those of ``large`` dealt over the copies by the columns ``spread``, so no task
    gets a hot key whole.  Beside ``key`` the tables must share no column.  ``most`` says
    how often any key can occur in ``large``; without it the rows are counted, so hand in
    a written table.
    """
    if (large.count() if most is None else most) <= salt_rows:  # no key can be hot
        return large.join(index, key)
    hot = lookup(salts(large, key, salt_rows), "salts")
    copies = F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)
    repeated = index.join(F.broadcast(hot), key, "left").withColumn("_salt", F.explode(copies)).drop("salts")
    salt = F.pmod(F.xxhash64(*spread), F.coalesce("salts", F.lit(1))).cast("int")
    dealt = large.join(F.broadcast(hot), key, "left").withColumn("_salt", salt).drop("salts")
    return dealt.join(repeated, [key, "_salt"]).drop("_salt")

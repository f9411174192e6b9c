"""Overlap between splits: find it, list it, remove it."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanmark.functions.keys import content_key
from gleanmark.session import lookup


def _presence(df: DataFrame, key: Column, split: str, splits: Sequence[str]) -> DataFrame:
    """One row per key: ``_key`` and a flag ``_in<i>`` per split.

    A grouped maximum, so neither a self-join nor a list of copies is needed and
    a hot key combines on the map side.
    """
    return df.groupBy(key.alias("_key")).agg(
        *[F.max(F.col(split) == s).alias(f"_in{i}") for i, s in enumerate(splits)]
    )


def overlap_counts(df: DataFrame, keys: Sequence[str], split: str, splits: Sequence[str]) -> DataFrame:
    """``pair, n_shared`` distinct keys for each pair of splits."""
    pairs = list(combinations(range(len(splits)), 2))
    seen = _presence(df, content_key(*keys), split, splits)
    cells = [
        F.struct(
            F.lit(f"{splits[a]}-{splits[b]}").alias("pair"),
            F.count_if(F.col(f"_in{a}") & F.col(f"_in{b}")).alias("n_shared"),
        )
        for a, b in pairs
    ]
    return seen.agg(F.array(*cells).alias("r")).select(F.inline("r"))


def tag_leakage(
    df: DataFrame, keys: Sequence[str], split: str, priority: Sequence[str] = ("test", "val", "train")
) -> DataFrame:
    """Add ``leaks_into``: the next stronger split that holds the same key, else null.

    ``priority`` runs from the split that keeps everything to the one that yields
    to all.  Only keys held by two or more splits are looked up.
    """
    seen = _presence(df, content_key(*keys), split, priority)
    spread = F.lit(0)
    for i in range(len(priority)):
        spread = spread + F.col(f"_in{i}").cast("int")
    shared = lookup(seen.where(spread > 1), "shared")
    into = F.lit(None).cast("string")
    for i, name in enumerate(priority):
        stronger = [F.when(F.col(f"_in{j}"), F.lit(priority[j])) for j in reversed(range(i))]
        if stronger:
            into = F.when(F.col(split) == name, F.coalesce(*stronger)).otherwise(into)
    return (
        df.withColumn("_key", content_key(*keys))
        .join(shared, "_key", "left")
        .select(*df.columns, into.alias("leaks_into"))
    )


def drop_leakage(
    df: DataFrame, keys: Sequence[str], split: str, priority: Sequence[str] = ("test", "val", "train")
) -> DataFrame:
    """Every split gives up the rows a stronger split holds too; null keys are equal."""
    return tag_leakage(df, keys, split, priority).where("leaks_into is null").drop("leaks_into")


def leak_rows(df: DataFrame, text: str, label: str, split: str, splits: Sequence[str]) -> DataFrame:
    """Each shared ``(text, label)`` once, with the splits that hold it, sorted.

    Shared keys are found on hashes alone; only the texts behind them move.
    """
    flags = [F.col(f"_in{i}") for i in range(len(splits))]
    held = F.filter(
        F.array(*[F.when(f, F.lit(s)) for f, s in zip(flags, splits)]), lambda s: s.isNotNull()
    )
    shared = lookup(
        _presence(df, content_key(text, label), split, splits)
        .withColumn("_held", held)
        .where(F.size("_held") > 1)
        .select("_key", F.array_join("_held", ",").alias("splits")),
        "shared",
    )
    return (
        df.select(text, label, content_key(text, label).alias("_key"))
        .join(shared, "_key")
        .groupBy("_key", "splits")
        .agg(F.min(text).alias(text), F.min(label).alias(label))
        .select(text, label, "splits")
        .orderBy(text, label)
    )


def shared_texts(left: DataFrame, right: DataFrame, text: str) -> DataFrame:
    """Distinct texts of ``left`` that ``right`` holds as well, compared by key."""
    sides = left.select(text, F.lit("left").alias("_side")).unionByName(
        right.select(text, F.lit("right").alias("_side"))
    )
    both = _presence(sides, content_key(text), "_side", ["left", "right"]).where("_in0 and _in1")
    shared = lookup(both.select("_key"), "shared")
    return (
        left.select(text, content_key(text).alias("_key"))
        .join(shared, "_key")
        .groupBy("_key")
        .agg(F.min(text).alias(text))
        .select(text)
    )

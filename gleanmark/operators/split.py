"""Exact-size stratified splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanmark.functions.keys import seeded_order
from gleanmark.operators.ranking import cut_points
from gleanmark.session import lookup, stage


def _held_out(total: Column, fraction: float) -> Column:
    return F.ceil(F.lit(fraction) * total).cast("long")


def kept_quota(counts: DataFrame, n: str, fraction: float, label: str, out: str) -> DataFrame:
    """How many rows of each class stay when ``ceil(fraction * total)`` are held out.

    Largest remainder: each class keeps the whole part of its share, and the rows
    still missing go to the largest remainders, ties by label.  Integer arithmetic
    throughout, so totals beyond 2^53 stay exact.  ``counts`` has a row per class.
    """
    everything = Window.partitionBy()
    with_total = counts.withColumn("_total", F.sum(n).over(everything))
    kept = F.col("_total") - _held_out(F.col("_total"), fraction)
    share = kept.cast("decimal(19,0)") * F.col(n).cast("decimal(18,0)")
    parts = (
        with_total.withColumn("_kept", kept)
        .withColumn("_share", share)
        .withColumn("_whole", F.expr("_share div _total"))
        .withColumn("_rest", F.expr("_share % _total"))
    )
    seats = F.row_number().over(everything.orderBy(F.desc("_rest"), F.col(label).asc_nulls_first()))
    missing = F.col("_kept") - F.sum("_whole").over(everything)
    return (
        parts.withColumn("_missing", missing)
        .withColumn("_seat", seats)
        .withColumn(out, F.col("_whole") + (F.col("_seat") <= F.col("_missing")).cast("long"))
        .drop("_total", "_kept", "_share", "_whole", "_rest", "_missing", "_seat")
    )


def stratified_split(
    df: DataFrame,
    label: str,
    row_id: str,
    rounds: Sequence[tuple[float, str]],
    remainder: str = "train",
    seed: int = 42,
) -> DataFrame:
    """Add ``split`` so that every class is divided exactly by quota.

    ``rounds`` names the cuts from the outside in: ``[(0.25, "val"), (0.60, "test")]``
    holds a quarter back, then sends 60% of that to ``test`` and the rest to ``val``.
    One round, ``[(0.12, "val")]``, is a plain two-way split.

    Quotas come from the class counts alone, so any number of rounds needs one
    ranking of the rows.  Class counts are the only thing brought to one task.
    ``df`` is read twice: for the label and order key, which are staged, and for
    the result.
    """
    keyed = stage(
        df.select(F.col(label).alias("grp"), seeded_order(seed, row_id).alias("order_key")), "order-keys"
    )
    counts = keyed.groupBy("grp").agg(F.count("*").alias("n"))
    # Rows ranked above `in_0` stay in the remainder; within the held-out part the
    # next round again keeps the lowest ranks.
    staged = counts.withColumn("left", F.col("n"))
    for i, (fraction, _) in enumerate(rounds):
        staged = kept_quota(staged, "left", fraction, "grp", f"kept_{i}")
        staged = staged.withColumn("left", F.col("left") - F.col(f"kept_{i}"))
    # Order: innermost held-out part first, remainder last.
    n_rounds = len(rounds)
    bounds = [F.col("left")]
    for i in range(n_rounds - 1, 0, -1):
        bounds.append(bounds[-1] + F.col(f"kept_{i}"))
    quotas = staged.select(
        "grp",
        F.explode(
            F.array(*[F.struct(F.lit(s).alias("slot"), b.alias("quota")) for s, b in enumerate(bounds)])
        ).alias("q"),
    ).select("grp", "q.slot", "q.quota")
    cuts = lookup(
        cut_points(keyed, quotas)
        .groupBy("grp")
        .agg(*[F.max(F.when(F.col("slot") == s, F.col("cut"))).alias(f"_cut_{s}") for s in range(n_rounds)]),
        "class-cuts",
    )
    names = [rounds[-1][1]] + [rounds[i - 1][1] for i in range(n_rounds - 1, 0, -1)]
    joined = df.join(cuts, df[label].eqNullSafe(cuts["grp"]), "left").withColumn(
        "_order", seeded_order(seed, row_id)
    )
    split = F.lit(remainder)
    for s in range(n_rounds - 1, -1, -1):
        split = F.when(F.col("_order") <= F.col(f"_cut_{s}"), F.lit(names[s])).otherwise(split)
    return joined.withColumn("split", split).select(*df.columns, "split")


def split_sizes(df: DataFrame, split: str = "split") -> DataFrame:
    """``split, n, fraction`` with the fraction rounded to four digits."""
    sizes = df.groupBy(split).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return sizes.select(split, "n", F.round(F.col("n") / total, 4).alias("fraction"))


def class_balance(df: DataFrame, label: str, split: str = "split") -> DataFrame:
    """Rows per split and class."""
    return df.groupBy(split, label).agg(F.count("*").alias("n"))


def conservation(df: DataFrame, parts: DataFrame, split: str = "split") -> DataFrame:
    """Do the split sizes add up to the input?  One row."""
    before = df.agg(F.count("*").alias("n"), F.lit(None).cast("long").alias("assigned"))
    after = parts.agg(F.count("*").alias("n"), F.count(split).alias("assigned"))
    sides = before.unionByName(after)
    return sides.agg(
        F.max(F.when(F.col("assigned").isNull(), F.col("n"))).alias("n_input"),
        F.max(F.when(F.col("assigned").isNotNull(), F.col("n"))).alias("n_split"),
        F.max("assigned").alias("n_assigned"),
    ).withColumn(
        "ok",
        (F.col("n_input") == F.col("n_split")) & (F.col("n_split") == F.col("n_assigned")),
    )


def _class_by_split(df: DataFrame, label: str, split: str, splits: Sequence[str]) -> DataFrame:
    """``label, split, n`` for every class and every split in ``splits``; absent is 0.

    One aggregate: each class row carries one counter per split, then unfolds.
    """
    per_class = (
        df.where(F.col(label).isNotNull())
        .groupBy(label)
        .agg(*[F.count_if(F.col(split) == s).alias(f"_n{i}") for i, s in enumerate(splits)])
    )
    cells = F.array(
        *[F.struct(F.lit(s).alias(split), F.col(f"_n{i}").alias("n")) for i, s in enumerate(splits)]
    )
    return per_class.select(label, F.inline(cells))


def missing_classes(df: DataFrame, label: str, split: str, splits: Sequence[str]) -> DataFrame:
    """``split, label`` for every class a split lacks."""
    return _class_by_split(df, label, split, splits).where("n = 0").select(split, label)


def class_drift(
    df: DataFrame, label: str, split: str, splits: Sequence[str], limit: float = 0.02
) -> DataFrame:
    """Largest change of any class fraction per split, and whether it is below ``limit``.

    A class missing from a split counts with fraction zero.
    """
    in_split = F.sum("n").over(Window.partitionBy(split))
    in_class = F.sum("n").over(Window.partitionBy(label))
    everything = F.sum("n").over(Window.partitionBy())
    return (
        _class_by_split(df, label, split, splits)
        .withColumn("_change", F.abs(F.col("n") / in_split - in_class / everything))
        .groupBy(split)
        .agg(F.max("_change").alias("_max"))
        .select(split, F.round("_max", 6).alias("max_change"), (F.col("_max") < limit).alias("ok"))
    )

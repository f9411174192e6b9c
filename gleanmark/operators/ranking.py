"""Exact "the q smallest rows of each group" without sorting a group in one task.

A group may hold a third of all rows, so ``row_number`` over the whole group is
out.  Instead a histogram over the leading hex digits of the order key finds, per
group and quota, the one bucket the cut falls into (one in 4,096 of the group).
A bucket that still holds many keys is divided again by its next digits, until
it is small; only its keys are ranked to find the cut value.  Selecting rows is
then a comparison with the group's cut, on rows that never move.  The look-ups
have one row per group and quota and are written first, so their size is known.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanmark.session import lookup, stage

BUCKET_DIGITS = 3
# A bucket with more keys is divided by its next digits before it is ranked.
BUCKET_ROWS = 1_000_000
# Digits of an order key; no further division helps beyond them.
KEY_DIGITS = 32
_PLACE_BITS = 33  # of monotonically_increasing_id, within a partition


def cut_points(keyed: DataFrame, quotas: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The largest order key that is still inside each quota.

    ``keyed``: ``grp, order_key`` (hex, unique), read once per round, so stage it.
    ``quotas``: ``grp, slot, quota``.  Returns ``grp, slot, cut``; a quota of zero
    gets the empty string, which no key is below.
    """
    found = quotas.where("quota > 0").select(
        "grp", "slot", F.lit("").alias("bucket"), F.col("quota").alias("nth")
    )
    digits = 0
    while True:
        digits += BUCKET_DIGITS
        found = lookup(_narrowed(keyed, found, digits), "buckets")
        largest = found.agg(F.max("n")).first()[0] or 0
        if largest <= bucket_rows or digits >= KEY_DIGITS:
            break
    ranked = (
        keyed.withColumn("bucket", F.substring("order_key", 1, digits))
        .alias("k")
        .join(found.alias("b"), F.expr("k.grp <=> b.grp and k.bucket = b.bucket"))
        .select("b.grp", "b.slot", "b.nth", "k.order_key")
        .withColumn(
            "rank",
            F.row_number().over(Window.partitionBy("grp", "slot").orderBy("order_key")),
        )
    )
    cuts = ranked.where("rank = nth").select("grp", "slot", F.col("order_key").alias("cut"))
    none = quotas.where("quota = 0").select("grp", "slot", F.lit("").alias("cut"))
    return cuts.unionByName(none)


def _narrowed(keyed: DataFrame, found: DataFrame, digits: int) -> DataFrame:
    """``grp, slot, bucket, nth, n``: the bucket of ``digits`` digits that each cut falls into.

    ``found`` holds the buckets of the round before, and ``nth`` the place of the
    cut inside them; only their keys are counted.
    """
    members = keyed.select(
        "grp",
        F.substring("order_key", 1, digits - BUCKET_DIGITS).alias("outer"),
        F.substring("order_key", 1, digits).alias("bucket"),
    )
    if digits > BUCKET_DIGITS:
        members = members.alias("m").join(
            found.alias("f"), F.expr("m.grp <=> f.grp and m.outer = f.bucket"), "left_semi"
        )
    running = Window.partitionBy("grp", "outer").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    histogram = (
        members.groupBy("grp", "outer", "bucket")
        .agg(F.count("*").alias("n"))
        .withColumn("upto", F.sum("n").over(running))
    )
    return (
        histogram.alias("h")
        .join(
            found.alias("q"),
            F.expr(
                "h.grp <=> q.grp and h.outer = q.bucket and q.nth > h.upto - h.n and q.nth <= h.upto"
            ),
        )
        .select("q.grp", "q.slot", "h.bucket", F.expr("q.nth - (h.upto - h.n)").alias("nth"), "h.n")
    )


def dense_ids(names: DataFrame, name: str, out: str, ranges: int = 0) -> DataFrame:
    """``name, out``: the place from 0 of each row in the order of ``name``, which is distinct.

    Ranges are sorted apart; a place is the rows of the ranges before and the place
    within, so no window spans the table.
    """
    ranges = ranges or max(1, math.isqrt(names.count()) // 8)
    ordered = names.select(name).repartitionByRange(ranges, name).sortWithinPartitions(name)
    placed = stage(ordered.withColumn("_id", F.monotonically_increasing_id()), "ordered")
    placed = placed.withColumn("_range", F.shiftright("_id", _PLACE_BITS))
    sums = placed.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range.
    bases = lookup(sums.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")), "ranges")
    within = F.col("_id").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return placed.join(F.broadcast(bases), "_range").select(name, (F.col("_base") + within).alias(out))


def pick_exact(
    df: DataFrame, hashes: dict[str, Column], counts: dict[str, Column]
) -> DataFrame:
    """Flag exactly ``counts[name]`` rows per name, smallest hash first.

    Adds one boolean column per name.  All picks share one histogram pass.
    """
    names = list(hashes)
    keyed = stage(
        df.select(
            F.explode(
                F.array(*[F.struct(F.lit(n).alias("grp"), hashes[n].alias("order_key")) for n in names])
            ).alias("k")
        ).select("k.*"),
        "order-keys",
    )
    quotas = df.agg(
        F.array(
            *[
                F.struct(F.lit(n).alias("grp"), F.lit(0).alias("slot"), counts[n].alias("quota"))
                for n in names
            ]
        ).alias("q")
    ).select(F.inline("q"))
    cuts = cut_points(keyed, quotas)
    # One cut per name, a handful of strings: they become literals of the plan.
    cut = {r["grp"]: r["cut"] for r in cuts.collect()}
    return df.select("*", *[(hashes[n] <= F.lit(cut.get(n, ""))).alias(n) for n in names])

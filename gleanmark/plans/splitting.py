"""Split, check the split, and remove leakage."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanmark.functions.keys import content_key
from gleanmark.operators.leakage import overlap_counts, tag_leakage
from gleanmark.operators.split import (
    class_drift,
    conservation,
    missing_classes,
    stratified_split,
)
from gleanmark.session import lookup, stage

# A quarter is held out, 60% of it for testing; or 12% for validation.
THREE_WAY = [(0.25, "val"), (0.60, "test")]
TWO_WAY = [(0.12, "val")]
SPLITS = ["train", "val", "test"]


@dataclass
class CheckedSplit:
    rows: DataFrame
    checks: DataFrame


def split_checks(
    before: DataFrame, parts: DataFrame, text: str, label: str, splits: Sequence[str] = SPLITS
) -> DataFrame:
    """``check, subject, value, ok``: conservation, coverage, drift and overlap.

    Every check reads the staged label, split and content key; no text is written.
    """
    parts = stage(parts.select(label, "split", content_key(text, label).alias("_content")), "split-checks")
    sizes = conservation(before, parts).select(
        F.lit("conservation").alias("check"),
        F.lit("all").alias("subject"),
        F.col("n_split").cast("double").alias("value"),
        "ok",
    )
    lacking = (
        missing_classes(parts, label, "split", splits)
        .agg(F.count("*").alias("n"))
        .select(
            F.lit("missing_classes").alias("check"),
            F.lit("all").alias("subject"),
            F.col("n").cast("double").alias("value"),
            (F.col("n") == 0).alias("ok"),
        )
    )
    drift = class_drift(parts, label, "split", splits).select(
        F.lit("class_drift").alias("check"),
        F.col("split").alias("subject"),
        F.col("max_change").alias("value"),
        "ok",
    )
    overlap = overlap_counts(parts, ["_content"], "split", splits).select(
        F.lit("overlap").alias("check"),
        F.col("pair").alias("subject"),
        F.col("n_shared").cast("double").alias("value"),
        (F.col("n_shared") == 0).alias("ok"),
    )
    return sizes.unionByName(lacking).unionByName(drift).unionByName(overlap)


def split_and_check(
    df: DataFrame,
    text: str,
    label: str,
    row_id: str,
    rounds: Sequence[tuple[float, str]] = THREE_WAY,
    seed: int = 42,
) -> CheckedSplit:
    """Stratified split with all its checks.

    Hand in a table that is cheap to read again, such as a cleaned corpus, whose
    normalised texts are staged already: this job writes no text itself.
    """
    parts = stratified_split(df, label, row_id, rounds, seed=seed)
    splits = ["train", *[name for _, name in rounds]]
    return CheckedSplit(parts, split_checks(df, parts, text, label, splits))


def split_with_pinned_test(
    train: DataFrame,
    test: DataFrame,
    label: str,
    row_id: str,
    rounds: Sequence[tuple[float, str]] = TWO_WAY,
    seed: int = 42,
) -> DataFrame:
    """Divide the training rows only; the test rows pass through untouched."""
    parts = stratified_split(train, label, row_id, rounds, seed=seed)
    return parts.unionByName(test.withColumn("split", F.lit("test")))


def leakage_log(
    tagged: DataFrame, split: str = "split", priority: Sequence[str] = ("test", "val", "train")
) -> DataFrame:
    """``split, step, rows_before, rows_after, dropped`` over ``tag_leakage`` output.

    A weaker split yields to the next stronger one first, so a row held by both
    counts there.
    """
    cells = []
    for yields in reversed(range(1, len(priority))):
        mine = F.col(split) == priority[yields]
        before = F.count_if(mine)
        for wins in reversed(range(yields)):
            hit = F.count_if(mine & (F.col("leaks_into") == priority[wins]))
            cells.append(
                F.struct(
                    F.lit(priority[yields]).alias("split"),
                    F.lit(f"drop_leakage_vs_{priority[wins]}").alias("step"),
                    before.alias("rows_before"),
                    (before - hit).alias("rows_after"),
                    hit.alias("dropped"),
                )
            )
            before = before - hit
    return tagged.agg(F.array(*cells).alias("r")).select(F.inline("r"))


@dataclass
class LeakFree:
    rows: DataFrame
    log: DataFrame
    overlap_after: DataFrame


def remove_leakage(
    df: DataFrame,
    keys: Sequence[str],
    split: str = "split",
    priority: Sequence[str] = ("test", "val", "train"),
) -> LeakFree:
    """Drop leaked rows, account for them, and count the overlap that is left.

    The tags are written once, as all three results read them.
    """
    tagged = stage(tag_leakage(df, keys, split, priority), "leakage")
    rows = tagged.where("leaks_into is null").drop("leaks_into")
    return LeakFree(
        rows,
        leakage_log(tagged, split, priority),
        overlap_counts(rows, keys, split, list(reversed(priority))),
    )


@dataclass
class Settled:
    rows: DataFrame
    log: DataFrame
    overlap_before: DataFrame
    overlap_after: DataFrame


def settle_copies(
    df: DataFrame,
    keys: Sequence[str],
    row_id: str,
    split: str = "split",
    priority: Sequence[str] = ("test", "val", "train"),
) -> Settled:
    """First row of each key in a split, then leakage removal, with log and overlaps, from one shuffle.

    One grouped aggregate, combined on the map side, writes for each content key how
    often each split holds it and its first row there.  Which row stays, what each step
    drops and what splits share all follow from that table; the rows meet it again in a
    join on the few keys with copies.  A layout of the rows themselves by key would give
    a hot key to one task; here it is one row per task that reads it.
    """
    n = len(priority)
    place = {s: i for i, s in enumerate(priority)}
    mine = lambda i: F.col(split) == priority[i]
    summary = df.groupBy(content_key(*keys).alias("_key")).agg(
        *[F.count_if(mine(i)).alias(f"_n{i}") for i in range(n)],
        *[F.min(F.when(mine(i), F.col(row_id))).alias(f"_first{i}") for i in range(n)],
    )
    summary = stage(summary, "copies")
    held = lambda i: F.col(f"_n{i}") > 0

    # A key stays in the strongest split that holds it, with its first row there.
    copies = sum((F.col(f"_n{i}") for i in range(1, n)), F.col("_n0"))
    repeated = lookup(summary.where(copies > 1), "repeated")
    strongest = F.coalesce(*[F.when(held(i), F.lit(i)) for i in range(n)])
    first = F.coalesce(*[F.when(held(i), F.col(f"_first{i}")) for i in range(n)])
    own = F.coalesce(*[F.when(mine(i), F.lit(i)) for i in range(n)])
    stays = F.col("_n0").isNull() | ((own == strongest) & (F.col(row_id) == first))
    rows = df.withColumn("_key", content_key(*keys)).join(repeated, "_key", "left").where(stays).select(*df.columns)

    cells, before = [], {}
    for s in reversed(priority):
        i = place[s]
        before[i] = F.sum(f"_n{i}")
        again = F.sum(F.greatest(F.col(f"_n{i}") - 1, F.lit(0)))
        cells.append((s, "dedup_keys", before[i], again))
        before[i] = before[i] - again
    for yields in reversed(range(1, n)):
        for wins in reversed(range(yields)):
            # The weakest of the stronger splits counts, as it comes first.
            between = F.lit(False)
            for j in range(wins + 1, yields):
                between = between | held(j)
            hit = F.count_if(held(yields) & held(wins) & ~between)
            cells.append((priority[yields], f"drop_leakage_vs_{priority[wins]}", before[yields], hit))
            before[yields] = before[yields] - hit
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    log = summary.agg(
        F.array(
            *[
                F.struct(
                    F.lit(s).alias("split"), F.lit(step).alias("step"), zero(b).alias("rows_before"),
                    (zero(b) - zero(d)).alias("rows_after"), zero(d).alias("dropped"),
                )
                for s, step, b, d in cells
            ]
        ).alias("r")
    ).select(F.inline("r"))

    pairs = [(priority[b], priority[a], held(a) & held(b)) for b in reversed(range(n)) for a in reversed(range(b))]
    shared = summary.agg(
        F.array(*[F.struct(F.lit(f"{x}-{y}").alias("pair"), F.count_if(both).alias("n_shared")) for x, y, both in pairs]).alias("r")
    ).select(F.inline("r"))
    return Settled(rows, log, shared, overlap_counts(rows, keys, split, list(reversed(priority))))

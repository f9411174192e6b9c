"""Label distributions, text lengths, histograms and label-hierarchy checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanmark.functions import text as tx
from gleanmark.functions.labels import round4

# Fixed values
PERCENTILES = {"p50": 0.50, "p90": 0.90, "p95": 0.95, "p99": 0.99}
TOKENS_PER_WORD = 1.3
MIN_ROWS_FOR_SPLIT = 9


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """``label, n``, nulls left out."""
    return df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))


def class_fractions(df: DataFrame, label: str) -> DataFrame:
    return fractions_of(class_counts(df, label), label)


def fractions_of(counts: DataFrame, label: str) -> DataFrame:
    total = F.sum("n").over(Window.partitionBy())
    return counts.select(label, "n", F.round(F.col("n") / total, 6).alias("fraction"))


def top_classes(df: DataFrame, label: str, k: int, smallest: bool = False) -> DataFrame:
    """The ``k`` most (or least) frequent classes; ties by name."""
    order = F.asc("n") if smallest else F.desc("n")
    return class_counts(df, label).orderBy(order, label).limit(k)


def imbalance(df: DataFrame, label: str) -> DataFrame:
    """One row: classes, least and greatest count, and their ratio (denominator at least 1)."""
    return imbalance_of(class_counts(df, label))


def imbalance_of(counts: DataFrame) -> DataFrame:
    return counts.agg(
        F.count("*").alias("n_classes"),
        F.min("n").alias("min_n"),
        F.max("n").alias("max_n"),
        F.round(F.max("n") / F.greatest(F.min("n"), F.lit(1)), 2).alias("ratio"),
    )


def class_count_stats(df: DataFrame, label: str) -> DataFrame:
    """One row over the class counts: number, mean, sample deviation, median, min, max."""
    return count_stats_of(class_counts(df, label))


def count_stats_of(counts: DataFrame) -> DataFrame:
    return counts.agg(
        F.count("*").alias("n_classes"),
        round4(F.avg("n")).alias("mean"),
        round4(F.stddev_samp("n")).alias("std"),
        round4(F.percentile("n", 0.5)).alias("median"),
        F.min("n").alias("min"),
        F.max("n").alias("max"),
    )


def split_feasibility(
    df: DataFrame, label: str, fraction: float = 0.12, least: int = MIN_ROWS_FOR_SPLIT
) -> DataFrame:
    """Classes too small to reach the held-out part, and the rarest class's expected share."""
    return feasibility_of(class_counts(df, label), fraction, least)


def feasibility_of(counts: DataFrame, fraction: float = 0.12, least: int = MIN_ROWS_FOR_SPLIT) -> DataFrame:
    return counts.agg(
        F.count("*").alias("n_classes"),
        F.count_if(F.col("n") < least).alias("n_too_small"),
        F.min("n").alias("min_n"),
        F.round(F.min("n") * F.lit(fraction), 2).alias("expected_of_rarest"),
        (F.count_if(F.col("n") < least) == 0).alias("feasible"),
    )


def classes_below(df: DataFrame, label: str, least: int) -> DataFrame:
    return class_counts(df, label).where(F.col("n") < least)


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Counts of ``row`` by ``column``, zero where a pair is absent.

    ``other`` counts the rows whose value is null or not among ``values``.
    """
    listed = F.coalesce(F.col(column).isin(list(values)), F.lit(False))
    counts = [F.count_if(listed & (F.col(column) == v)).alias(v) for v in values]
    return df.groupBy(row).agg(*counts, F.count_if(~listed).alias("other"))


def parents_of(df: DataFrame, label: str, parent: str) -> DataFrame:
    """``label, n_parents, parents`` with the sorted parents joined by a comma."""
    pairs = df.where(F.col(label).isNotNull()).groupBy(label, parent).agg(F.count("*").alias("_n"))
    found = F.array_sort(F.collect_set(parent))
    return pairs.groupBy(label).agg(
        F.count(parent).alias("n_parents"), F.array_join(found, ",").alias("parents")
    )


def hierarchy_violations(df: DataFrame, label: str, parent: str) -> DataFrame:
    """Labels that occur under more than one parent."""
    return parents_of(df, label, parent).where("n_parents > 1")


def length_histogram(df: DataFrame, lengths: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """``(*by, measure, length, n)``: how many texts have each length.

    The number of distinct lengths is bounded by the longest text, so exact
    statistics over this table stay small however many rows there are.
    """
    cells = F.array(*[F.struct(F.lit(m).alias("measure"), c.cast("long").alias("length")) for m, c in lengths.items()])
    return df.select(*by, F.inline(cells)).groupBy(*by, "measure", "length").agg(F.count("*").alias("n"))


def text_lengths(text: str, prefix: str = "") -> dict[str, Column]:
    t = tx.as_text(text)
    return {f"{prefix}chars": F.char_length(t), f"{prefix}words": tx.word_count(t)}


def length_profile(df: DataFrame, lengths: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Per measure: count, mean, sample deviation, min, p50, p90, p95, p99, max.

    Exact (linear interpolation), from the length histogram.
    """
    return profile_of_histogram(length_histogram(df, lengths, by), by)


def profile_of_histogram(histogram: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The same from ``(*by, measure, length, n)``."""
    n = F.sum("n")
    total = F.sum(F.col("n") * F.col("length"))
    squares = F.sum((F.col("n") * F.col("length") * F.col("length")).cast("decimal(38,0)"))
    # n * sum of squares - square of the sum, exact until the one division.
    wide = total.cast("decimal(19,0)")
    spread = (squares * n.cast("decimal(19,0)") - wide * wide).cast("double")
    variance = spread / n / F.nullif(n - 1, F.lit(0))
    marks = F.percentile("length", list(PERCENTILES.values()), F.col("n"))
    stats = (
        histogram.groupBy(*by, "measure")
        .agg(
            n.alias("count"),
            round4(total / n).alias("mean"),
            round4(F.sqrt(variance)).alias("std"),
            F.min("length").alias("min"),
            marks.alias("_marks"),
            F.max("length").alias("max"),
        )
    )
    named = [round4(F.col("_marks")[i]).alias(p) for i, p in enumerate(PERCENTILES)]
    return stats.select(*by, "measure", "count", "mean", "std", "min", *named, "max")


def token_budget(profile: DataFrame, factor: float = TOKENS_PER_WORD) -> DataFrame:
    """Estimated model tokens at p95, p99 and max of the word counts."""
    return profile.where("measure like '%words'").select(
        "measure",
        *[F.round(F.col(p) * F.lit(factor), 1).alias(f"tokens_{p}") for p in ("p95", "p99", "max")],
    )


def fixed_bin_histogram(
    df: DataFrame, lengths: dict[str, Column], bins: int, by: Sequence[str] = ()
) -> DataFrame:
    """``bins`` equal bins over the range all groups share, per measure.

    ``(*by, measure, bin, n, density)``; bins count from 1, the last one includes
    the maximum, and empty bins are left out.
    """
    return bins_of_histogram(length_histogram(df, lengths, by), bins, by)


def bins_of_histogram(exact: DataFrame, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """The same from ``(*by, measure, length, n)``."""
    low = F.min("length").over(Window.partitionBy("measure"))
    high = F.max("length").over(Window.partitionBy("measure"))
    group = Window.partitionBy(*by, "measure")
    width = (F.col("high") - F.col("low")) / F.lit(bins)
    binned = (
        exact.withColumn("low", low)
        .withColumn("high", high)
        .withColumn(
            "bin",
            F.when(F.col("high") == F.col("low"), F.lit(1)).otherwise(
                F.least(
                    F.floor((F.col("length") - F.col("low")) * bins / (F.col("high") - F.col("low"))) + 1,
                    F.lit(bins),
                )
            ),
        )
        .groupBy(*by, "measure", "bin", "low", "high")
        .agg(F.sum("n").alias("n"))
    )
    share = F.col("n") / F.sum("n").over(group)
    return binned.select(
        *by,
        "measure",
        F.col("bin").cast("long").alias("bin"),
        "n",
        F.round(share / F.when(width > 0, width).otherwise(1.0), 8).alias("density"),
    )


def tag_values(df: DataFrame, tags: str, k: int = 20) -> DataFrame:
    """The ``k`` most frequent raw tag strings; ties by value."""
    return (
        df.groupBy(tx.as_text(tags).alias("tags"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "tags")
        .limit(k)
    )


def empty_tags(df: DataFrame, tags: str) -> DataFrame:
    t = tx.as_text(tags)
    return df.agg(F.count_if(t == "").alias("n_empty"), F.count_distinct(t).alias("n_distinct"))


def tag_letters(df: DataFrame, tags: str) -> DataFrame:
    """How often each letter occurs over all tag strings.

    Equal strings are counted first, so the letters of a repeated tag string are
    unfolded once.
    """
    strings = df.groupBy(tx.as_text(tags).alias("_t")).agg(F.count("*").alias("_n"))
    return (
        strings.select(F.explode(tx.characters("_t")).alias("letter"), "_n")
        .groupBy("letter")
        .agg(F.sum("_n").alias("n"))
    )


def contrast(sides: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Eleven metrics side by side: ``metric`` and one column per corpus.

    ``sides`` maps a name to ``(table, text column, label column)``.
    """
    long = None
    for name, (df, text, label) in sides.items():
        lengths = length_profile(df, text_lengths(text))
        cells = [
            F.struct(
                F.concat(F.rtrim(F.col("measure"), F.lit("s")), F.lit(f"_{p}")).alias("metric"),
                F.floor(p).cast("double").alias("value"),
            )
            for p in ("p50", "p95", "p99", "max")
        ]
        counts = class_counts(df, label).agg(
            F.count("*").alias("n_classes"),
            F.round(F.max("n") / F.greatest(F.min("n"), F.lit(1)), 2).alias("imbalance_ratio"),
        )
        head = counts.select(
            F.inline(
                F.array(
                    F.struct(F.lit("n_classes").alias("metric"), F.col("n_classes").cast("double").alias("value")),
                    F.struct(F.lit("imbalance_ratio").alias("metric"), F.col("imbalance_ratio").alias("value")),
                )
            )
        )
        rows = df.agg(F.count("*").cast("double").alias("value")).select(F.lit("n_rows").alias("metric"), "value")
        side = rows.unionByName(head).unionByName(lengths.select(F.inline(F.array(*cells))))
        side = side.withColumn("corpus", F.lit(name))
        long = side if long is None else long.unionByName(side)
    return long.groupBy("metric").pivot("corpus", list(sides)).agg(F.max("value"))


def inspect(df: DataFrame, condition: Column, row_id: str, text: str, k: int = 3) -> DataFrame:
    """The first ``k`` rows that meet a condition, in row order."""
    return df.where(condition).orderBy(row_id).limit(k).select(row_id, text)


def first_per_split(df: DataFrame, split: str, row_id: str, n: int) -> DataFrame:
    """The first ``n`` rows of each split; each task keeps at most ``n`` per split."""
    rank = F.row_number().over(Window.partitionBy(split).orderBy(row_id))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")

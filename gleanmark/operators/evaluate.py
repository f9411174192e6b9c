"""Classifier metrics, all derived from one confusion aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanmark.functions.labels import PARSE_ERROR, round4

SCALARS = ["accuracy", "macro_f1", "macro_precision", "macro_recall", "weighted_f1"]


def confusion(df: DataFrame, true: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, true_label, predicted_label, n)``; at most labels squared rows."""
    return df.groupBy(
        *by, F.col(true).alias("true_label"), F.col(pred).alias("predicted_label")
    ).agg(F.count("*").alias("n"))


# --- label policies -----------------------------------------------------------


def observed_labels(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Labels seen as gold or as prediction."""
    return (
        counts.select(*by, F.explode(F.array("true_label", "predicted_label")).alias("label"))
        .where("label is not null")
        .distinct()
    )


def labels_with_parse_error(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """A fixed list, plus the parse-error sentinel when it was predicted."""
    extra = (
        counts.where(F.col("predicted_label") == PARSE_ERROR)
        .select(F.col("predicted_label").alias("label"))
        .distinct()
    )
    return labels.select("label").unionByName(extra).distinct()


# --- metrics ------------------------------------------------------------------


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def _class_cells(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """``(*by, label, tp, support, predicted)``.

    Every confusion cell gives one entry to its gold label and one to its
    prediction, so one aggregate yields row sums, column sums and the diagonal.
    """
    hit = F.col("true_label").eqNullSafe(F.col("predicted_label"))
    zero = F.lit(0).cast("long")
    entries = F.array(
        F.struct(
            F.col("true_label").alias("label"),
            F.when(hit, F.col("n")).otherwise(zero).alias("tp"),
            F.col("n").alias("support"),
            zero.alias("predicted"),
        ),
        F.struct(
            F.col("predicted_label").alias("label"),
            zero.alias("tp"),
            zero.alias("support"),
            F.col("n").alias("predicted"),
        ),
    )
    return (
        counts.select(*by, F.inline(entries))
        .groupBy(*by, "label")
        .agg(*[F.sum(c).alias(c) for c in ("tp", "support", "predicted")])
    )


def _exact_per_class(counts: DataFrame, labels: DataFrame, by: Sequence[str]) -> DataFrame:
    spine = labels.select(*[c for c in by if c in labels.columns], "label")
    cells = _class_cells(counts, by)
    if by and not set(by) <= set(spine.columns):
        # A label list shared by all groups: one entry per group that has rows.
        groups = counts.select(*by).distinct()
        names = spine.agg(F.collect_list("label").alias("_l")).scalar()
        spine = groups.withColumn("label", F.explode(names))
    zero = F.lit(0).cast("long")
    joined = spine.join(cells, [*by, "label"], "left").select(
        *by, "label", *[F.coalesce(c, zero).alias(c) for c in ("tp", "support", "predicted")]
    )
    precision = _ratio(F.col("tp"), F.col("predicted"))
    recall = _ratio(F.col("tp"), F.col("support"))
    f1 = _ratio(2.0 * F.col("tp"), F.col("predicted") + F.col("support"))
    return joined.withColumns({"precision": precision, "recall": recall, "f1": f1})


def per_class(counts: DataFrame, labels: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, label, precision, recall, f1, support)`` rounded to four digits.

    A zero denominator gives zero.  ``labels`` decides which classes appear.
    """
    return _exact_per_class(counts, labels, by).select(
        *by, "label", *[round4(c).alias(c) for c in ("precision", "recall", "f1")], "support"
    )


def overall(counts: DataFrame, labels: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy over all rows; macro and weighted averages over ``labels``."""
    hit = F.col("true_label").eqNullSafe(F.col("predicted_label"))
    accuracy = counts.groupBy(*by).agg(
        F.sum("n").alias("n_rows"),
        (F.sum(F.when(hit, F.col("n")).otherwise(0)) / F.sum("n")).alias("accuracy"),
    )
    averages = _exact_per_class(counts, labels, by).groupBy(*by).agg(
        F.avg("f1").alias("macro_f1"),
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        _ratio(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("weighted_f1"),
    )
    if by:
        both = accuracy.join(averages, list(by))
    else:
        one = averages.select(F.struct(*averages.columns).alias("a")).scalar()
        both = accuracy.withColumn("_a", one).select("*", "_a.*")
    return both.select(*by, "n_rows", *[round4(c).alias(c) for c in SCALARS])


def normalised_confusion(counts: DataFrame, labels: DataFrame) -> DataFrame:
    """``true_label, predicted_label, n, share`` over the full grid of ``labels``.

    Cells without rows have 0, and so does a row without any.  The grid is built
    per gold label from the label list, which is a vocabulary.
    """
    names = labels.agg(F.collect_list("label").alias("_l")).scalar()
    grid = labels.select(F.col("label").alias("true_label"), F.explode(names).alias("predicted_label"))
    row = F.sum("n").over(Window.partitionBy("true_label"))
    return (
        grid.join(counts, ["true_label", "predicted_label"], "left")
        .select("true_label", "predicted_label", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
        .withColumn("share", round4(_ratio(F.col("n"), row)))
    )


def error_rows(df: DataFrame, true: str, pred: str, text: str) -> DataFrame:
    """Rows whose prediction differs from the gold label, with the text length."""
    return df.where(~F.col(true).eqNullSafe(F.col(pred))).withColumn("text_length", F.char_length(text))


def argmax_label(scores: str | Column) -> Column:
    """Position of the first greatest score, from 0."""
    s = F.col(scores) if isinstance(scores, str) else scores
    return (F.array_position(s, F.array_max(s)) - 1).cast("int")


def side_by_side(metrics: DataFrame, split: str, splits: Sequence[str]) -> DataFrame:
    """``metric`` and one column per split."""
    long = metrics.unpivot([split], SCALARS, "metric", "value")
    return long.groupBy("metric").pivot(split, list(splits)).agg(F.max("value"))


def weakest_classes(classes: DataFrame, k: int = 10) -> DataFrame:
    return classes.orderBy("f1", "label").limit(k)


def duration_summary(
    df: DataFrame, value: str, order: str, warmup: int, samples: int, by: Sequence[str] = ()
) -> DataFrame:
    """Percentiles, mean, population deviation and throughput of timed calls.

    Skips the first ``warmup`` rows of each group and reads at most ``samples``
    more; each task passes on at most that many rows per group.
    """
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(order))
    timed = (
        df.select(*by, order, F.col(value).cast("double").alias("_ms"))
        .withColumn("_rank", rank)
        .where(F.col("_rank") <= warmup + samples)
        .where(F.col("_rank") > warmup)
    )
    marks = F.percentile("_ms", [0.5, 0.95, 0.99])
    mean = F.col("_mean")
    slowest = F.when(mean < 1e-9, F.lit(1e-9)).otherwise(mean)
    return (
        timed.groupBy(*by)
        .agg(
            marks.alias("_m"),
            F.avg("_ms").alias("_mean"),
            F.stddev_pop("_ms").alias("_std"),
            F.count("*").alias("n_samples"),
        )
        .select(
            *by,
            *[round4(F.col("_m")[i]).alias(n) for i, n in enumerate(("p50_ms", "p95_ms", "p99_ms"))],
            round4(mean).alias("mean_ms"),
            round4("_std").alias("std_ms"),
            round4(F.lit(1000.0) / slowest).alias("throughput_per_sec"),
            "n_samples",
        )
    )

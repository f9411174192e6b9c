"""Whole-corpus profiles and summaries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanmark.functions import text as tx
from gleanmark.functions.keys import content_key
from gleanmark.functions.labels import round4
from gleanmark.operators import audit as au
from gleanmark.operators import profile as pf
from gleanmark.operators.split import split_sizes
from gleanmark.session import stage


# The kinds of cells.
ROWS, NULL, FLAG = "rows", "null", "flag"
KEYS = {"duplicate_rows": "row", "duplicate_text_label": "pair", "duplicate_text": "text"}
LABEL, CLASS, TAGS = "label", "class", "tags"
LENGTHS = ["chars", "words"]
BINS = 60


def _flags(text: str) -> dict[str, Column]:
    """Conditions on a text that a profile counts, by counter."""
    t = tx.as_text(text)
    return {
        "blank_text": tx.is_blank(t),
        "edge_whitespace": tx.has_edge_whitespace(t),
        "leading": tx.has_leading_whitespace(t),
        "trailing": tx.has_trailing_whitespace(t),
        "multi_space": tx.has_multi_space(t),
        "has_tab": tx.has_tab(t),
        "has_newline": tx.has_newline(t),
        "non_ascii": tx.has_non_ascii(t),
        "mojibake": tx.has_mojibake(t),
        "very_short": tx.shorter_than(t, au.SHORT_CHARS),
        "very_long": tx.exceeds(t, au.LONG_CHARS),
    }


def profile_cells(df: DataFrame, text: str, label: str, parent: str | None = None, tags: str | None = None) -> DataFrame:
    """``kind, a, b, n``: all that a profile counts, from one scan and one aggregate.

    A row gives a cell to every counter it adds to: its nulls, the conditions its text
    meets, its label and parent, its lengths, its tags, and a key of each group of
    columns whose repeats are counted.  Equal cells are counted, on the map side first,
    so a hot label or text is one row per task.  Counters that no row adds to are there
    with zero.
    """
    cell = lambda kind, a=None, b=None: F.struct(
        F.lit(kind).alias("kind"),
        (F.lit(None) if a is None else a).cast("string").alias("a"),
        (F.lit(None) if b is None else b).cast("string").alias("b"),
    )
    any_null = F.lit(False)
    for c in df.columns:
        any_null = any_null | F.col(c).isNull()
    nulls = {**{c: F.col(c).isNull() for c in df.columns}, "(any)": any_null}
    flags = _flags(text)
    key = lambda *cols: F.base64(content_key(*cols))
    given = [
        cell(ROWS),
        *[F.when(hit, cell(NULL, F.lit(name))) for name, hit in nulls.items()],
        *[F.when(hit, cell(FLAG, F.lit(name))) for name, hit in flags.items()],
        cell("row", key(*df.columns)),
        cell("pair", key(text, label)),
        cell("text", key(text)),
        F.when(F.col(label).isNotNull(), cell(LABEL, F.col(label))),
        *[cell(m, length) for m, length in pf.text_lengths(text).items()],
    ]
    if parent:
        given.append(F.when(F.col(label).isNotNull(), cell(CLASS, F.col(label), F.col(parent))))
    if tags:
        given.append(cell(TAGS, tx.as_text(tags)))
    held = df.select(F.inline(F.filter(F.array(*given), lambda c: c.isNotNull())), F.lit(1).alias("n"))
    zeros = [(ROWS, None, None, 0), *[(NULL, c, None, 0) for c in nulls], *[(FLAG, c, None, 0) for c in flags]]
    spine = df.sparkSession.createDataFrame(zeros, "kind string, a string, b string, n int")
    return stage(held.unionByName(spine).groupBy("kind", "a", "b").agg(F.sum("n").alias("n")), "cells")


@dataclass
class Profile:
    cells: DataFrame
    nulls: DataFrame
    audit: DataFrame
    whitespace: DataFrame
    damage: DataFrame
    classes: DataFrame
    fractions: DataFrame
    class_stats: DataFrame
    imbalance: DataFrame
    feasibility: DataFrame
    crosstab: DataFrame
    parents: DataFrame
    lengths: DataFrame
    histogram: DataFrame
    token_budget: DataFrame
    tags: DataFrame
    letters: DataFrame


def profile(df: DataFrame, text: str, label: str, parent: str | None = None, tags: str | None = None, bins: int = BINS) -> Profile:
    """Everything an exploration of a corpus reports, as tables over cells counted once.

    Without ``parent`` or ``tags`` their tables are empty.
    """
    cells = profile_cells(df, text, label, parent, tags)
    of = lambda *kinds: cells.where(F.col("kind").isin(*kinds))
    marks = of(FLAG).select(F.col("a").alias("metric"), F.col("n").alias("value"))
    repeats = of(*KEYS.values()).groupBy("kind").agg(F.sum(F.col("n") - 1).alias("value"))
    names = F.create_map(*[F.lit(x) for metric, kind in KEYS.items() for x in (kind, metric)])
    counts = of(LABEL).select(F.col("a").alias(label), "n")
    pairs = of(CLASS).select(F.col("a").alias("label"), F.col("b").alias("parent"), "n")
    lengths = of(*LENGTHS).select(F.col("kind").alias("measure"), F.col("a").cast("long").alias("length"), "n")
    strings = of(TAGS).select(F.col("a").alias("tags"), "n")
    measured = pf.profile_of_histogram(lengths)
    audit = (
        of(ROWS).select(F.lit("n_rows").alias("metric"), F.col("n").alias("value"))
        .unionByName(marks.where(~F.col("metric").isin("leading", "trailing")))
        .unionByName(repeats.select(names[F.col("kind")].alias("metric"), "value"))
        .unionByName(of(NULL).where(F.col("a").isin(text, label)).select(F.when(F.col("a") == text, "null_text").otherwise("null_label").alias("metric"), F.col("n").alias("value")))
    )
    return Profile(
        cells,
        of(NULL).select(F.col("a").alias("column"), F.col("n").alias("nulls")),
        audit,
        marks.where(F.col("metric").isin("leading", "trailing", "multi_space", "has_tab", "has_newline")),
        marks.where(F.col("metric").isin("blank_text", "non_ascii", "mojibake")),
        counts,
        pf.fractions_of(counts, label),
        pf.count_stats_of(counts),
        pf.imbalance_of(counts),
        pf.feasibility_of(counts),
        pairs,
        pairs.groupBy("label").agg(F.count("parent").alias("n_parents")),
        measured,
        pf.bins_of_histogram(lengths, bins),
        pf.token_budget(measured),
        strings,
        strings.select(F.explode(tx.characters("tags")).alias("letter"), "n").groupBy("letter").agg(F.sum("n").alias("n")),
    )


def profile_facts(cells: DataFrame, bins: int = BINS) -> DataFrame:
    """``fact, value``: every fact of a profile, from two scans of its cells.

    One aggregate with a row per kind gives the counts, repeats and statistics; one
    with a row per item the fractions, parents, bins and letters.
    """
    named = {**{kind: metric for metric, kind in KEYS.items()}}
    size, n = F.col("a").try_cast("long"), F.col("n")
    rows = F.sum("n")
    spread = F.sum(n * size * size).cast("decimal(38,0)") * rows.cast("decimal(19,0)") - F.sum(n * size).cast("decimal(19,0)") * F.sum(n * size).cast("decimal(19,0)")
    marks = F.percentile(size, list(pf.PERCENTILES.values()), n)
    per_kind = cells.where(~F.col("kind").isin(NULL, FLAG)).groupBy("kind").agg(
        rows.alias("rows"), F.count("*").alias("distinct"), F.sum(n - 1).alias("repeats"),
        F.avg("n").alias("avg_n"), F.stddev_samp("n").alias("std_n"), F.percentile("n", 0.5).alias("median_n"),
        F.min("n").alias("min_n"), F.max("n").alias("max_n"), F.count_if(n < pf.MIN_ROWS_FOR_SPLIT).alias("too_small"),
        (F.sum(n * size) / rows).alias("mean"), F.sqrt(spread.cast("double") / rows / F.nullif(rows - 1, F.lit(0))).alias("std"),
        F.min(size).alias("least"), marks.alias("marks"), F.max(size).alias("most"),
        F.sum(F.when(F.col("a") == "", n).otherwise(0)).alias("empty"),
    )
    fact = lambda name, value: F.struct((name if isinstance(name, Column) else F.lit(name)).alias("fact"), value.cast("double").alias("value"))
    kind = F.col("kind")
    repeats = F.create_map(*[F.lit(x) for pair in named.items() for x in pair])
    of_lengths = [
        ("count", F.col("rows")), ("mean", round4("mean")), ("std", round4("std")), ("min", F.col("least")),
        *[(p, round4(F.col("marks")[i])) for i, p in enumerate(pf.PERCENTILES)], ("max", F.col("most")),
    ]
    budget = [(f"tokens_{p}", F.round(value * F.lit(pf.TOKENS_PER_WORD), 1)) for p, value in of_lengths if p in ("p95", "p99", "max")]
    of_labels = [
        ("n_classes", F.col("distinct")), ("mean", round4("avg_n")), ("std", round4("std_n")), ("median", round4("median_n")),
        ("min", F.col("min_n")), ("max", F.col("max_n")), ("ratio", F.round(F.col("max_n") / F.greatest("min_n", F.lit(1)), 2)),
        ("n_too_small", F.col("too_small")), ("expected_of_rarest", F.round(F.col("min_n") * F.lit(0.12), 2)),
    ]
    listed = (
        F.when(kind == ROWS, F.array(fact("n_rows", F.col("rows"))))
        .when(kind.isin(*named), F.array(fact(repeats[kind], F.col("repeats"))))
        .when(kind == LABEL, F.array(*[fact(f"classes.{x}", v) for x, v in of_labels]))
        .when(kind == "chars", F.array(*[fact(f"chars.{x}", v) for x, v in of_lengths]))
        .when(kind == "words", F.array(*[fact(f"words.{x}", v) for x, v in of_lengths + budget]))
        .when(kind == TAGS, F.array(fact("tags.n_distinct", F.col("distinct")), fact("tags.n_empty", F.col("empty"))))
    )
    scalars = per_kind.select(F.inline(listed))

    within = Window.partitionBy("kind")
    low, high = F.min(size).over(within), F.max(size).over(within)
    place = F.when(high == low, F.lit(1)).otherwise(F.least(F.floor((size - low) * bins / (high - low)) + 1, F.lit(bins)))
    item = lambda kind, name, weight: F.struct(F.lit(kind).alias("kind"), name.cast("string").alias("name"), weight.cast("long").alias("weight"))
    items = cells.where(~F.col("kind").isin(ROWS, *named)).withColumn("bin", F.when(kind.isin(*LENGTHS), place.cast("long")))
    letters = F.transform(tx.characters("a"), lambda x: item("letter", x, F.col("n")))
    unfolded = (
        F.when(kind == CLASS, F.array(item("class", F.concat_ws("|", "a", "b"), n), item("parents", F.col("a"), F.col("b").isNotNull().cast("int"))))
        .when(kind == TAGS, F.concat(F.array(item("tags", F.col("a"), n)), letters))
        .when(kind == LABEL, F.array(item("label", F.col("a"), n)))
        .when(kind == NULL, F.array(item("null", F.col("a"), n)))
        .when(kind == FLAG, F.array(item("flag", F.col("a"), n)))
        .when(kind == "chars", F.array(item("chars.bin", F.col("bin"), n)))
        .when(kind == "words", F.array(item("words.bin", F.col("bin"), n)))
    )
    counted = items.select(F.inline(unfolded)).groupBy("kind", "name").agg(F.sum("weight").alias("n"))
    share = F.round(n / F.sum("n").over(Window.partitionBy("kind")), 6)
    shared = F.col("kind").isin("label", "chars.bin", "words.bin")
    full = F.concat_ws(".", "kind", "name")
    both = F.array(fact(full, n), F.when(shared, fact(F.concat(full, F.lit(".fraction")), share)))
    return scalars.unionByName(counted.withColumn("_s", F.filter(both, lambda x: x.isNotNull())).select(F.inline("_s")))


def corpus_summary(df: DataFrame, text: str, label: str, split: str = "split") -> DataFrame:
    """``metric, value``: text lengths, class counts and split sizes of one corpus."""

    def long(table: DataFrame, prefix, columns) -> DataFrame:
        cells = [
            F.struct(F.concat(prefix, F.lit(f".{c}")).alias("metric"), F.col(c).cast("double").alias("value"))
            for c in columns
        ]
        return table.select(F.inline(F.array(*cells)))

    lengths = long(
        pf.length_profile(df, pf.text_lengths(text)),
        F.col("measure"),
        ["count", "mean", "std", "p50", "p90", "p95", "p99", "max"],
    )
    classes = long(
        pf.class_count_stats(df, label),
        F.lit("classes"),
        ["n_classes", "mean", "std", "median", "min", "max"],
    )
    sizes = long(split_sizes(df, split), F.concat(F.lit("split."), F.col(split)), ["n", "fraction"])
    return lengths.unionByName(classes).unionByName(sizes)

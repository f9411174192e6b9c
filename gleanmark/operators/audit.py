"""Corpus audits: every counter of a report in one grouped pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanmark.functions import text as tx
from gleanmark.functions.keys import content_key
from gleanmark.operators.dedup import duplicates_beyond_first
from gleanmark.session import stage

# Length limits of the audits.
SHORT_CHARS = 10
LONG_CHARS = 300
INSTRUCTION_CAP = 500
RESPONSE_CAP = 3000


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def flat_counters(text: str, label: str, all_columns: Sequence[str]) -> dict[str, Column]:
    """The fifteen counters of a corpus with one text and one label column."""
    t = tx.as_text(text)
    return {
        "n_rows": F.count("*"),
        "null_text": count_where(F.col(text).isNull()),
        "null_label": count_where(F.col(label).isNull()),
        "blank_text": count_where(tx.is_blank(t)),
        "duplicate_rows": duplicates_beyond_first(*all_columns),
        "duplicate_text_label": duplicates_beyond_first(text, label),
        "duplicate_text": duplicates_beyond_first(text),
        "edge_whitespace": count_where(tx.has_edge_whitespace(t)),
        "multi_space": count_where(tx.has_multi_space(t)),
        "has_tab": count_where(tx.has_tab(t)),
        "has_newline": count_where(tx.has_newline(t)),
        "non_ascii": count_where(tx.has_non_ascii(t)),
        "mojibake": count_where(tx.has_mojibake(t)),
        "very_short": count_where(tx.shorter_than(t, SHORT_CHARS)),
        "very_long": count_where(tx.exceeds(t, LONG_CHARS)),
    }


def hierarchical_facts(
    instruction: str,
    response: str,
    category: str,
    intent: str,
    all_columns: Sequence[str],
    instruction_cap: int = INSTRUCTION_CAP,
    response_cap: int = RESPONSE_CAP,
) -> dict[str, Column]:
    """What each counter of :func:`hierarchical_counters` needs of a row: a key to count duplicates by, else a flag."""
    i, r, c = tx.as_text(instruction), tx.as_text(response), tx.as_text(category)
    return {
        "null_intent": F.col(intent).isNull(),
        "duplicate_instruction_intent": content_key(instruction, intent),
        "duplicate_rows": content_key(*all_columns),
        "mojibake_response": tx.has_mojibake(r),
        "instruction_over_cap": tx.exceeds(i, instruction_cap),
        "response_over_cap": tx.exceeds(r, response_cap),
        "category_not_upper": c != F.upper(c),
        "instruction_edge_whitespace": tx.has_edge_whitespace(i),
        "instruction_multi_space": tx.has_multi_space(i),
        "instruction_has_tab": tx.has_tab(i),
    }


def hierarchical_counters(
    instruction: str,
    response: str,
    category: str,
    intent: str,
    all_columns: Sequence[str],
    instruction_cap: int = INSTRUCTION_CAP,
    response_cap: int = RESPONSE_CAP,
    measured: bool = False,
) -> dict[str, Column]:
    """The eleven counters of a corpus with a category above its label.

    With ``measured`` the corpus has the columns of :func:`hierarchical_facts`, and no
    text is read.
    """
    facts = hierarchical_facts(instruction, response, category, intent, all_columns, instruction_cap, response_cap)
    keys = {"duplicate_instruction_intent": [instruction, intent], "duplicate_rows": all_columns}
    counters = {"n_rows": F.count("*")}
    for name, fact in facts.items():
        if name in keys:
            counters[name] = duplicates_beyond_first(*keys[name], hashed=name if measured else None)
        else:
            counters[name] = count_where(F.col(name) if measured else fact)
    return counters


def audit(df: DataFrame, counters: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """One row per group of ``by`` (one row in all without it), one column per counter."""
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in counters.items()])


def as_long(report: DataFrame, counters: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Wide report to ``(*by, metric, value)``."""
    return report.unpivot(list(by), list(counters), "metric", "value")


def before_after(before: DataFrame, after: DataFrame, counters: Sequence[str], split: str) -> DataFrame:
    """Per counter: value before and after, one column pair per split.

    Columns are ``<split>_before`` and ``<split>_after`` for the splits found.  The
    reports are written first: a pivot looks for its columns in a job of its own, which
    would run both audits once more.
    """
    tagged = as_long(before, counters, [split]).withColumn("phase", F.lit("before")).unionByName(
        as_long(after, counters, [split]).withColumn("phase", F.lit("after"))
    )
    return (
        stage(tagged, "reports").withColumn("column", F.concat_ws("_", split, "phase"))
        .groupBy("metric")
        .pivot("column")
        .agg(F.sum("value"))
    )


def gate(report: DataFrame, must_be_zero: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(*by, metric, value, ok)`` for the counters that must be zero."""
    return as_long(report, must_be_zero, by).withColumn("ok", F.col("value") == 0)


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column and rows with any null, in one pass."""
    any_null = F.lit(False)
    for c in df.columns:
        any_null = any_null | F.col(c).isNull()
    wide = df.agg(
        *[count_where(F.col(c).isNull()).alias(c) for c in df.columns],
        count_where(any_null).alias("(any)"),
    )
    return wide.unpivot([], [*df.columns, "(any)"], "column", "nulls")


def whitespace_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Leading, trailing, multiple spaces, tabs and newlines per text column."""
    aggs = []
    for c in columns:
        t = tx.as_text(c)
        aggs.append(
            F.struct(
                F.lit(c).alias("column"),
                count_where(tx.has_leading_whitespace(t)).alias("leading"),
                count_where(tx.has_trailing_whitespace(t)).alias("trailing"),
                count_where(tx.has_multi_space(t)).alias("multi_space"),
                count_where(tx.has_tab(t)).alias("tab"),
                count_where(tx.has_newline(t)).alias("newline"),
            )
        )
    return df.agg(F.array(*aggs).alias("r")).select(F.inline("r"))


def character_damage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Blank, non-ASCII and mojibake rows per text column."""
    aggs = []
    for c in columns:
        t = tx.as_text(c)
        aggs.append(
            F.struct(
                F.lit(c).alias("column"),
                count_where(tx.is_blank(t)).alias("blank"),
                count_where(tx.has_non_ascii(t)).alias("non_ascii"),
                count_where(tx.has_mojibake(t)).alias("mojibake"),
            )
        )
    return df.agg(F.array(*aggs).alias("r")).select(F.inline("r"))


def shape(df: DataFrame) -> DataFrame:
    """``column, type, n_rows`` of a table."""
    schema = [F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type")) for f in df.schema]
    return df.agg(F.count("*").alias("n_rows")).select(F.inline(F.array(*schema)), "n_rows")

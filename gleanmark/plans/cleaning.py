"""Cleaning jobs with a row-accounted log.

Both de-duplications of the hierarchical job depend on the filters before them,
yet the corpus is not rewritten step by step: it is normalised and written once
with its key hashes, a slim table of them decides which rows fall at which step,
and each row is tagged with the first step it fails.  The log is one aggregate
over the tags and reads no text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanmark.functions import text as tx
from gleanmark.functions.keys import content_key
from gleanmark.operators.audit import INSTRUCTION_CAP, RESPONSE_CAP
from gleanmark.operators.dedup import repeated_keys
from gleanmark.operators.expectations import stop_unless_met
from gleanmark.operators.profile import parents_of
from gleanmark.session import lookup, stage

HIERARCHICAL_STEPS = [
    "drop_null_label",
    "dedup_text_label",
    "drop_length_outliers",
    "dedup_after_normalising",
]
FLAT_STEPS = ["drop_empty_text", "dedup_text_label"]


def normalise_columns(
    df: DataFrame, columns: list[str], mojibake: list[str] = (), recollapse: bool = False
) -> DataFrame:
    """Collapse whitespace, repair mojibake where asked, then NFKC.

    The steps are separate projections, so each text is collapsed once although
    the NFKC step refers to it several times.  NFKC can bring back a space next
    to another; ``recollapse`` makes the result a fixed point, the default keeps
    the plain order of steps.
    """
    out = df.withColumns(
        {
            c: tx.repair_mojibake(tx.collapse_whitespace(c)) if c in mojibake else tx.collapse_whitespace(c)
            for c in columns
        }
    )
    out = out.withColumns({c: tx.nfkc(c) for c in columns})
    return out.withColumns({c: tx.collapse_whitespace(c) for c in columns}) if recollapse else out


def drop_empty(df: DataFrame, text: str) -> DataFrame:
    """Rows whose text is not empty once normalised; null counts as empty."""
    return df.where(~tx.is_blank(text))


def tag_hierarchical(
    df: DataFrame,
    row_id: str = "row_id",
    text: str = "instruction",
    response: str = "response",
    category: str = "category",
    label: str = "intent",
    text_cap: int = INSTRUCTION_CAP,
    response_cap: int = RESPONSE_CAP,
    recollapse: bool = False,
    facts: dict[str, Column] | None = None,
) -> DataFrame:
    """Cleaned columns plus ``failed_step``: null for rows that stay.

    Steps, in order: drop null labels; first row per raw (text, label); normalise
    text and response; upper-case the category; drop over-long rows; first row per
    cleaned (text, label).

    ``facts`` are further columns, expressions over the cleaned ones.  They are
    written with the text, so a report on them reads no text again, nor moves it
    to the fates of its key where those are too many to broadcast.
    """
    facts = facts or {}
    raw = df.withColumn("_raw_key", content_key(text, label))
    keyed = (
        normalise_columns(raw, [text, response], mojibake=[response], recollapse=recollapse)
        .withColumn(category, F.upper(category))
        .withColumn(
            "_fits",
            F.coalesce(
                (F.char_length(text) <= text_cap) & (F.char_length(response) <= response_cap),
                F.lit(False),
            ),
        )
    )
    keyed = stage(keyed.withColumns({"_clean_key": content_key(text, label), **facts}), "normalised")
    fates = lookup(_fates(keyed, row_id, label), "fates")
    step = (
        F.when(F.col(label).isNull(), HIERARCHICAL_STEPS[0])
        .when(F.col("_raw_first") != F.col(row_id), HIERARCHICAL_STEPS[1])
        .when(~F.col("_fits"), HIERARCHICAL_STEPS[2])
        .when(F.col("_clean_first") != F.col(row_id), HIERARCHICAL_STEPS[3])
    )
    return keyed.join(fates, "_raw_key", "left").select(*df.columns, *facts, step.alias("failed_step"))


def _fates(keyed: DataFrame, row_id: str, label: str) -> DataFrame:
    """``_raw_key, _raw_first, _clean_first`` of the raw keys whose rows may fall.

    A raw key is listed when it repeats, or when its first row, cleaned, repeats
    another.  Only hashes and ids are grouped, in two rounds: rows to raw keys,
    and the first rows of those that fit to cleaned keys.
    """
    leaders = (
        keyed.where(F.col(label).isNotNull())
        .groupBy("_raw_key")
        .agg(
            F.count("*").alias("_n"),
            F.min(F.struct(row_id, "_fits", "_clean_key")).alias("_head"),
        )
        .select(
            "_raw_key",
            "_n",
            F.col(f"_head.{row_id}").alias("_raw_first"),
            F.when(F.col("_head._fits"), F.col("_head._clean_key")).alias("_clean_key"),
        )
    )
    leaders = lookup(leaders, "leaders")
    repeats = (
        leaders.where("_clean_key is not null")
        .groupBy("_clean_key")
        .agg(F.count("*").alias("_m"), F.min("_raw_first").alias("_clean_first"))
        .where("_m > 1")
        .drop("_m")
    )
    return (
        leaders.join(repeats, "_clean_key", "left")
        .where("_n > 1 or _clean_first != _raw_first")
        .select("_raw_key", "_raw_first", "_clean_first")
    )


def hierarchy_gate(cleaned: DataFrame, label: str = "intent", category: str = "category") -> DataFrame:
    """One row: labels, those under more than one category, the first of them, and whether there is none."""
    parents = parents_of(cleaned, label, category)
    several = F.col("n_parents") > 1
    return parents.agg(
        F.count("*").alias("n_labels"),
        F.count_if(several).alias("n_violations"),
        F.min(F.when(several, F.col(label))).alias("first_violation"),
        (F.count_if(several) == 0).alias("ok"),
    )


def clean_hierarchical(
    df: DataFrame, label: str = "intent", category: str = "category", enforced: bool = False, **columns
) -> DataFrame:
    """The rows that pass every step, cleaned.

    ``enforced`` adds the last step: the job stops if a label of the cleaned rows lies
    under more than one category.  The rows are written first, so cleaning runs once.
    """
    tagged = tag_hierarchical(df, label=label, category=category, **columns)
    cleaned = tagged.where("failed_step is null").drop("failed_step")
    if enforced:
        cleaned = stage(cleaned, "cleaned")
        stop_unless_met(hierarchy_gate(cleaned, label, category))
    return cleaned


def cleaning_log(tagged: DataFrame, steps: list[str], by: list[str] | None = None) -> DataFrame:
    """``(*by, step_no, step, rows_before, rows_after, dropped)``, one row per step."""
    by = by or []
    dropped = [F.count_if(F.col("failed_step") == s) for s in steps]
    cells = []
    before = F.count("*")
    for i, (s, d) in enumerate(zip(steps, dropped)):
        cells.append(
            F.struct(
                F.lit(i + 1).alias("step_no"),
                F.lit(s).alias("step"),
                before.alias("rows_before"),
                (before - d).alias("rows_after"),
                d.alias("dropped"),
            )
        )
        before = before - d
    return tagged.groupBy(*by).agg(F.array(*cells).alias("r")).select(*by, F.inline("r"))


def tag_flat(
    df: DataFrame,
    row_id: str = "row_id",
    text: str = "text",
    label: str = "label",
    split: str | None = None,
    recollapse: bool = False,
) -> DataFrame:
    """Normalised text plus ``failed_step``; with ``split`` each split on its own."""
    keys = [*([split] if split else []), text, label]
    # NFKC never empties a text, so the test reads the raw one: rows without text
    # are found by their first character, before any normalising.
    marked = df.withColumn("_present", F.coalesce(~tx.is_blank(text), F.lit(False)))
    normalised = normalise_columns(marked, [text], recollapse=recollapse)
    keyed = stage(normalised.withColumn("_key", content_key(*keys)), "normalised")
    repeats = lookup(repeated_keys(keyed.where("_present"), F.col("_key"), row_id), "repeated")
    step = F.when(~F.col("_present"), FLAT_STEPS[0]).when(F.col("_first") != F.col(row_id), FLAT_STEPS[1])
    return keyed.join(repeats, "_key", "left").select(*df.columns, step.alias("failed_step"))


def clean_flat(df: DataFrame, **columns) -> DataFrame:
    return tag_flat(df, **columns).where("failed_step is null").drop("failed_step")

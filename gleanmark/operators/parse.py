"""From a model's raw answer back to a label."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanmark.functions.text import WHITESPACE
from gleanmark.operators.closest import FUZZY_CUTOFF, LabelIndex, closest_labels, index_labels
from gleanmark.operators.labelspace import label_table
from gleanmark.session import lookup, stage

# ---- fixed values: answer patterns and the names of the parse paths ----------
FLAT_ANCHOR = rf"(?U)[Ii]ntent[{WHITESPACE}]*[:=][{WHITESPACE}]*([A-Za-z0-9_]+)"
CATEGORY_ANCHOR = rf"(?U)[Cc]ategory[{WHITESPACE}]*[:=][{WHITESPACE}]*([A-Z_]+)"
INTENT_ANCHOR = rf"(?U)[Ii]ntent[{WHITESPACE}]*[:=][{WHITESPACE}]*([A-Za-z_]+)"
BARE_TOKEN = r"[A-Za-z0-9_]+"
PATHS = ["regex", "bare", "fuzzy", "none"]
# -----------------------------------------------------------------------------


def _found(raw: str, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(raw, pattern, group), F.lit(""))


@dataclass
class Spellings:
    """How labels may be written (``known, label``), and the index for what is written otherwise."""

    table: DataFrame
    index: LabelIndex


def spellings(spark: SparkSession, labels: DataFrame | list[str], cutoff: float = FUZZY_CUTOFF, fold_case: bool = False) -> Spellings:
    """The spellings of a table with a column ``label`` (or of a list), written once for any number of parses."""
    known = F.lower("label") if fold_case else F.col("label")
    table = label_table(spark, labels).groupBy(known.alias("known")).agg(F.max("label").alias("label"))
    table = lookup(table, "spelling")
    return Spellings(table, index_labels(table, "known", cutoff))


def _resolved(values: DataFrame, spelt: Spellings) -> DataFrame:
    """``value, label, exact`` for each distinct value that is a label or close to one.

    Only what is no label itself goes to the search.
    """
    asked = values.select("value").where("value is not null").distinct()
    found = lookup(asked.join(spelt.table, F.col("value") == F.col("known"), "left").select("value", "label"), "values")
    exact = found.where("label is not null").select("value", "label", F.lit(True).alias("exact"))
    open_values = found.where("label is null").select("value")
    if open_values.isEmpty():
        return exact
    near = closest_labels(open_values, "value", spelt.index).withColumnRenamed("label", "known")
    near = near.join(spelt.table, "known").select(F.col("candidate").alias("value"), "label", F.lit(False).alias("exact"))
    return lookup(exact.unionByName(near), "resolved")


def _said(df: DataFrame, **found: Column) -> tuple[DataFrame, DataFrame]:
    """``df`` with the values found as ``_<name>``, and the distinct values alone."""
    keyed = df.withColumns({f"_{name}": c for name, c in found.items()})
    said = keyed.select(*[F.col(f"_{name}").alias(name) for name in found]).distinct()
    return keyed, lookup(said, "said")


def _decided(keyed: DataFrame, decided: DataFrame, *names: str) -> DataFrame:
    """What was decided about distinct values, beside the rows that hold them."""
    decided = lookup(decided.withColumnsRenamed({name: f"_said_{name}" for name in names}), "decided")
    same = F.lit(True)
    for name in names:
        # Values are never empty, so the empty string can stand for none and the join has plain keys.
        same &= F.coalesce(F.col(f"_{name}"), F.lit("")) == F.coalesce(F.col(f"_said_{name}"), F.lit(""))
    return keyed.join(decided, same, "left")


def parse_answers(
    df: DataFrame,
    raw: str,
    labels: DataFrame | list[str] | Spellings,
    cutoff: float = FUZZY_CUTOFF,
    fold_case: bool = False,
) -> DataFrame:
    """Add ``pred_intent, parse_error, parse_path`` for one-line answers.

    The anchored label decides, exactly or by its closest label; failing that,
    the first identifier of the answer, exactly or by its closest label.
    Candidates are lower-cased while the vocabulary is taken as it is, so a label
    with capitals is only reached through the closest match; ``fold_case`` folds
    the vocabulary as well and returns the label's own spelling.

    ``labels`` is a table with a column ``label``, or its ``spellings``, which decide
    cutoff and folding then.  What answers say is reduced to its
    distinct values before any label is looked up, and joined again at the end.
    """
    spelt = labels if isinstance(labels, Spellings) else spellings(df.sparkSession, labels, cutoff, fold_case)
    keyed, said = _said(
        df, anchored=F.lower(_found(raw, FLAT_ANCHOR, 1)), bare=F.lower(_found(raw, BARE_TOKEN, 0))
    )
    by_anchor = _resolved(said.select(F.col("anchored").alias("value")), spelt)
    first = said.join(by_anchor, said["anchored"] == by_anchor["value"], "left").select("anchored", "bare", "label", "exact")
    # The bare token counts only where the anchor gave nothing.
    rest = first.where("label is null").select("anchored", "bare")
    by_token = _resolved(rest.select(F.col("bare").alias("value")), spelt)
    second = rest.join(by_token, rest["bare"] == by_token["value"], "left").select("anchored", "bare", "label", "exact")
    path = lambda exact: F.when(F.col("label").isNull(), "none").when(F.col("exact"), exact).otherwise("fuzzy")
    decided = first.where("label is not null").withColumn("path", path("regex")).unionByName(second.withColumn("path", path("bare")))
    decided = decided.drop("exact").withColumnsRenamed({"label": "_label", "path": "_path"})
    return _decided(keyed, decided, "anchored", "bare").select(
        *df.columns,
        F.col("_label").alias("pred_intent"),
        F.col("_label").isNull().alias("parse_error"),
        F.col("_path").alias("parse_path"),
    )


def parse_two_line_answers(
    df: DataFrame,
    raw: str,
    categories: DataFrame | list[str] | Spellings,
    labels: DataFrame | list[str] | Spellings,
    cutoff: float = FUZZY_CUTOFF,
    keep_unmatched: bool = True,
) -> DataFrame:
    """Add ``pred_category, pred_intent, parse_error`` for two-line answers.

    An answer whose label has no close match is an error; ``keep_unmatched``
    still returns what it said, which then counts as a wrong prediction.
    ``categories`` and ``labels`` are tables with a column ``label``.
    """
    keyed, said = _said(
        df, category=_found(raw, CATEGORY_ANCHOR, 1), intent=F.lower(_found(raw, INTENT_ANCHOR, 1))
    )
    out = said
    for name, known in (("category", categories), ("intent", labels)):
        spelt = known if isinstance(known, Spellings) else spellings(df.sparkSession, known, cutoff)
        found = _resolved(said.select(F.col(name).alias("value")), spelt)
        found = found.select("value", F.col("label").alias(f"_{name}_label"))
        out = out.join(found, F.col(name) == F.col("value"), "left").drop("value")
    joined = _decided(keyed, out, "category", "intent")

    def shown(name: str) -> Column:
        label = F.col(f"_{name}_label")
        return F.coalesce(label, F.col(f"_{name}")) if keep_unmatched else label

    return joined.select(
        *df.columns,
        shown("category").alias("pred_category"),
        shown("intent").alias("pred_intent"),
        (F.col("_category_label").isNull() | F.col("_intent_label").isNull()).alias("parse_error"),
    )


def path_counts(parsed: DataFrame) -> DataFrame:
    """``parse_path, n, share`` for all four paths, zero where a path was not taken."""
    wide = parsed.agg(*[F.count_if(F.col("parse_path") == p).alias(p) for p in PATHS])
    total = F.sum("n").over(Window.partitionBy())
    return wide.unpivot([], PATHS, "parse_path", "n").withColumn(
        "share", F.round(F.coalesce(F.col("n") / F.nullif(total, F.lit(0)), F.lit(0.0)), 6)
    )


def preflight(
    df: DataFrame, raw: str, order: str, labels: DataFrame | list[str] | Spellings, n: int = 10, max_unparsed: int = 2
) -> DataFrame:
    """Parse the first ``n`` answers only: path counts, and whether to go on."""
    first = parse_answers(stage(df.orderBy(order).limit(n), "first-answers"), raw, labels)
    return first.agg(
        *[F.count_if(F.col("parse_path") == p).alias(f"n_{p}") for p in PATHS],
        (F.count_if(F.col("parse_path") == "none") <= max_unparsed).alias("ok"),
    )

"""Expressions on label names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanmark.functions.text import _col

# Sentinels for a missing gold and a missing predicted label.
UNKNOWN_LABEL = "UNKNOWN"
PARSE_ERROR = "PARSE_ERROR"


def label_tokens(c: str | Column) -> Column:
    """Distinct lower-case words of a label name such as ``lost_card?``."""
    words = F.split(F.replace(F.lower(_col(c)), F.lit("?"), F.lit("")), "_")
    return F.array_distinct(F.filter(words, lambda w: w != ""))


def jaccard(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))


def is_irregular_label(c: str | Column) -> Column:
    """Not all lower case, or something other than letters, ``_`` and ``?``."""
    bare = F.translate(_col(c), "_?", "")
    return (_col(c) != F.lower(_col(c))) | ~bare.rlike(r"^[a-z_?]+\z")


def round4(c: str | Column) -> Column:
    return F.round(_col(c).cast("double"), 4)


def or_unknown(c: str | Column) -> Column:
    return F.coalesce(_col(c), F.lit(UNKNOWN_LABEL))


def or_parse_error(c: str | Column) -> Column:
    return F.coalesce(_col(c), F.lit(PARSE_ERROR))

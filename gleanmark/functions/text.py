"""Row-local text expressions.

Everything is a built-in Spark expression except :func:`nfkc`, which ships only
non-ASCII values to Python.  Cheap byte and literal searches are preferred over
regular expressions, and a regular expression over a text is guarded by a cheap
test where one exists.
"""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values: they decide results and must not change -----------------
# Unicode whitespace, as the body of a character class under (?U).
WHITESPACE = r"\s\x1c-\x1f"
# Byte signatures of UTF-8 read as Latin-1; "." stops at a newline only.
MOJIBAKE = "(?d)Ã.|â€.|Â.|ï»¿"
# Literal repairs, applied in this order.
MOJIBAKE_REPAIRS = [
    ("â€™", "'"),
    ("â€œ", '"'),
    ("â€\x9d", '"'),
    ("Ã©", ""),
    ("ï»¿", ""),
]
# -----------------------------------------------------------------------------

WS_RUN = f"(?U)[{WHITESPACE}]+"
WS_ONE = f"(?U)[{WHITESPACE}]"
NON_WS_ONE = f"(?U)[^{WHITESPACE}]"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c: str | Column) -> Column:
    """The value as a string, null as the empty string."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def collapse_whitespace(c: str | Column) -> Column:
    """Every whitespace run becomes one space; none is left at the ends."""
    return F.trim(F.regexp_replace(_col(c), WS_RUN, " "))


def is_blank(c: str | Column) -> Column:
    """Empty, or whitespace only.  Stops at the first other character."""
    return ~_col(c).rlike(NON_WS_ONE)


def has_leading_whitespace(c: str | Column) -> Column:
    return F.substring(_col(c), 1, 1).rlike(WS_ONE)


def has_trailing_whitespace(c: str | Column) -> Column:
    return F.substring(_col(c), -1, 1).rlike(WS_ONE)


def has_edge_whitespace(c: str | Column) -> Column:
    return has_leading_whitespace(c) | has_trailing_whitespace(c)


def has_multi_space(c: str | Column) -> Column:
    return _col(c).contains("  ")


def has_tab(c: str | Column) -> Column:
    return _col(c).contains("\t")


def has_newline(c: str | Column) -> Column:
    return _col(c).contains("\n")


def has_non_ascii(c: str | Column) -> Column:
    """A code point beyond U+007F takes more than one byte in UTF-8."""
    return F.octet_length(_col(c)) != F.char_length(_col(c))


def has_mojibake(c: str | Column) -> Column:
    return has_non_ascii(c) & _col(c).rlike(MOJIBAKE)


def repair_mojibake(c: str | Column) -> Column:
    """Literal repairs.  Run before :func:`nfkc`, which would split the ™ sign."""
    out = _col(c)
    for damaged, repaired in MOJIBAKE_REPAIRS:
        out = F.replace(out, F.lit(damaged), F.lit(repaired))
    return out


# Values that are Python strings at a time.
_SLICE = 64


@F.arrow_udf(T.StringType())
def _nfkc(values: pa.Array) -> pa.Array:
    """A batch stays Arrow's: a Python string of it takes several times its bytes."""
    if values.null_count == len(values):
        return values
    parts = []
    for i in range(0, len(values), _SLICE):
        texts = values.slice(i, _SLICE).to_pylist()
        parts.append(pa.array([None if s is None else unicodedata.normalize("NFKC", s) for s in texts], values.type))
    return pa.concat_arrays(parts)


def nfkc(c: str | Column) -> Column:
    """Unicode NFKC.  ASCII is NFKC already, so those rows send Python a null."""
    value = _col(c)
    return F.coalesce(_nfkc(F.when(has_non_ascii(value), value)), value)


def title_label(c: str | Column) -> Column:
    """Title case per underscore-separated word: ``SHIP_TO`` becomes ``Ship_To``."""
    return F.array_join(F.transform(F.split(_col(c), "_"), lambda w: F.initcap(w)), "_")


def word_count(c: str | Column) -> Column:
    """Whitespace-separated words, empty ones not counted.

    A split leaves an empty piece at each end that has whitespace, and one for
    the empty string.
    """
    value = _col(c)
    pieces = F.size(F.split(value, WS_RUN))
    empty = has_leading_whitespace(value) | (value == "")
    return pieces - empty.cast("int") - has_trailing_whitespace(value).cast("int")


def characters(c: str | Column) -> Column:
    """The characters of a string, whitespace left out."""
    return F.filter(F.split(_col(c), ""), lambda ch: (ch != "") & ~ch.rlike(WS_ONE))


def exceeds(c: str | Column, limit: int) -> Column:
    return F.char_length(_col(c)) > limit


def shorter_than(c: str | Column, limit: int) -> Column:
    return F.char_length(_col(c)) < limit

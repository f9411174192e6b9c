"""The closest label of a misspelt one, as a similarity join of two tables.

The ratio of two names is twice the letters in their longest matching blocks over the
letters of both.  It cannot exceed twice the letters they have in common, in any order,
over the letters of both.  So:

1. Every name becomes the set of its letters, each with a running number among its kind
   (``aab`` has a1, a2, b1); common letters are common elements.
2. Names are indexed under their rarest elements only: if a pair can reach the cutoff, the
   first common element, from rare to frequent, is among the first few of either name.
3. Pairs that meet there are kept if their sets allow the cutoff, and only those are
   compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanmark.operators.salting import SALT_ROWS, salted_join
from gleanmark.session import lookup

# Fixed value: the least ratio that counts as a match.
FUZZY_CUTOFF = 0.7


def _letters(name: str) -> Column:
    """Letters (code points) of a name, each followed by its running number."""
    letters = F.array_sort(F.regexp_extract_all(name, F.lit("(?s)."), 0))
    return F.transform(letters, lambda x, i: F.concat(x, (i + 2 - F.array_position(letters, x)).cast("string")))


def _indexed(names: DataFrame, seen: DataFrame, cutoff: float) -> DataFrame:
    """``name`` with ``letters`` from rare to frequent and, as ``prefix``, those that any partner must share one of."""
    spelt = names.select("name", F.explode(_letters("name")).alias("letter"))
    ranked = (
        spelt.join(seen, "letter", "left")
        .groupBy("name")
        .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "letter"))).alias("_l"))
        .select("name", F.col("_l.letter").alias("letters"))
    )
    # With any partner the common letters number at least cutoff / (2 - cutoff) of the own.
    least = F.ceil(F.size("letters") * F.lit(cutoff / (2 - cutoff)) - 1e-9)
    return ranked.withColumn("prefix", F.slice("letters", 1, (F.size("letters") - least + 1).cast("int")))


def similarity(label: Column, candidate: Column) -> Column:
    """Ratio of matching blocks, as ``difflib`` counts them."""

    @F.pandas_udf("double")
    def ratio(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        matcher = SequenceMatcher()
        for labels, candidates in batches:
            out, last = [], None
            for a, b in zip(labels, candidates):
                if b != last:
                    matcher.set_seq2(b)
                    last = b
                matcher.set_seq1(a)
                out.append(matcher.ratio())
            yield pd.Series(out, dtype="float64")

    return ratio.asNondeterministic()(label, candidate)


@dataclass
class LabelIndex:
    """Labels under the letters that a close name must share with them, written once."""

    rows: DataFrame  # label, theirs, their_prefix, letter
    seen: DataFrame  # letter, n
    longest: int
    cutoff: float


def index_labels(labels: DataFrame, label: str = "label", cutoff: float = FUZZY_CUTOFF) -> LabelIndex:
    """An index of distinct labels; nulls and empty names are left out."""
    known = labels.select(F.col(label).alias("name")).where("name <> ''").distinct()
    seen = known.select(F.explode(_letters("name")).alias("letter")).groupBy("letter").agg(F.count("*").alias("n"))
    seen = lookup(seen, "letters")
    there = _indexed(known, seen, cutoff)
    rows = there.select(F.col("name").alias("label"), F.col("letters").alias("theirs"), F.col("prefix").alias("their_prefix"), F.explode("prefix").alias("letter"))
    longest = known.agg(F.coalesce(F.max(F.char_length("name")), F.lit(0))).first()[0]
    return LabelIndex(lookup(rows, "label-letters"), seen, longest, cutoff)


def comparable_pairs(candidates: DataFrame, labels: DataFrame | LabelIndex, cutoff: float = FUZZY_CUTOFF, salt_rows: int = SALT_ROWS) -> DataFrame:
    """``candidate, label`` for the pairs whose letters allow the cutoff; tables of distinct ``name``s."""
    index = labels if isinstance(labels, LabelIndex) else index_labels(labels, "name", cutoff)
    cutoff = index.cutoff
    # A much longer name has too many letters for any label.
    asked = candidates.where(F.char_length("name") <= int(index.longest * (2 - cutoff) / cutoff + 1e-9))
    here = _indexed(asked, index.seen, cutoff)
    large = here.select(F.col("name").alias("candidate"), F.col("letters").alias("ours"), F.col("prefix").alias("our_prefix"), F.explode("prefix").alias("letter"))
    # A candidate has a letter once, so no letter is in more rows than there are candidates.
    met = salted_join(large, index.rows, "letter", ["candidate"], salt_rows, most=candidates.count())
    total = F.size("ours") + F.size("theirs")
    first = F.element_at(F.array_intersect("our_prefix", "their_prefix"), 1)
    common = F.size(F.array_intersect("ours", "theirs"))
    near = 2 * F.least(F.size("ours"), F.size("theirs")) / total >= cutoff
    return met.where(near & (first == F.col("letter")) & (2 * common / total >= cutoff)).select("candidate", "label")


def closest_labels(
    candidates: DataFrame,
    candidate: str,
    labels: DataFrame | LabelIndex,
    label: str = "label",
    cutoff: float = FUZZY_CUTOFF,
    salt_rows: int = SALT_ROWS,
) -> DataFrame:
    """``candidate, label, ratio`` for every distinct candidate that a label comes close to.

    The label of the greatest ratio at or above ``cutoff``; ties go to the greatest
    label.  Nulls and empty names on either side have no closest label.  An index of the
    labels, which has its own cutoff, serves any number of searches.
    """
    index = labels if isinstance(labels, LabelIndex) else index_labels(labels, label, cutoff)
    asked = lookup(candidates.select(F.col(candidate).alias("name")).where("name <> ''").distinct(), "candidates")
    scored = comparable_pairs(asked, index, salt_rows=salt_rows).withColumn("ratio", similarity(F.col("label"), F.col("candidate")))
    best = scored.where(F.col("ratio") >= index.cutoff).groupBy("candidate").agg(F.max(F.struct("ratio", "label")).alias("b"))
    return best.select("candidate", "b.label", "b.ratio")

"""Reproducible defects: a known ground truth for audits and cleaning.

A row is hit when its hash under ``(seed, defect, row_id)`` is among the
smallest ``round(N * fraction)``.  The same rows are hit whatever the
partitioning, and the number is exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanmark.functions.keys import seeded_order
from gleanmark.functions.text import title_label
from gleanmark.operators.ranking import pick_exact

# Share of rows per defect, and the damage done.
DEFECT_FRACTIONS = {
    "null_label": 0.05,
    "whitespace": 0.02,
    "case": 0.01,
    "mojibake": 0.01,
    "outlier": 0.01,
    "duplicate": 0.02,
}
OUTLIER_COPIES = 10
MOJIBAKE_PREFIX = "Ã©"
MOJIBAKE_APOSTROPHE = "â€™"


def pick_defects(
    df: DataFrame, row_id: str, fractions: dict[str, float] | None = None, seed: int = 42
) -> DataFrame:
    """Add one boolean ``hit_<defect>`` per defect."""
    shares = fractions or DEFECT_FRACTIONS
    hashes = {f"hit_{d}": seeded_order(f"{seed}:{d}", row_id) for d in shares}
    counts = {f"hit_{d}": F.bround(F.count("*") * F.lit(f), 0).cast("long") for d, f in shares.items()}
    return pick_exact(df, hashes, counts)


def inject_defects(
    df: DataFrame,
    row_id: str,
    text: str,
    response: str,
    category: str,
    label: str,
    fractions: dict[str, float] | None = None,
    seed: int = 42,
) -> DataFrame:
    """Damage the picked rows and append copies; keeps the ``hit_*`` flags.

    Copies carry the damage of their originals.  ``row_id`` stays unique: the
    originals take even numbers, each copy the odd number after its original, and
    ``appended`` marks the copies.
    """
    flagged = pick_defects(df, row_id, fractions, seed)
    spaced = F.concat(
        F.lit("  "), F.regexp_replace(F.col(text), "^([^ ]*) ", "$1   "), F.lit("\t")
    )
    coin = F.substring(seeded_order(f"{seed}:coin", row_id), 1, 1).isin(*"01234567")
    # Whitespace first, then the outlier, as a row may take both.
    damaged = (
        flagged.withColumn(label, F.when(~F.col("hit_null_label"), F.col(label)))
        .withColumn(text, F.when(F.col("hit_whitespace"), spaced).otherwise(F.col(text)))
        .withColumn(
            category,
            F.when(
                F.col("hit_case"),
                F.when(coin, F.lower(category)).otherwise(title_label(category)),
            ).otherwise(F.col(category)),
        )
        .withColumn(
            response,
            F.when(
                F.col("hit_mojibake"),
                F.concat(
                    F.lit(MOJIBAKE_PREFIX),
                    F.replace(F.col(response), F.lit("'"), F.lit(MOJIBAKE_APOSTROPHE)),
                ),
            ).otherwise(F.col(response)),
        )
        .withColumn(
            text,
            F.when(
                F.col("hit_outlier"), F.repeat(F.concat(F.col(text), F.lit(" ")), OUTLIER_COPIES)
            ).otherwise(F.col(text)),
        )
    )
    copies = F.when(F.col("hit_duplicate"), F.array(F.lit(False), F.lit(True))).otherwise(
        F.array(F.lit(False))
    )
    return damaged.withColumn("appended", F.explode(copies)).withColumn(
        row_id, F.col(row_id) * 2 + F.col("appended").cast("long")
    )


def injection_report(injected: DataFrame) -> DataFrame:
    """``defect, n`` over the original rows."""
    hits = [c for c in injected.columns if c.startswith("hit_")]
    originals = F.col("appended") == F.lit(False)
    wide = injected.agg(*[F.count_if(F.col(h) & originals).alias(h[4:]) for h in hits])
    return wide.unpivot([], [h[4:] for h in hits], "defect", "n")

"""Fixed-width keys, so that long texts are hashed once and never shuffled to be compared."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanmark.functions.text import _col


def content_key(*cols: str | Column) -> Column:
    """SHA-256 of the values.  Null equals null; lengths keep neighbours apart."""
    parts = []
    for c in cols:
        text = _col(c).cast("string")
        parts.append(
            F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit("null"))
        )
    return F.unhex(F.sha2(F.concat_ws("|", *parts), 256))


def seeded_order(seed: int | str, row_id: str | Column) -> Column:
    """A reproducible shuffle key that does not depend on the partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}:"), _col(row_id).cast("string")))

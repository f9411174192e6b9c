"""What the operators on embeddings share."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def stacked(arrays) -> np.ndarray:
    """Rows of equal length as a matrix in double precision."""
    return np.array([np.asarray(a, dtype=np.float64) for a in arrays], dtype=np.float64)


def usable(vector: Column) -> Column:
    """Whether a vector is not null, not zero, and of finite components only."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def vector_key(vector: Column) -> Column:
    """128 bits of a usable vector; equal vectors have equal keys."""

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for some in batches:
            yield some.map(lambda v: hashlib.blake2b(np.ascontiguousarray(v).tobytes(), digest_size=16).digest(), na_action="ignore").astype(object)

    return run(vector)

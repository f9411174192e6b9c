"""Row-local cleaning and export on an unbounded table.

The same expressions as in batch; no state, hence no watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from gleanmark.plans.cleaning import drop_empty, normalise_columns


def normalise(df: DataFrame, text: str) -> DataFrame:
    """Drop rows without text, collapse whitespace, and apply NFKC."""
    return normalise_columns(drop_empty(df, text), [text])


def normalise_to(df: DataFrame, text: str, path: str, checkpoint: str) -> StreamingQuery:
    """Normalise everything available and append it to a Parquet folder."""
    return (
        normalise(df, text)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )

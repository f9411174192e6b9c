"""Expectations as tables: what was observed, what was expected, does it hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def expect_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Raise when a required column is missing; otherwise hand the table on."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df


def column_presence(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """``column, present`` for every required column, as a report."""
    held = [(c, c in df.columns) for c in required]
    return df.sparkSession.createDataFrame(held, "column string, present boolean")


def expectations(df: DataFrame, checks: dict[str, tuple[Column, int]]) -> DataFrame:
    """``name, observed, expected, ok`` from one aggregate over ``df``."""
    rows = [
        F.struct(
            F.lit(name).alias("name"),
            observed.cast("long").alias("observed"),
            F.lit(expected).cast("long").alias("expected"),
        )
        for name, (observed, expected) in checks.items()
    ]
    return (
        df.agg(F.array(*rows).alias("r"))
        .select(F.inline("r"))
        .withColumn("ok", F.col("observed") == F.col("expected"))
    )


def enforce(checks: DataFrame) -> DataFrame:
    """Fail the job on the first row whose ``ok`` is false."""
    return checks.withColumn(
        "ok",
        F.when(F.col("ok"), F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("expectation failed: "), F.to_json(F.struct(*checks.columns)))).cast("boolean")
        ),
    )


def stop_unless_met(checks: DataFrame) -> None:
    """Run the checks now and raise on the first that fails, before later work is paid for."""
    failed = checks.where(~F.coalesce(F.col("ok"), F.lit(False))).first()
    if failed is not None:
        raise ValueError(f"expectation failed: {failed.asDict(recursive=True)}")

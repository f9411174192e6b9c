"""Export a split corpus as instruction JSON lines and check what was written."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from gleanmark.operators.expectations import stop_unless_met
from gleanmark.operators.instruct import anchor_presence, json_line
from gleanmark.operators.profile import first_per_split
from gleanmark.sources.jsonl import check_json_lines, write_json_lines
from gleanmark.sources.tables import count_per_split


@dataclass
class Export:
    counts: DataFrame
    bad_lines: DataFrame


def export_instructions(
    df: DataFrame,
    record: Column,
    path: str,
    splits: list[str],
    split: str = "split",
    limit: int | None = None,
    row_id: str | None = None,
    rendered: Column | None = None,
    anchor: str | None = None,
) -> Export:
    """Write one folder of JSON lines per split; returns counts and unparsable lines.

    ``limit`` keeps the first rows of each split, for smoke runs.  With ``rendered`` (the
    training text of a row) and ``anchor`` the export stops, before anything is written,
    if a text lacks the anchor behind which its answer begins.
    """
    if anchor is not None:
        stop_unless_met(anchor_presence(df, rendered, anchor, row_id))
    if limit is not None:
        df = first_per_split(df, split, row_id, limit)
    records = df.select(record.alias("record"), split)
    write_json_lines(records, "record", path, split)
    written = df.sparkSession.read.schema(f"value string, {split} string").text(path)
    return Export(
        count_per_split(written, splits, split), check_json_lines(df.sparkSession, path)
    )


def instruction_lines(df: DataFrame, record: Column, *keep: str) -> DataFrame:
    """The lines an export would write, next to ``keep``."""
    return df.select(*keep, record.alias("_r")).select(*keep, json_line("_r").alias("line"))

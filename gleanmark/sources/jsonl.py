"""JSON lines: instruction files, integrity checks, mixed logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanmark.functions.text import is_blank
from gleanmark.operators.instruct import json_line
from gleanmark.schemas import INSTRUCTION, TRAINING_LOG


def read_instructions(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """``instruction, input, output``; blank lines skipped, a missing input is empty.

    A line that is no JSON object, or lacks an instruction or an output, fails
    the job.  With ``limit`` the first lines come back, by file and place in it.
    """
    rows = spark.read.schema(INSTRUCTION).json(path, mode="FAILFAST")
    if limit is not None:
        place = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()]
        names = ["_file", "_block", "_line"]
        rows = rows.select("*", *[p.alias(n) for p, n in zip(place, names)]).orderBy(*names).limit(limit)

    def required(name: str):
        return F.coalesce(name, F.raise_error(F.lit(f"instruction line without {name!r}")).cast("string"))

    out = rows.select(
        required("instruction").alias("instruction"),
        F.coalesce("input", F.lit("")).alias("input"),
        required("output").alias("output"),
    )
    return out


def write_json_lines(df: DataFrame, record: str, path: str, split: str | None = None) -> None:
    """One record per line; with ``split`` one folder per split in a single write."""
    lines = df.select(json_line(record).alias("value"), *([split] if split else []))
    writer = lines.write.mode("overwrite")
    (writer.partitionBy(split) if split else writer).text(path)


def check_json_lines(spark: SparkSession, path: str, schema: str = INSTRUCTION) -> DataFrame:
    """Every line that does not parse: ``file, line_number, line``.

    Lines are numbered within their file from per-block counts, so files are read
    in parallel and only bad lines are joined.
    """
    probe = f"{schema}, _corrupt_record string"
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
    )
    tested = lines.withColumn(
        "bad",
        ~is_blank("value")
        & F.from_json("value", probe, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})[
            "_corrupt_record"
        ].isNotNull(),
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        lines.groupBy("file", "block")
        .agg(F.count("*").alias("n"), F.min("seq").alias("first"))
        .select("file", "block", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    )
    return (
        tested.where("bad")
        .join(blocks, ["file", "block"])
        .select(
            F.element_at(F.split("file", "/"), -1).alias("file"),
            (F.col("offset") + F.col("seq") - F.col("first") + 1).alias("line_number"),
            F.col("value").alias("line"),
        )
    )


def read_training_log(spark: SparkSession, path: str) -> DataFrame:
    """A log whose lines have different keys: absent keys are null."""
    return spark.read.schema(TRAINING_LOG).json(path)

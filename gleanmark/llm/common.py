"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import importlib.util
import math
import os
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from gleanmark.session import stage

__all__ = ["fresh_name", "importable", "in_slices", "read", "release_memory", "row_slices", "stage", "tokenizer_file"]


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver found it.

    On a cluster without that folder the package comes with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no column of it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file on this machine."""
    spec = importlib.util.find_spec("public_tokenizers")
    folder = os.path.dirname(spec.origin) if spec else "/opt/tokenizers"
    return os.path.join(folder, name)


def in_slices(texts: list[str], most_chars: int = 2_000_000) -> Iterator[list[str]]:
    """Consecutive runs of ``texts`` of bounded length, so that word lists stay small."""
    run: list[str] = []
    size = 0
    for text in texts:
        run.append(text)
        size += len(text)
        if size >= most_chars:
            yield run
            run, size = [], 0
    if run:
        yield run


def row_slices(texts: pa.Array, most_bytes: int = 2_000_000) -> Iterator[tuple[int, list[str]]]:
    """First row and texts of consecutive runs of an Arrow column, of bounded length; null is empty.

    A batch is never a Python list as a whole.
    """
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start, size = 0, 0
    for i, n in enumerate(sizes.tolist()):
        size += n
        if size >= most_bytes or i == len(sizes) - 1:
            yield start, [t or "" for t in texts.slice(start, i + 1 - start).to_pylist()]
            start, size = i + 1, 0


def release_memory() -> None:
    """Give back what a task's batches took: a worker that waits for later stages keeps it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim is not None:
        trim(0)


def power_of_two_at_least(n: float) -> int:
    return 1 << max(0, math.ceil(math.log2(max(1.0, n))))

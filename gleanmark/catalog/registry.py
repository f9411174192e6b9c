"""Named queries, each next to the DuckDB SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name; without SQL only rows are checked."""

    def register(fn: Query) -> Query:
        if fn.__name__ in REGISTRY:
            raise ValueError(f"query {fn.__name__!r} is registered twice")
        REGISTRY[fn.__name__] = Entry(fn, sql)
        return fn

    return register

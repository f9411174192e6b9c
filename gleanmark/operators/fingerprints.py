"""Trees of mergeable fingerprints, to find rows that differ without reading two tables whole.

A row falls into one of 65,536 buckets by a hash of its key, and a bucket has the count
of its rows and the sum of their hashes.  Sums of buckets merge into those of their
parents, up to one root for the table.  Two tables are compared from the root down: where
a node agrees, all below it does.  Rows are laid out by bucket, so only the folders of
buckets that differ are opened.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanmark.functions.keys import content_key
from gleanmark.session import lookup

# Hex digits of a bucket, and of the folder that holds it.
BUCKET_DIGITS = 4
FOLDER_DIGITS = 2

_WORDS = [f"_w{i}" for i in range(4)]


def _sums(grouped) -> DataFrame:
    return grouped.agg(F.sum("_n").alias("_n"), *[F.sum(w).cast("decimal(38,0)").alias(w) for w in _WORDS])


def _digest_words() -> list[Column]:
    """The row's digest as four numbers, whose sums notice a repeated row, too."""
    hexed = F.hex("_digest")
    return [F.conv(F.substring(hexed, 1 + 8 * i, 8), 16, 10).cast("decimal(20,0)").alias(w) for i, w in enumerate(_WORDS)]


def write_fingerprinted(df: DataFrame, key: Sequence[str], path: str) -> None:
    """Write ``df`` by bucket of its key, and the fingerprint of every bucket beside it.

    Null keys are values like others; rows with equal keys share a bucket.
    """
    named = [c for c in sorted(df.columns)]
    placed = df.select(
        F.struct(*df.columns).alias("row"),
        content_key(*named).alias("_digest"),
        F.substring(F.md5(content_key(*key)), 1, BUCKET_DIGITS).alias("_bucket"),
    ).withColumn("_folder", F.substring("_bucket", 1, FOLDER_DIGITS))
    ordered = placed.repartitionByRange("_bucket").sortWithinPartitions("_folder", "_bucket")
    ordered.write.partitionBy("_folder").parquet(f"{path}/rows")
    rows = df.sparkSession.read.schema(placed.schema).parquet(f"{path}/rows")
    hashed = rows.select("_bucket", F.lit(1).alias("_n"), *_digest_words())
    _sums(hashed.groupBy("_bucket")).write.parquet(f"{path}/buckets")


def _level(buckets: DataFrame, digits: int) -> DataFrame:
    """Fingerprints of the nodes of so many digits, merged from those of their buckets."""
    return _sums(buckets.groupBy(F.substring("_bucket", 1, digits).alias("_node")))


def differing_buckets(spark: SparkSession, first: str, second: str) -> DataFrame:
    """``_bucket`` of all buckets in which two fingerprinted tables differ, found from the root down.

    A level has at most 16 times the nodes that differ above it.
    """
    sides = [spark.read.parquet(f"{path}/buckets") for path in (first, second)]
    differing = None
    for digits in range(BUCKET_DIGITS + 1):
        nodes = []
        for side in sides:
            if differing is not None:
                above = differing.withColumnRenamed("_node", "_above")
                side = side.join(above, F.substring("_bucket", 1, digits - 1) == F.col("_above"), "left_semi")
            nodes.append(_level(side, digits))
        a, b = nodes
        both = a.join(b.select("_node", *[F.col(c).alias(f"{c}_b") for c in ("_n", *_WORDS)]), "_node", "full_outer")
        same = F.lit(True)
        for c in ("_n", *_WORDS):
            same &= F.col(c).eqNullSafe(F.col(f"{c}_b"))
        differing = lookup(both.where(~same).select("_node"), "differing")
        if differing.isEmpty():
            break
    return differing.withColumnRenamed("_node", "_bucket")


def differing_rows(df: DataFrame, key: Sequence[str], first: str, second: str) -> DataFrame:
    """``(*key, change)``: ``changed``, ``only_first`` or ``only_second`` for every key that differs.

    ``df`` only gives the schema of both tables.  A key that holds several rows differs if
    the rows do, in any number.
    """
    spark = df.sparkSession
    buckets = differing_buckets(spark, first, second)
    folders = [r[0] for r in buckets.select(F.substring("_bucket", 1, FOLDER_DIGITS)).distinct().collect()]  # at most 256
    schema = df.select(F.struct(*df.columns).alias("row"), F.lit(b"").alias("_digest"), F.lit("").alias("_bucket"), F.lit("").alias("_folder")).schema
    held = []
    for path, side in ((first, "a"), (second, "b")):
        rows = spark.read.schema(schema).parquet(f"{path}/rows").where(F.col("_folder").isin(folders))
        rows = rows.join(buckets, "_bucket", "left_semi")
        names = [F.col(f"row.`{k}`").alias(k) for k in key]
        held.append(rows.select(*names, F.lit(side).alias("_side"), F.lit(1).alias("_n"), *_digest_words()))
    cells = held[0].unionByName(held[1])

    def of(side: str, c: str) -> Column:
        return F.sum(F.when(F.col("_side") == side, F.col(c)))

    both = cells.groupBy(*key).agg(*[of(side, c).alias(f"{c}_{side}") for side in "ab" for c in ("_n", *_WORDS)])
    same = F.lit(True)
    for c in ("_n", *_WORDS):
        same &= F.col(f"{c}_a").eqNullSafe(F.col(f"{c}_b"))
    change = F.when(F.col("_n_b").isNull(), "only_first").when(F.col("_n_a").isNull(), "only_second").otherwise("changed")
    return both.where(~same).select(*key, change.alias("change"))

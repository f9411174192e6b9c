"""Shuffled shards of a corpus by a two-pass external shuffle.

1. Scatter: a seeded hash of id and text deals every record to one of many buckets of
   about ``BUCKET_BYTES``, evenly, as the hash is uniform.  Rows with equal id and text
   would share a hash; they are numbered first (within the written partitions, then over
   them), and the number enters the hash, so a row that repeats a billion times is
   spread like any other.
2. Shuffle: a task takes a run of buckets, one at a time, brings the records of each into
   the order of their hashes and shuffles them by Fisher-Yates, with draws that depend on
   seed and bucket alone.  It holds one bucket in memory, however many it has.

The shuffled buckets, one after the other, are a random order of the corpus.  It is cut
into shards whose counts of rows are at most one apart (the law ``rows``).  The order
depends on the rows and the seed, not on files, partitions or the order of arrival, so a
lost task is redone with the same result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanmark.llm.common import stage
from gleanmark.session import scratch_path

SHARDS = 8
SEED = 11
LAW = "rows"

# Bytes of text a bucket holds on average.
BUCKET_BYTES = 16 << 20

# The most tasks of the second pass; beyond them a task takes several buckets.
MOST_TASKS = 20_000

# Rows handed on at once, out of a shuffled bucket.
SLICE_ROWS = 2_000

_HASH_BITS = 60
_NUMBER_BITS = 33  # of monotonically_increasing_id, within a partition


def size_of(text: Column) -> Column:
    """UTF-8 bytes plus one; a null text has no bytes."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def checksum(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes; a null text counts as empty."""
    return F.crc32(F.encode(F.coalesce(text, F.lit("")), "utf-8"))


def _hash60(name: Column) -> Column:
    """60 bits of an MD5: the same in any engine."""
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long")


def scatter_hash(doc_id: Column, text: Column, seed: int) -> Column:
    """Seeded hash of a record; null differs from empty."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-"))
    return _hash60(F.concat(F.lit(f"{seed}:"), part(doc_id), F.lit(":"), part(text)))


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows whose ``hash`` others share, with a number 0, 1, 2, ... among them as ``copy``.

    A hot hash is counted by written partition; no window holds more of it than one
    partition has.
    """
    kept = stage(rows.withColumn("rid", F.monotonically_increasing_id()), "repeated-rows")
    at = F.shiftright("rid", _NUMBER_BITS)
    cells = kept.groupBy("hash", at.alias("part")).agg(F.count("*").alias("n"))
    earlier = W.partitionBy("hash").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    cells = stage(cells.select("hash", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")), "copies-before")
    place = F.row_number().over(W.partitionBy("hash", "part").orderBy("rid")) - 1
    slim = kept.select("rid", "hash", at.alias("part")).withColumn("place", place).join(cells, ["hash", "part"])
    numbers = slim.select("rid", (F.col("place") + F.col("before")).alias("copy"))
    return stage(kept.join(numbers, "rid").drop("rid"), "numbered-rows")


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A permutation of 0 to n - 1 by Fisher-Yates, from the last place down.

    The draw for place i is 60 bits of the MD5 of seed, bucket and i, modulo i + 1.
    """
    order = list(range(n))
    for i in range(n - 1, 0, -1):
        j = int(hashlib.md5(f"{seed}:{bucket}:{i}".encode()).hexdigest()[:15], 16) % (i + 1)
        order[i], order[j] = order[j], order[i]
    return np.array(order, dtype=np.int64)


def place_in_shard(position: np.ndarray, n: int, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard and slot of places in an order of ``n`` rows; the first shards have the odd rows."""
    each, odd = divmod(n, shards)
    cut = odd * (each + 1)
    first = position < cut
    past = position - cut
    shard = np.where(first, position // (each + 1), odd + past // max(1, each))
    slot = np.where(first, position % (each + 1), past % max(1, each))
    return shard, slot


def _shuffled(n: int, shards: int, seed: int):
    """Second pass over sorted rows (row, bucket, base): (row, shard, slot), bucket by bucket."""

    def shuffled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current, at = None, None

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal at
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            order = fisher_yates(len(table), seed, current)
            shard, slot = place_in_shard(at + np.arange(len(order)), n, shards)
            at += len(order)
            for i in range(0, len(order), SLICE_ROWS):
                part = slice(i, i + SLICE_ROWS)
                rows = table.column(0).take(pa.array(order[part])).combine_chunks()
                yield pa.RecordBatch.from_arrays(
                    [rows, pa.array(shard[part], pa.int32()), pa.array(slot[part], pa.int64())], ["row", "shard", "slot"]
                )

        for batch in batches:
            bucket = batch.column(1).to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if held and bucket[a] != current:
                    yield from close()
                if at is None:
                    at = batch.column(2)[a].as_py()
                current = int(bucket[a])
                held.append(batch.slice(a, b - a).select([0]))
        if held:
            yield from close()

    return shuffled


def _written(schema: T.StructType) -> T.StructType:
    kinds = [("row", schema), ("shard", T.IntegerType()), ("slot", T.LongType())]
    return T.StructType([T.StructField(name, kind) for name, kind in kinds])


def write_shards(
    docs: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
    most_tasks: int = MOST_TASKS,
) -> int:
    """Write ``docs`` in shuffled order below ``path``, a folder for each shard; the count of rows.

    Files hold (row, slot): all columns of a document in one struct, so no name can
    clash, and its place in the shard, from 0 without gaps.  Files of a shard follow each
    other by name, rows in a file by slot.  Null ids and null texts are values like
    others, repeated rows are written each, an empty table writes no shard.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.struct(*docs.columns).alias("row"),
        size_of(F.col(text)).alias("size"),
        scatter_hash(F.col(doc_id), F.col(text), seed).alias("hash"),
    )
    slim = stage(rows.select("hash", "size"), "hashes")
    facts = slim.agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).first()
    n = facts["n"]
    if not n:
        spark.createDataFrame([], _written(docs.schema)).write.parquet(path)
        return 0
    buckets = max(1, -(-facts["bytes"] // bucket_bytes))
    tasks = min(buckets, most_tasks)

    repeated = stage(slim.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "repeated")
    placed, hashes = rows.select("row", "hash"), slim.select("hash")
    if not repeated.isEmpty():
        again = _numbered(placed.join(repeated, "hash", "left_semi"))
        own = F.when(F.col("copy") > 0, _hash60(F.concat_ws(":", F.col("hash"), F.col("copy")))).otherwise(F.col("hash"))
        again = again.withColumn("hash", own).drop("copy")
        placed = placed.join(repeated, "hash", "left_anti").unionByName(again)
        hashes = hashes.join(repeated, "hash", "left_anti").unionByName(again.select("hash"))

    # The top 30 bits choose the bucket; a task takes neighbouring buckets.
    bucket = F.shiftright(F.shiftright("hash", _HASH_BITS // 2) * F.lit(buckets), _HASH_BITS // 2)
    task = F.floor(bucket * F.lit(tasks) / F.lit(buckets)).cast("int")
    sums = hashes.groupBy(task.alias("task")).agg(F.count("*").alias("n"))
    before = W.orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    # At most ``most_tasks`` rows.
    bases = stage(sums.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases")
    dealt = (
        placed.withColumn("bucket", bucket).withColumn("task", task).join(F.broadcast(bases), "task")
        .repartitionById(tasks, F.col("task")).sortWithinPartitions("bucket", "hash").select("row", "bucket", "base")
    )
    done = dealt.mapInArrow(_shuffled(n, shards, seed), _written(docs.schema))
    # In the order they come; stated, so that the writer keeps it.
    done = done.sortWithinPartitions("shard", "slot")
    done.write.option("compression", "zstd").partitionBy("shard").parquet(path)
    return n


def read_shards(spark: SparkSession, path: str, schema: T.StructType, shard: int | None = None) -> DataFrame:
    """(row, shard, slot) of all shards or of one; ``schema`` is that of the documents."""
    found = spark.read.schema(_written(schema)).parquet(path)
    return found if shard is None else found.where(F.col("shard") == shard)


def sharded(docs: DataFrame, **options) -> DataFrame:
    """(row, shard, slot) of all documents, read back from shards written to the shared folder."""
    path = scratch_path(docs.sparkSession, "shuffled-shards")
    write_shards(docs, path, **options)
    return read_shards(docs.sparkSession, path, docs.schema)

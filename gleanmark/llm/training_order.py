"""Token ids in training order, as shards of fixed-stride records.

Documents are tokenised once, closed by the end token and cut into sequences of
``length`` tokens (the last one padded).  Sequences are numbered 0 to N - 1: by the
written partition, then by their place in it, so numbering takes one sum per
partition and no shuffle; the same rows in other files get another order from a key.  A keyed Feistel permutation of [0, N) gives every number
its slot; its domain is the next power of four, and numbers that fall outside are
walked along their cycle until they come back inside.  Each slot is thus used exactly
once, by arithmetic alone, and any task can be redone with the same result.

Slots are dealt to range partitions directly, as they are spread evenly by nature,
and every partition writes its shards whole.  A shard holds ``per_shard`` records of
one stride, so a reader that stops after slot s goes on at shard s // per_shard, byte
(s % per_shard) * stride of its payload.  A payload is one binary cell of a Parquet row
group, which a reader opens whole; the byte counts from the start of the payload, not of
a file.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanmark.llm.common import stage, tokenizer_file
from gleanmark.llm.shingles import mix
from gleanmark.llm.token_counts import VOCABULARY, counter
from gleanmark.session import scratch_path

END_TOKEN = 50256
LENGTH = 512
PER_SHARD = 512
KEY = 20_240_229
ROUNDS = 6

# Records a task gathers before it numbers them and hands them on together.
FLUSH_BYTES = 4 << 20

# A record: document id, number of the sequence in it, count of true tokens, tokens.
_HEADER = np.dtype([("doc_id", "<i8"), ("part", "<i4"), ("n_tokens", "<i4")])
_NO_ID = -(1 << 63)


def record_type(length: int) -> np.dtype:
    return np.dtype([*_HEADER.descr, ("tokens", "<u2", (length,))])


def permuted(numbers: np.ndarray, n: int, key: int, rounds: int = ROUNDS) -> np.ndarray:
    """The keyed permutation of [0, n) at ``numbers``."""
    half = max(1, math.ceil(max(1, (n - 1).bit_length()) / 2))
    bits, mask = np.uint64(half), np.uint64((1 << half) - 1)
    keys = [np.uint64(int.from_bytes(hashlib.blake2b(f"{key}:{r}".encode(), digest_size=8).digest(), "little")) for r in range(rounds)]

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> bits, x & mask
        for k in keys:
            left, right = right, left ^ (mix(right ^ k) & mask)
        return (left << bits) | right

    out = once(numbers.astype(np.uint64))
    while (outside := out >= np.uint64(max(1, n))).any():
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def tokenised(docs: DataFrame, doc_id: str, text: str, vocabulary: str, end_token: int, length: int) -> DataFrame:
    """(doc_id, ids, parts, first, range): first numbers the sequences within a written partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = counter(tokenizer_file(vocabulary)), np.array([end_token], dtype="<u2").tobytes()
        if words.whole.n_vocab > 1 << 16:
            raise ValueError("16-bit records need a vocabulary below 65,536 tokens")
        at = 0
        for batch in batches:
            ids = [words.ids(t or "").astype("<u2").tobytes() + end for t in batch.column(1).to_pylist()]
            parts = np.array([-(-len(x) // (2 * length)) for x in ids], dtype=np.int64)
            first = at + np.cumsum(parts) - parts
            at += int(parts.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.binary()), pa.array(parts), pa.array(first, pa.int64())],
                ["doc_id", "ids", "parts", "first"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary, parts long, first long").withColumn(
        "range", F.spark_partition_id()
    )


def write_training_order(
    docs: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    vocabulary: str = VOCABULARY,
    end_token: int = END_TOKEN,
    length: int = LENGTH,
    per_shard: int = PER_SHARD,
    key: int = KEY,
) -> int:
    """Write shards (shard, first_slot, n_records, sha256, payload) below ``path``; the number of sequences.

    A null or empty text is a document of one sequence, the end token.  A null id is
    written as the smallest 64-bit integer.  Repeated rows are written each.  An empty
    table writes no shard.
    """
    spark = docs.sparkSession
    coded = stage(tokenised(docs, doc_id, text, vocabulary, end_token, length), "token-ids", compression="zstd")
    sums = coded.groupBy("range").agg(F.sum("parts").alias("n")).collect()  # one row per written partition
    bases, n = {}, 0
    for row in sorted(sums, key=lambda r: r["range"]):
        bases[row["range"]] = n
        n += row["n"]
    stride = record_type(length).itemsize
    shards = -(-n // per_shard)
    ranges = max(1, min(shards, max(spark.sparkContext.defaultParallelism, math.ceil(n * stride / (32 << 20)))))
    shards_each = max(1, -(-shards // ranges))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = record_type(length)
        held, numbers = [], []

        def flush() -> pa.RecordBatch:
            slots = permuted(np.concatenate(numbers), n, key)
            bounds = np.arange(len(slots) + 1, dtype=np.int64) * stride
            buffers = [None, pa.py_buffer(bounds), pa.py_buffer(b"".join(held))]
            payload = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(slots), buffers).cast(pa.binary())
            held.clear()
            numbers.clear()
            return pa.RecordBatch.from_arrays([pa.array(slots), payload], ["slot", "record"])

        size = 0
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(5)))
            for doc, ids, parts, first, place in rows:
                tokens = np.frombuffer(ids, dtype="<u2")
                out = np.zeros(parts, dtype=kind)
                padded = np.full(parts * length, end_token, dtype="<u2")
                padded[: len(tokens)] = tokens
                out["tokens"] = padded.reshape(parts, length)
                out["doc_id"], out["part"] = _NO_ID if doc is None else doc, np.arange(parts)
                out["n_tokens"] = np.minimum(length, len(tokens) - length * np.arange(parts))
                held.append(out.tobytes())
                numbers.append(bases[place] + first + np.arange(parts))
                size += parts * stride
                if size >= FLUSH_BYTES:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []

        def close() -> pa.RecordBatch:
            payload = b"".join(held)
            return pa.RecordBatch.from_pylist(
                [
                    {
                        "shard": shard, "first_slot": shard * per_shard, "n_records": len(held),
                        "sha256": hashlib.sha256(payload).hexdigest(), "payload": payload,
                    }
                ],
                schema=pa.schema([("shard", pa.int64()), ("first_slot", pa.int64()), ("n_records", pa.int64()), ("sha256", pa.string()), ("payload", pa.binary())]),
            )

        for batch in batches:
            for slot, record in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if slot // per_shard != shard:
                    if held:
                        yield close()
                    shard, held = slot // per_shard, []
                held.append(record)
        if held:
            yield close()

    sequences = coded.mapInArrow(records, "slot long, record binary")
    dealt = sequences.withColumn("to", (F.col("slot") / F.lit(per_shard * shards_each)).cast("int"))
    dealt = dealt.repartitionById(ranges, F.col("to")).sortWithinPartitions("slot").select("slot", "record")
    done = dealt.mapInArrow(
        packed, "shard long, first_slot long, n_records long, sha256 string, payload binary"
    )
    done.write.option("compression", "zstd").parquet(path)
    return n


def read_training_order(spark: SparkSession, path: str, from_slot: int = 0, length: int = LENGTH, per_shard: int = PER_SHARD) -> DataFrame:
    """Records from a slot on: (slot, shard, byte_offset, doc_id, part, n_tokens, tokens binary).

    Earlier shards are not read.
    """

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kind = record_type(length)
        for rows in batches:
            for shard, payload in zip(rows["shard"], rows["payload"]):
                found = np.frombuffer(payload, dtype=kind)
                slots = shard * per_shard + np.arange(len(found))
                ids = pd.array(found["doc_id"], dtype="Int64")
                ids[found["doc_id"] == _NO_ID] = pd.NA
                yield pd.DataFrame(
                    {
                        "slot": slots, "shard": shard, "byte_offset": np.arange(len(found)) * kind.itemsize, "doc_id": ids,
                        "part": found["part"], "n_tokens": found["n_tokens"], "tokens": [x.tobytes() for x in found["tokens"]],
                    }
                )

    shards = spark.read.schema("shard long, payload binary").parquet(path)
    if from_slot:
        shards = shards.where(F.col("shard") >= from_slot // per_shard)
    out = shards.mapInPandas(
        unpack, "slot long, shard long, byte_offset long, doc_id long, part int, n_tokens int, tokens binary"
    )
    return out.where(F.col("slot") >= from_slot) if from_slot else out


def training_order(docs: DataFrame, **options) -> DataFrame:
    """The records of all documents, read back from shards written to the shared folder."""
    path = scratch_path(docs.sparkSession, "shards")
    write_training_order(docs, path, **options)
    shape = {k: v for k, v in options.items() if k in ("length", "per_shard")}
    return read_training_order(docs.sparkSession, path, **shape)

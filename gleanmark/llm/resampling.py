"""Importance resampling towards a target distribution of hashed word runs.

A document's features are its runs of one and two words, each hashed into a bucket.  Per
bucket, the log ratio of target share to corpus share is the gain; a document weighs the
floored mean of its features' gains, and the documents of the greatest weight plus Gumbel
noise (from a hash of the id) are drawn, which samples without replacement.

Features of a batch are found at once: the texts are joined with a sentinel between them,
one pass of a regular expression finds all words, a binary search over the documents'
ends tells each word its document, and a pair of neighbours counts where both lie in one
document.  The hash of a pair comes from the hashes of its words, as CRC-32 is linear: a
prefix is carried over the bytes that follow it by tables.

Texts are read once.  The buckets of every document are written as 16-bit numbers, and
both the corpus counts and the weights come from that table.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gleanmark.llm.common import in_slices, stage

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 25
SEED = 7

# Fixed value: a word is a run of digits, a-z and whatever lies beyond ASCII, in UTF-8.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

# Between two texts; it belongs to no word.
_SENTINEL = b"\n"

_ORDER_BITS = 33  # of monotonically_increasing_id, within a partition


def _carry_step(crc: np.ndarray) -> np.ndarray:
    """CRC registers (without the final inversion) after one zero byte more."""
    return (crc >> np.uint32(8)) ^ _byte_table()[crc & np.uint32(0xFF)]


@lru_cache(maxsize=1)
def _byte_table() -> np.ndarray:
    """The table of CRC-32, from its reflected polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & np.uint32(1), (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


class Carrier:
    """Carries CRC values over bytes that follow, for all lengths met so far."""

    def __init__(self):
        plain = np.arange(256, dtype=np.uint32)
        # tables[n][k] takes byte k of a value over n bytes.
        self.tables = np.stack([np.stack([plain << np.uint32(8 * k) for k in range(4)])])

    def __call__(self, crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """What ``crc`` contributes to the CRC of a string that goes on for ``lengths`` bytes."""
        if not len(crc):
            return crc
        most = 64
        long = lengths > most
        if long.any():
            # Rare: words of more bytes are carried on in strides.
            out, left, now = crc.copy(), lengths.copy(), long.copy()
            while now.any():
                out[now] = self(out[now], np.full(int(now.sum()), most))
                left[now] -= most
                now = left > most
            return self(out, left)
        while len(self.tables) <= int(lengths.max()):
            self.tables = np.concatenate([self.tables, _carry_step(self.tables[-1])[None]])
        out = np.zeros(len(crc), dtype=np.uint32)
        for k in range(4):
            out ^= self.tables[lengths, k, (crc >> np.uint32(8 * k)) & np.uint32(0xFF)]
        return out


CARRY = Carrier()


def features(texts: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features of a batch, features per text, words per text.

    The features of a text are its words, then its pairs of neighbours, and lie together.
    """
    # UTF-8 lower-cased by bytes: A-Z only.
    raw = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
    joined = _SENTINEL.join(raw)
    spans = np.array([m.span() for m in WORD.finditer(joined)], dtype=np.int64).reshape(-1, 2)
    ends = np.cumsum(np.array([len(r) + 1 for r in raw], dtype=np.int64))
    doc = np.searchsorted(ends, spans[:, 0], side="right")
    n_words = np.bincount(doc, minlength=len(texts))
    crc = np.fromiter((zlib.crc32(joined[a:b]) for a, b in spans.tolist()), dtype=np.uint32, count=len(spans))
    lengths = spans[:, 1] - spans[:, 0]
    # A pair never reaches over a sentinel.
    paired = np.flatnonzero(doc[1:] == doc[:-1])
    blank = CARRY(np.full(len(paired), zlib.crc32(b" "), dtype=np.uint32), lengths[paired + 1])
    pair_crc = CARRY(crc[paired], lengths[paired + 1] + 1) ^ blank ^ crc[paired + 1]
    both = np.concatenate([crc, pair_crc]) % np.uint32(buckets)
    order = np.argsort(np.concatenate([doc, doc[paired]]), kind="stable")
    n_features = n_words + np.bincount(doc[paired], minlength=len(texts))
    return both[order], n_features, n_words


def hashed_features(docs: DataFrame, doc_id: str, text: str, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, features): the buckets as little-endian 16-bit numbers."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets are written as 16-bit numbers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for some in in_slices([t or "" for t in batch.column(1).to_pylist()]):
                found, n_features, n_words = features(some, buckets)
                data = found.astype("<u2").tobytes()
                edges = np.concatenate([[0], np.cumsum(2 * n_features)]).tolist()
                binary = pa.array([data[a:b] for a, b in zip(edges, edges[1:])], pa.binary())
                ids = batch.column(0).slice(at, len(some))
                at += len(some)
                yield pa.RecordBatch.from_arrays([ids, pa.array(n_words, pa.int64()), binary], ["doc_id", "n_words", "features"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, features binary")


def bucket_counts(coded: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all documents: one vector per task, summed."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, dtype=np.int64)
        for rows in batches:
            total += np.bincount(np.frombuffer(b"".join(rows["features"]), dtype="<u2"), minlength=buckets)
        held = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": held, "n": total[held]})

    return coded.select("features").mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of every bucket: thousandths of the smoothed log ratio, floored."""
    both = corpus.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).unionByName(
        target.select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t"))
    )
    every = corpus.sparkSession.range(buckets).selectExpr("id AS bucket", "0L AS s", "0L AS t")
    counted = stage(both.unionByName(every).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")), "bucket-counts")
    all_s, all_t = counted.agg(F.sum("s"), F.sum("t")).first()
    ratio = ((F.col("t") + 1.0) * F.lit(float(all_s + buckets))) / ((F.col("s") + 1.0) * F.lit(float(all_t + buckets)))
    return counted.select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain"))


def weighed(coded: DataFrame, table: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, n_features, weight): the floored mean gain of each document's features."""
    gain = np.zeros(buckets, dtype=np.int64)
    for row in table.collect():  # ``buckets`` rows
        gain[row["bucket"]] = row["gain"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n_words, held = batch.columns
            held = held.to_pylist()
            n = np.array([len(x) // 2 for x in held], dtype=np.int64)
            sums = np.cumsum(np.concatenate([[0], gain[np.frombuffer(b"".join(held), dtype="<u2")]]))
            ends = np.cumsum(n)
            weight = np.floor_divide(sums[ends] - sums[ends - n], np.maximum(n, 1))
            yield pa.RecordBatch.from_arrays(
                [ids, n_words, pa.array(n), pa.array(weight)], ["doc_id", "n_words", "n_features", "weight"]
            )

    return coded.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel variate from a hash of seed and id, floored."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; rank is null where it is not drawn.

    A null or empty text has no features and weight 0.  A null id hashes as the empty
    string and comes last among ties.  Repeated rows are documents each; rows that tie in
    score and id are ranked by their features and weight, and equal rows are
    interchangeable.  An empty table gives an empty one; an empty target gives every
    bucket the target share 1 / ``buckets``.
    """
    coded = stage(hashed_features(docs, doc_id, text, buckets), "features", compression="zstd")
    aims = target.select(F.lit(None).cast("long").alias("doc_id"), F.col(target_text).alias("text"))
    aimed = bucket_counts(hashed_features(aims, "doc_id", "text", buckets), buckets)
    table = gains(bucket_counts(coded, buckets), aimed, buckets)
    scored = weighed(coded, table, buckets)
    scored = scored.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)).withColumn("open", F.col("n_words") >= least_words)
    scored = stage(scored.withColumn("rid", F.monotonically_increasing_id()), "scores")
    n, n_open = scored.agg(F.count("*"), F.count_if("open")).first()
    drawn = percent * n_open // 100

    # One range-sorted table; a rank is the rows of the ranges before and the place within.
    ranges = max(1, int(n**0.5) // 8)
    order = [F.desc("open"), F.desc("score"), F.asc_nulls_last("doc_id"), "n_features", "weight", "rid"]
    queue = stage(
        scored.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
        .select("doc_id", "n_features", "weight", "score", F.monotonically_increasing_id().alias("place")),
        "queue",
    )
    queue = queue.withColumn("range", F.shiftright("place", _ORDER_BITS))
    sums = queue.groupBy("range").agg(F.count("*").alias("n"))
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    # One row per range.
    bases = stage(sums.select(F.col("range").alias("r"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases")
    within = F.col("place").bitwiseAND(F.lit((1 << _ORDER_BITS) - 1))
    rank = F.col("base") + within + 1
    return queue.join(bases, F.col("range") == F.col("r")).select(
        "doc_id", "n_features", "weight", "score", F.when(rank <= drawn, rank).alias("rank")
    )


def drawn_documents(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that are drawn, columns unchanged; ids must be unique and not null."""
    found = resample(docs, target, doc_id=doc_id, **options).where("rank is not null")
    ids = stage(found.select(F.col("doc_id").alias(doc_id)), "drawn")
    return docs.join(ids, docs[doc_id].cast("long") == ids[doc_id], "left_semi")

"""Alignment of two tokenizers over a corpus, with counts of linked token pairs.

Both tokenizers cut the same bytes, a space and the text.  Places where both have a token
end cut a document into groups; the tokens that end there together are linked.  Where a
group is one token on each side, both spell the same bytes, and nearly all such links
join a token of A to the one token of B that a table names beforehand (``same``).  They
need no pair: a link is known by its A id alone, is stored as that id, and the corpus
counts them in one vector of the length of A's vocabulary.  All other links are irregular.
They are stored as pairs, once per document with a count, and only they are shuffled.

Texts are encoded once: the links of every document are written with its digests, and
counts, best pairs and sums per document come from that table.  Pairs that make up a
noticeable share of the rows are few by arithmetic; they are broadcast, and the rest is
joined by key, so no pair gathers in one task.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanmark.llm.common import in_slices, stage, tokenizer_file
from gleanmark.llm.token_counts import byte_alphabet, counter

VOCABULARY_A = "byte_bpe_50k.json"
VOCABULARY_B = "piece_bpe_32k.model"

# A pair in more than one of so many rows is hot; there are at most so many of them.
MOST_HOT = 20_000

_LINKED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "regular binary, pairs array<long>, times array<long>"
)

# How the decimal id of a token goes on within the text of the groups.
_ENDINGS = (b",", b"|", b";")


class Pair:
    """Both tokenizers, the bytes of their tokens and the table of equal ones."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks fill the cores
        self.first = counter(path_a)
        self.library = _plain_library(path_a)
        self.second = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = byte_alphabet()
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        added = {t.content for t in self.library.get_added_tokens_decoder().values()}
        for token, i in vocab.items():
            self.bytes_a[i] = token.encode() if token in added else bytes(map(alphabet.__getitem__, token))
        model = self.second
        self.bytes_b = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
        self.length_a = np.array(list(map(len, self.bytes_a)), dtype=np.int64)
        self.length_b = np.array(list(map(len, self.bytes_b)), dtype=np.int64)
        # Where several tokens of B spell the same bytes, the last that is no byte token stands for them.
        spelled = {}
        for i, x in enumerate(self.bytes_b):
            if not model.is_control(i) and not model.is_unknown(i):
                spelled[x] = i
        self.same = np.array([spelled.get(x, -1) for x in self.bytes_a], dtype=np.int64)
        most = max(len(self.bytes_a), len(self.bytes_b))
        self.written = [str(i).encode() + end for i in range(most) for end in _ENDINGS]

    def ids_a(self, text: str) -> np.ndarray:
        """Ids of a space and the text; strings of special tokens are plain text."""
        try:
            return self.first.whole.encode_to_numpy(" " + text, disallowed_special=())
        except ValueError:  # a run of blanks beyond the stack of its pattern matcher
            return np.array(self.library.encode(" " + text, add_special_tokens=False).ids, dtype=np.uint32)

    def links(self, texts: list[str]) -> Iterator[tuple]:
        """Per text: counts of A's and B's tokens, A's and B's id of each link, whether it is regular, groups as text.

        A text whose tokens do not spell it has none.
        """
        coded_b = self.second.encode(texts, num_threads=1) if texts else []
        for text, b in zip(texts, coded_b):
            whole = b" " + text.encode()
            a = self.ids_a(text) if text else np.empty(0, dtype=np.uint32)
            spelled = text and b"".join(map(self.bytes_a.__getitem__, a.tolist())) == whole
            if not spelled or b"".join(map(self.bytes_b.__getitem__, b)) != whole:
                yield 0, 0, _NO_IDS, _NO_IDS, np.empty(0, dtype=bool), b""
                continue
            a, b = a.astype(np.int64), np.array(b, dtype=np.int64)
            yield len(a), len(b), *self._grouped(a, b)

    def _grouped(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        # No token is empty, so ends rise on both sides and a place has one token of each.
        at = np.searchsorted(end_b, end_a)
        last_a = np.flatnonzero(end_b[np.minimum(at, len(end_b) - 1)] == end_a)
        last_b = at[last_a]
        linked_a, linked_b = a[last_a], b[last_b]
        alone = (np.diff(last_a, prepend=-1) == 1) & (np.diff(last_b, prepend=-1) == 1)
        regular = alone & (self.same[linked_a] == linked_b)
        # Each side's tokens go to their places in the text of the groups.
        codes = np.empty(len(a) + len(b), dtype=np.int64)
        kind_a, kind_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
        kind_a[last_a], kind_b[last_b] = 1, 2
        group_a = np.cumsum(kind_a > 0) - (kind_a > 0)
        group_b = np.cumsum(kind_b > 0) - (kind_b > 0)
        upto_a, upto_b = last_a + 1, np.concatenate([[0], last_b + 1])
        codes[np.arange(len(a)) + upto_b[group_a]] = 3 * a + kind_a
        codes[np.arange(len(b)) + upto_a[group_b]] = 3 * b + kind_b
        text = b"".join(map(self.written.__getitem__, codes.tolist()))[:-1]
        return linked_a, linked_b, regular, text


_NO_IDS = np.empty(0, dtype=np.int64)


def _plain_library(path: str):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    library.no_truncation()
    library.no_padding()
    return library


@lru_cache(maxsize=2)
def pair(path_a: str, path_b: str) -> Pair:
    """One pair per worker and files."""
    return Pair(path_a, path_b)


def linked(docs: DataFrame, doc_id: str, text: str, a: str = VOCABULARY_A, b: str = VOCABULARY_B) -> DataFrame:
    """Per document an own number, its counts, the digest of its groups, A ids of regular links and irregular pairs with their counts.

    A pair is A's id times 2^32 plus B's id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(tokenizer_file(a), tokenizer_file(b))
        for batch in batches:
            at = 0
            for some in in_slices([t or "" for t in batch.column(1).to_pylist()], 1_000_000):
                counts, digests, regular, pairs, times = [], [], [], [], []
                for n_a, n_b, link_a, link_b, plain, groups in both.links(some):
                    counts.append((n_a, n_b, len(link_a)))
                    digests.append(hashlib.sha256(groups).hexdigest() if groups else "")
                    regular.append(link_a[plain].astype("<u4").tobytes())
                    odd, n = np.unique((link_a[~plain] << 32) | link_b[~plain], return_counts=True)
                    pairs.append(odd)
                    times.append(n)
                n_a, n_b, n_links = (pa.array(x, pa.int64()) for x in zip(*counts))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(some)), n_a, n_b, n_links, n_links, pa.array(digests),
                        pa.array(regular, pa.binary()), _lists(pairs), _lists(times),
                    ],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "regular", "pairs", "times"],
                )
                at += len(some)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, _LINKED).withColumn("rid", F.monotonically_increasing_id())


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(arrays), pa.int64()))


def regular_counts(links: DataFrame, size: int) -> DataFrame:
    """(a, n): how many regular links each A id has, from one vector per task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            ids = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype="<u4")
            total += np.bincount(ids, minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["a", "n"])

    return links.select("regular").mapInArrow(count, "a long, n long").groupBy("a").agg(F.sum("n").alias("n"))


def align(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    a: str = VOCABULARY_A,
    b: str = VOCABULARY_B,
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    A null or empty text has no tokens: zeros and an empty digest; so has one that the
    tokens of either side do not spell.  Null ids and repeated rows are documents each.
    An empty table gives an empty one.
    """
    both = pair(tokenizer_file(a), tokenizer_file(b))
    same, size = both.same, len(both.same)
    links = stage(linked(docs, doc_id, text, a, b), "links", compression="zstd")

    # Vectors of the length of the vocabularies: bounded, whatever the corpus.
    regular = np.zeros(size, dtype=np.int64)
    for row in regular_counts(links, size).collect():
        regular[row["a"]] = row["n"]
    odd = links.select("rid", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("rid", "p.pairs", "p.times")
    counted = odd.groupBy("pairs").agg(F.sum("times").alias("n"), F.count("*").alias("rows"))
    counted = stage(counted.withColumn("b", F.col("pairs").bitwiseAND(F.lit((1 << 32) - 1))), "pair-counts")
    best = np.zeros(len(both.bytes_b), dtype=np.int64)
    np.maximum.at(best, same[same >= 0], regular[same >= 0])
    for row in counted.groupBy("b").agg(F.max("n").alias("n")).collect():  # one row per token of B
        best[row["b"]] = max(best[row["b"]], row["n"])
    is_best = (regular > 0) & (regular == best[np.maximum(same, 0)])

    def plain_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(x, dtype="<u4") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([int(is_best[x].sum()) for x in ids], pa.int64()),
                    pa.array([int(regular[x].sum()) for x in ids], pa.int64()),
                ],
                ["rid", "n_best", "count_sum"],
            )

    sums = links.select("rid", "regular").mapInArrow(plain_sums, "rid long, n_best long, count_sum long")
    spark = docs.sparkSession
    tops = stage(spark.createDataFrame([(i, int(n)) for i, n in enumerate(best)], "b long, top long"), "best")
    known = stage(
        counted.join(F.broadcast(tops), "b").select("pairs", "n", "rows", (F.col("n") == F.col("top")).cast("long").alias("is_best")),
        "pairs",
    )
    n_rows = known.agg(F.sum("rows")).first()[0] or 0
    is_hot = F.col("rows") * MOST_HOT > n_rows
    hot, rest = known.where(is_hot).drop("rows"), known.where(~is_hot).drop("rows")
    common = odd.join(F.broadcast(hot), "pairs")
    others = odd.join(F.broadcast(hot.select("pairs")), "pairs", "left_anti").join(rest, "pairs")
    more = common.unionByName(others).select("rid", (F.col("times") * F.col("is_best")).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum"))
    each = sums.unionByName(more).groupBy("rid").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    slim = links.select("rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    return slim.join(each, "rid").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def pair_counts(links: DataFrame, a: str = VOCABULARY_A, b: str = VOCABULARY_B) -> DataFrame:
    """(a, b, n): every id pair that ``linked`` documents hold, and how many links hold it."""
    both = pair(tokenizer_file(a), tokenizer_file(b))
    same = links.sparkSession.createDataFrame(
        [(i, int(x)) for i, x in enumerate(both.same) if x >= 0], "a long, b long"
    )
    plain = regular_counts(links, len(both.same)).join(F.broadcast(same), "a").select("a", "b", "n")
    odd = links.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).groupBy("p.pairs").agg(F.sum("p.times").alias("n"))
    return plain.unionByName(
        odd.select(F.shiftright("pairs", 32).alias("a"), F.col("pairs").bitwiseAND(F.lit((1 << 32) - 1)).alias("b"), "n")
    )

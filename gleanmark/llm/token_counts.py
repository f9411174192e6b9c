"""Token counts of whole texts, with huge documents cut and spliced.

A document above ``long_chars`` is cut into overlapping chunks that are encoded
apart, with offsets.  Two chunks are spliced at a place in their overlap at which
both begin a new word of the tokenizer.  Such a place is proven stable: tokens never
reach over a word's border, and the splitting pattern reads from left to right and
looks at nothing behind it, so two runs that share one border share all that follow.
Near its cut end a chunk is not trusted: its last word, and anything within the
length of a special string, may change with the text that was cut off.  Where two
chunks share no such place, the document is cut again with chunks and overlaps
``widen`` times as large, at last as one chunk.

Shorter documents are encoded whole, by a second public encoder over the same file: its
ranks are the file's merges, its pattern the byte-level one.  ``Counter`` refuses files
whose token numbers do not follow the order of their merges; the tests hold both encoders
against each other on every token of the file and on every code point.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanmark.llm.common import stage, tokenizer_file

VOCABULARY = "byte_bpe_50k.json"
LONG_CHARS = 48_000
CHUNK_CHARS = 24_000
OVERLAP_CHARS = 600
WIDEN = 4

# Fixed value: the pattern by which byte-level tokenizers split a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level files: printing Latin-1 stands for itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = sorted(set(range(0x100)).difference(plain))
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Counter:
    """A byte-level tokenizer file, for whole texts and for chunks with their borders."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks fill the cores
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split, model = spec["pre_tokenizer"] or {}, spec["model"]
        if spec["normalizer"] or split.get("type") != "ByteLevel" or not split["use_regex"] or split["add_prefix_space"]:
            raise ValueError("borders are proven for byte-level files with their own pattern only")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in spec["added_tokens"]):
            raise ValueError("special strings must be plain and without blanks")
        vocab = model["vocab"]
        merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if any(b <= a for a, b in zip(merged, merged[1:])):
            raise ValueError("tokens must be numbered in the order of their merges")
        self.tokenizer = Tokenizer.from_file(path)
        self.margin = max((len(t["content"]) for t in spec["added_tokens"]), default=1)
        self.specials = {t["id"] for t in spec["added_tokens"]}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        alphabet = byte_alphabet()
        self.whole = tiktoken.Encoding(
            path,
            pat_str=PATTERN,
            mergeable_ranks={bytes(map(alphabet.__getitem__, t)): i for t, i in vocab.items() if t not in special},
            special_tokens=special,
        )

    def ids(self, text: str):
        """Token ids of a whole text, as unsigned 32-bit integers."""
        try:
            return self.whole.encode_to_numpy(text, allowed_special="all")
        except ValueError:  # a run of blanks beyond the stack of its pattern matcher
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def borders(self, text: str) -> tuple[int, list[tuple[int, int]]]:
        """Token count of a chunk, and the places where words begin with the tokens before each."""
        e = self.tokenizer.encode(text, add_special_tokens=False)
        places, last = [], None  # each property of an encoding is a new list
        for i, ((start, _), token, word) in enumerate(zip(e.offsets, e.ids, e.word_ids)):
            if token in self.specials:
                word = ("special", i)
            if i and word != last:
                places.append((start, i))
            last = word
        return len(e), places


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One counter per worker and file."""
    return Counter(path)


def short_count(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Tokens of a text that is encoded in one task; null counts as empty."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = counter(tokenizer_file(vocabulary))
        for texts in batches:
            yield pd.Series([len(c.ids(t)) for t in texts.fillna("")], dtype="int64")

    return run(text)


def _chunks(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """Rows (h, k, start, last, piece): chunk k begins at k * chunk and overlaps the next."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for h, text in zip(rows["h"], rows["text"]):
                n = max(1, -(-len(text) // chunk))
                for a in range(0, n, 64):
                    ks = range(a, min(n, a + 64))
                    yield pd.DataFrame(
                        [(h, k, k * chunk, k == n - 1, text[k * chunk : (k + 1) * chunk + overlap]) for k in ks],
                        columns=["h", "k", "start", "last", "piece"],
                    )

    return texts.mapInPandas(cut, "h binary, k long, start long, last boolean, piece string")


def _encoded(chunks: DataFrame, overlap: int, vocabulary: str) -> DataFrame:
    """Per chunk its token count, and offset -> tokens before it for both of its overlaps."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = counter(tokenizer_file(vocabulary))
        for rows in batches:
            out = []
            for h, k, start, last, piece in rows.itertuples(index=False):
                n, places = c.borders(piece)
                trusted = len(piece) - c.margin
                # The last word may go on in the text that was cut off.
                inner = places if last else [p for p in places[:-1] if p[0] <= trusted]
                head = [p for p in inner if 0 < p[0] <= overlap] if k else []
                tail = [] if last else [p for p in inner if p[0] >= len(piece) - overlap]
                out.append(
                    (h, k, n, last, {start + p: i for p, i in head}, {start + p: i for p, i in tail})
                )
            yield pd.DataFrame(out, columns=["h", "k", "n", "last", "head", "tail"])

    return chunks.mapInPandas(
        run, "h binary, k long, n long, last boolean, head map<long,long>, tail map<long,long>"
    )


def long_counts(
    texts: DataFrame,
    vocabulary: str = VOCABULARY,
    chunk: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
    widen: int = WIDEN,
) -> DataFrame:
    """(h, n_tokens) for distinct huge texts given as (h, text), by cutting and splicing.

    A chunk must be more than twice as long as its overlap, so that its two splices
    come in order.
    """
    if chunk <= 2 * overlap:
        raise ValueError("a chunk must be longer than two overlaps")
    spark, done, left = texts.sparkSession, [], texts
    while True:
        # The pieces are dealt out, so one huge document occupies many tasks.
        pieces = _chunks(left, chunk, overlap).repartition("h", "k")
        coded = stage(_encoded(pieces, overlap, vocabulary), "chunks")
        after = coded.select("h", (F.col("k") - 1).alias("k"), F.col("head").alias("next_head"))
        joint = F.array_max(F.array_intersect(F.map_keys("tail"), F.map_keys("next_head")))
        spliced = coded.join(after, ["h", "k"], "left").withColumn("at", joint)
        # Each chunk counts up to its splice; the next one's tokens before it are taken off.
        part = F.when(F.col("last"), F.col("n")).otherwise(
            F.element_at("tail", F.col("at")) - F.element_at("next_head", F.col("at"))
        )
        found = stage(
            spliced.groupBy("h").agg(
                F.sum(part).alias("n_tokens"),
                F.bool_or(~F.col("last") & F.col("at").isNull()).alias("open"),
            ),
            "spliced",
        )
        done.append(found.where("not open").select("h", "n_tokens"))
        if found.where("open").isEmpty():
            break
        left = left.join(found.where("open").select("h"), "h", "left_semi")
        chunk, overlap = chunk * widen, overlap * widen
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def token_counts(
    docs: DataFrame,
    text: str = "text",
    vocabulary: str = VOCABULARY,
    limit: int = 512,
    long_chars: int = LONG_CHARS,
    **cutting: int,
) -> DataFrame:
    """All columns of ``docs`` but the text, with ``n_bytes``, ``n_tokens`` and ``over_limit``.

    A null text counts as empty: no bytes, no tokens.  Repeated rows get their count
    each; huge texts that are equal are cut once.  Columns of ``docs`` named like a
    result are replaced.
    """
    results = {"n_bytes", "n_tokens", "over_limit", text.lower()}
    others = [c for c in docs.columns if c.lower() not in results]
    whole = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(*others, whole.alias("text"))
    short = base.where(F.char_length("text") <= long_chars).select(
        *others, F.octet_length("text").cast("long").alias("n_bytes"), short_count(F.col("text"), vocabulary).alias("n_tokens")
    )
    huge = base.where(F.char_length("text") > long_chars).select(
        *others, "text", F.unhex(F.sha2("text", 256)).alias("h")
    )
    if huge.isEmpty():
        out = short
    else:
        # One text for each key; repeated huge texts are encoded once.
        texts = huge.groupBy("h").agg(F.any_value("text").alias("text"))
        counted = long_counts(texts, vocabulary, **cutting)
        out = short.unionByName(
            huge.select(*others, F.octet_length("text").cast("long").alias("n_bytes"), "h").join(counted, "h").drop("h")
        )
    return out.withColumn("over_limit", F.col("n_tokens") > limit)

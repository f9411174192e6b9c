"""Exact byte-pair encoding by backtracking, and decoding from an offset table.

A sequence of tokens is the merge result of a word exactly when every two
neighbours are *compatible*: merging their joined symbols gives the two tokens
back.  The encoder therefore never replays merges.  One pass of an Aho-Corasick
automaton of the reversed tokens over the reversed word gives, for each place, the
longest token that begins there, and a table the next shorter one that it begins with;
a pair-compatibility table accepts or rejects each beside its left neighbour, and a place from which no token fits is marked
dead and never tried again, so that the work is linear in the word.  The pair table is
filled as pairs turn up, each by undoing merges across the border.

Normalisation and the split into words are the vocabulary file's own components;
both treat every blank-separated unit by itself, so units are encoded once per
task and looked up afterwards.  A unit of printing ASCII needs of them no more than
lower case and the file's word pattern.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanmark.llm.common import in_slices, release_memory, row_slices, tokenizer_file

VOCABULARY = "word_bpe_49k.json"

# Units (and words) whose ids a task remembers in each of two generations: when the
# younger is full it becomes the older, and what is met again moves back.  A worker keeps
# none of them when its task ends.
MOST_UNITS = 300_000

# A final symbol with an end-of-word mark is one symbol; it is moved here.
_END = 0xF0000

_WHITE = re.compile(r"\s")

_ENCODED = "n_tokens long, ids binary"


class PairTable:
    """Which tokens may stand side by side, learnt as pairs turn up."""

    def __init__(self, ranks: dict[tuple[int, int], int], made: dict[int, tuple[int, int]], order: dict[int, int]):
        self.rank_of_pair = ranks  # (left, right) -> rank of the merge
        self.parts = made  # token -> the two it is merged from
        self.order = order  # token -> rank of the merge that makes it, -1 for a symbol
        self.known: dict[tuple[int, int], bool] = {}

    def __call__(self, left: int, right: int) -> bool:
        pair = (left, right)
        found = self.known.get(pair)
        if found is None:
            if len(self.known) >= 250_000:
                self.known.clear()
            found = self.known[pair] = self._apart(left, right)
        return found

    def _apart(self, left: int, right: int) -> bool:
        """Undo the later of the two merges at the border, again and again.

        At any moment ``left`` and ``right`` are the tokens at the border as they
        stood before the merges undone so far.  If the two could have merged
        before the earliest of those, they would have.  Of merges of one rank the
        one further left comes first.
        """
        until, strict = 1 << 60, True
        while True:
            rank = self.rank_of_pair.get((left, right))
            if rank is not None and (rank < until or rank == until and not strict):
                return False
            a, b = self.order[left], self.order[right]
            if a < 0 and b < 0:
                return True
            if a > b:
                # Left of the border: a merge of this rank there goes before one across it.
                until, strict, left = a, True, self.parts[left][1]
            else:
                # Right of the border: a merge of this rank across it goes first.
                until, strict, right = b, False, self.parts[right][0]


def _ascii_pattern(spec: dict):
    """The file's word pattern, if a printing ASCII unit is lower-cased and split by it alone; else None."""
    import regex

    parts = (spec["normalizer"] or {}).get("normalizers", [])
    blanks = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
    split, *rest = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    kept = split.get("type") == "Split" and split["behavior"] == "Removed" and split["invert"]
    byte_level = [r["type"] == "ByteLevel" and not r["use_regex"] and not r["add_prefix_space"] for r in rest]
    if parts != [{"type": "NFC"}, blanks, {"type": "Lowercase"}] or not kept or byte_level != [True]:
        return None
    return regex.compile(split["pattern"]["Regex"])


class Encoder:
    """Vocabulary, automaton, pair table and offset table of one file."""

    def __init__(self, path: str):
        import ahocorasick
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        suffix = model["end_of_word_suffix"] or ""
        if model["type"] != "BPE" or model["continuing_subword_prefix"] or model["unk_token"] or model["dropout"]:
            raise ValueError("expected plain byte-pair merges")
        vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]

        def joined(a: str, b: str) -> str:
            return (a[: -len(suffix)] if suffix and a.endswith(suffix) and a != suffix else a) + b

        ranks, made, order = {}, {}, dict.fromkeys(vocab.values(), -1)
        for rank, (a, b) in enumerate(merges):
            token = vocab[joined(a, b) if suffix and a.endswith(suffix) else a + b]
            ranks[vocab[a], vocab[b]] = rank
            if token not in made:
                made[token], order[token] = (vocab[a], vocab[b]), rank
        self.suffix = suffix
        self.compatible = PairTable(ranks, made, order)
        # A merged token counts only where merging its parts gives it back.
        self.tokens = {self._symbols(token): i for token, i in vocab.items() if i not in made or self._is_reached(i)}
        self.automaton = ahocorasick.Automaton()
        for symbols, i in self.tokens.items():
            self.automaton.add_word(symbols[::-1], i)
        self.automaton.make_automaton()
        self.length = {i: len(symbols) for symbols, i in self.tokens.items()}
        self.shorter = {i: self._shorter(symbols) for symbols, i in self.tokens.items()}

        self.library = Tokenizer.from_file(path)
        self.normalize = self.library.normalizer.normalize_str
        self.pre_tokenize = self.library.pre_tokenizer.pre_tokenize_str
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.specials.items()}
        # Offset table: token i is written as table[offsets[i]:offsets[i + 1]].
        # The file names no decoder, so tokens are joined by one blank.
        if spec.get("decoder") is not None:
            raise ValueError("expected a vocabulary without a decoder")
        spelled = [names.get(i, "").encode() + b" " for i in range(max(names) + 1)]
        self.table = np.frombuffer(b"".join(spelled), dtype=np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(x) for x in spelled])]).astype(np.int64)
        self.pattern = _ascii_pattern(spec)
        self.any_special = re.compile("|".join(map(re.escape, self.specials)) or "(?!)")
        self.units: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _symbols(self, token: str) -> str:
        if self.suffix and token.endswith(self.suffix) and len(token) > len(self.suffix):
            body = token[: -len(self.suffix)]
            return body[:-1] + chr(_END + ord(body[-1]))
        return token

    def _is_reached(self, token: int) -> bool:
        """Whether the parts of a token stay apart until its own merge."""
        left, right = self.compatible.parts[token]
        rank = self.compatible.order[token]
        held = self.compatible.rank_of_pair.pop((left, right))
        apart = self.compatible._apart(left, right)
        self.compatible.rank_of_pair[left, right] = held
        return held == rank and apart

    def word(self, word: str) -> list[int]:
        """Tokens of one word (already in the vocabulary's byte alphabet)."""
        symbols = word[:-1] + chr(_END + ord(word[-1])) if self.suffix else word
        token = self.tokens.get(symbols)
        if token is not None:
            return [token]
        length, shorter, known = self.length, self.shorter, self.compatible.known
        path: list[int] = []
        at, left, dead = 0, None, bytearray(len(symbols) + 1)
        longest = self._longest(symbols)
        token = longest[0]
        while True:
            while token is not None:
                to = at + length[token]
                if not dead[to]:
                    if left is None:
                        break
                    fits = known.get((left, token))
                    if self.compatible(left, token) if fits is None else fits:
                        break
                token = shorter[token]
            if token is None:
                dead[at] = 1
                if left is None:
                    raise ValueError(f"no tokens for {word!r}")
                path.pop()
                at -= length[left]
                token, left = shorter[left], path[-1] if path else None
                continue
            path.append(token)
            if to == len(symbols):
                return path
            at, left = to, token
            token = longest[at]

    def _shorter(self, symbols: str) -> int | None:
        """The longest token that a token begins with, itself apart."""
        shorter = (self.tokens.get(symbols[:n]) for n in range(len(symbols) - 1, 0, -1))
        return next((token for token in shorter if token is not None), None)

    def _longest(self, symbols: str) -> list[int | None]:
        """For each place the longest token that begins there, from one pass from the end."""
        last, seen = len(symbols) - 1, -1
        found: list[int | None] = [None] * len(symbols)
        for end, token in self.automaton.iter(symbols[::-1]):
            if end != seen:  # of the matches that end at a place the longest comes first
                found[last - end] = token
                seen = end
        return found

    def _split(self, piece: str) -> list[str]:
        """Words of a piece without special strings, in the byte alphabet."""
        if self.pattern and piece.isascii() and piece.isprintable():
            return self.pattern.findall(piece.lower())
        return [word for word, _ in self.pre_tokenize(self.normalize(piece))]

    def _split_all(self, pieces: list[str]) -> list[list[str]]:
        """``_split`` for pieces without white space, which are joined by blanks for one call."""
        normal = self.normalize(" ".join(pieces))
        lengths = [len(x) + 1 for x in normal.split(" ")]
        if len(lengths) != len(pieces):
            return [self._split(x) for x in pieces]
        words: list[list[str]] = [[] for _ in pieces]
        at, end = 0, lengths[0]
        for word, (start, _) in self.pre_tokenize(normal):
            while start >= end:
                at += 1
                end += lengths[at]
            words[at].append(word)
        return words

    def unit(self, unit: str) -> bytes:
        """Ids of a blank-free stretch of text, as little-endian 32-bit integers."""
        if not self.any_special.search(unit):
            return b"".join(map(self._word_ids, self._split(unit)))
        return b"".join(
            b"".join(map(self._word_ids, self._split(piece))) if special is None else struct.pack("<I", special)
            for piece, special in self._around_specials(unit)
        )

    def _learn(self, new: list[str]) -> None:
        """Encode units and remember them."""
        together = []
        for unit in new:
            if unit.isascii() or self.any_special.search(unit) or _WHITE.search(unit):
                self.units[unit] = self.unit(unit)
            else:
                together.append(unit)
        if together:
            for unit, words in zip(together, self._split_all(together)):
                self.units[unit] = b"".join(map(self._word_ids, words))

    def _word_ids(self, word: str) -> bytes:
        known = self.words.get(word)
        if known is None:
            if len(self.words) >= MOST_UNITS:
                self.words.clear()
            ids = self.word(word)
            known = self.words[word] = struct.pack(f"<{len(ids)}I", *ids)
        return known

    def _around_specials(self, unit: str) -> Iterator[tuple[str, int | None]]:
        while self.any_special.search(unit):
            found = min(((unit.find(s), s) for s in self.specials if s in unit))
            at, special = found
            yield unit[:at], None
            yield special, self.specials[special]
            unit = unit[at + len(special) :]
        yield unit, None

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        for some in in_slices(texts, 500_000):
            split = [t.replace("\n", " ").replace("\t", " ").split(" ") for t in some]
            seen = set().union(*split)
            new = seen.difference(self.units)
            if len(self.units) + len(new) > MOST_UNITS:
                self.older, self.units, new = self.units, {}, seen
            again = new.intersection(self.older)
            self.units.update(zip(again, map(self.older.__getitem__, again)))
            self._learn(list(new.difference(again)))
            for units in split:
                yield b"".join(map(self.units.__getitem__, units))

    def forget(self) -> None:
        """Drop what was remembered of the texts."""
        self.units, self.older, self.words = {}, {}, {}
        self.compatible.known.clear()
        release_memory()

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 of the tokens joined by a blank, gathered from the offset table."""
        tokens = np.frombuffer(ids, dtype="<u4")
        if not len(tokens):
            return b""
        starts, lengths = self.offsets[tokens], self.offsets[tokens + 1] - self.offsets[tokens]
        ends = np.cumsum(lengths)
        places = np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1])
        return self.table[places[:-1]].tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    return Encoder(path)


def encode(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Struct of ``n_tokens`` and ``ids`` (little-endian 32-bit integers); null counts as empty.

    Any text is taken whole.  The empty text has no tokens and empty ids.
    """

    @F.pandas_udf(_ENCODED)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer_file(vocabulary))
        for texts in batches:
            ids = list(enc.encode(texts.fillna("").tolist()))
            yield pd.DataFrame({"n_tokens": [len(x) // 4 for x in ids], "ids": ids})
        enc.forget()

    return run(text)


def decode(ids: Column, vocabulary: str = VOCABULARY) -> Column:
    """The text that ids spell, as the vocabulary file's own decoder gives it; null stays null."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(tokenizer_file(vocabulary))
        for some in batches:
            yield some.map(lambda x: enc.decode(x).decode(), na_action="ignore")

    return run(ids)


def encoded_documents(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", vocabulary: str = VOCABULARY, keep_ids: bool = False
) -> DataFrame:
    """One row per document: its id, token count and the digests of ids and decoded text (and the ids, if kept).

    Rows are independent of each other: null ids, repeated rows and further columns
    change nothing, an empty table gives an empty one.  A batch is encoded in slices that
    are handed on one by one.
    """
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if keep_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_file(vocabulary))
        for batch in batches:
            for start, texts in row_slices(batch.column(1)):
                ids = list(enc.encode(texts))
                columns = [
                    batch.column(0).slice(start, len(ids)),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                    pa.array([hashlib.sha256(enc.decode(x)).hexdigest() for x in ids]),
                    *([pa.array(ids, pa.binary())] if keep_ids else []),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)
        enc.forget()

    kind = docs.schema[doc_id].dataType.simpleString()
    digests = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * keep_ids
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id {kind}, {digests}")

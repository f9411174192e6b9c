"""Short items found inside longer documents, by winnowed fingerprints.

An item lies in a document where a run of consecutive words of it stands there word for
word, and the run covers at least ``least_share`` of the item.  For each such pair the
longest run is reported.

1. Both sides become words, and every ``gram`` neighbouring words one hash.  A hash is a
   fingerprint if it is the least of some ``window`` neighbours (winnowing), so a run that
   two texts share has a fingerprint, at the same place of the run, in each ``window`` of
   its grams.
2. A run that is long enough thus holds a known number c of an item's S fingerprints.  Any
   S - c + 1 of them meet every such run, and the index takes the rarest ones, by how often
   the documents hold them.
3. Documents meet the index on the fingerprint alone.  A fingerprint that many documents
   hold is salted: its index rows are repeated, its places dealt over the copies.
4. A meeting fixes how item and document lie beside each other; the words are then
   compared along that diagonal, and the longest run of equal ones is the answer.  Hashes
   only find candidates.

Items whose least run is below ``gram + window - 1`` words are looked up by the hash of
as many words as their run has, at every place, so no item is too short to be found.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanmark.functions.text import _col, collapse_whitespace
from gleanmark.operators.salting import SALT_ROWS, salted_join
from gleanmark.session import lookup, stage

GRAM = 5
WINDOW = 4
LEAST_SHARE = 0.8

# Hashes of words that a task works on at a time.
SLICE_VALUES = 1 << 20


def words_of(text: str | Column) -> Column:
    """Lower-case words between white space; a null or blank text has none."""
    whole = F.lower(collapse_whitespace(F.coalesce(_col(text), F.lit(""))))
    return F.filter(F.split(whole, " "), lambda w: w != "")


def _by_lists(work, kind: pa.DataType):
    """``work(values, starts, sizes)`` over the int64 lists of a column, a bounded number of values at a time.

    It gives the values of the new lists and their sizes; null lists count as empty.  The
    function holds all it needs, so it travels to workers that cannot import this package.
    """
    at_once = SLICE_VALUES

    def run(lists: pa.Array) -> pa.Array:
        sizes = pc.list_value_length(lists).fill_null(0).to_numpy().astype(np.int64)
        ends, values = np.cumsum(sizes), lists.flatten().to_numpy()
        parts, row = [], 0
        while row < len(sizes):
            first = ends[row] - sizes[row]
            stop = max(row + 1, int(np.searchsorted(ends, first + at_once, "right")))
            own = sizes[row:stop]
            made, made_sizes = work(values[first : ends[stop - 1]], np.cumsum(own) - own, own)
            offsets = np.concatenate([[0], np.cumsum(made_sizes)])
            parts.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), made))
            row = stop
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(kind))

    return run


def gram_hashes(words: str | Column, gram: int) -> Column:
    """One hash for every ``gram`` neighbouring words, made of one hash of each word."""

    def work(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        hashed, keep = values.view(np.uint64), np.ones(len(values), bool)
        out = hashed.copy()
        for j in range(1, gram):
            out[:-j] = out[:-j] * np.uint64(0x9E3779B97F4A7C15) + hashed[j:]
            # The last places of a list have no whole gram.
            keep[(starts + sizes - j)[sizes >= j]] = False
        return pa.array(out[keep].view(np.int64)), np.maximum(sizes - gram + 1, 0)

    run = F.arrow_udf(_by_lists(work, pa.int64()), "array<bigint>")
    return run(F.transform(_col(words), lambda w: F.xxhash64(w)))


def fingerprints(hashes: Column, window: int) -> Column:
    """``array<struct<pos, fp>>``: hashes that are the least of some ``window`` neighbours, with their places.

    Fewer hashes than that have none.  Of equal least ones in a window all are taken.
    """
    if window & (window - 1):
        raise ValueError("the window must be a power of two")
    kind = pa.struct([("pos", pa.int32()), ("fp", pa.int64())])

    def work(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        # The greatest of the windows' minima that cover a place is its own hash exactly if it wins one.
        cover, steps = values.copy(), [1 << k for k in range(window.bit_length() - 1)]
        for step in steps:
            cover[:-step] = np.minimum(cover[:-step], cover[step:])
        for j in range(1, window):  # no window starts there
            cover[(starts + sizes - j)[sizes >= j]] = np.iinfo(np.int64).min
        for step in steps:
            cover[step:] = np.maximum(cover[step:], cover[:-step])
        won = np.flatnonzero((values == cover) & np.repeat(sizes >= window, sizes))
        places = (won - np.repeat(starts, sizes)[won]).astype(np.int32)
        made = pa.StructArray.from_arrays([pa.array(places), pa.array(values[won])], fields=list(kind))
        return made, np.searchsorted(won, starts + sizes) - np.searchsorted(won, starts)

    return F.arrow_udf(_by_lists(work, kind), "array<struct<pos:int,fp:bigint>>")(hashes)


def _placed(texts: DataFrame, key: str, gram: int, window: int) -> DataFrame:
    """``key, pos, fp`` of every fingerprint; ``texts`` has ``words``."""
    coded = texts.select(key, fingerprints(gram_hashes("words", gram), window).alias("_f"))
    # An inner one would be planned with a filter that takes the fingerprints a second time.
    return coded.select(key, F.inline_outer("_f")).where("fp is not null")


def _index(items: DataFrame, places: DataFrame, gram: int, window: int) -> DataFrame:
    """``item, pos, fp``: of every item the rarest fingerprints that any long enough run must meet."""
    own = _placed(items, "item", gram, window).join(items.select("item", "least_run"), "item")
    held = places.groupBy("fp").agg(F.count("*").alias("n"))
    # A run of g grams holds fingerprints at floor(g / window) places or more.
    sure = F.floor((F.col("least_run") - gram + 1) / window)
    ranked = (
        own.join(held, "fp", "left")
        .groupBy("item", "least_run")
        .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "fp", "pos"))).alias("all"))
    )
    rarest = F.slice("all", 1, (F.size("all") - sure + 1).cast("int"))
    return ranked.select("item", F.inline(rarest)).where("n > 0").select("item", "pos", "fp")


def _meetings(docs: DataFrame, items: DataFrame, gram: int, window: int, salt_rows: int) -> DataFrame:
    """Distinct ``doc, item, shift``: places where they may lie beside each other (doc place less item place)."""
    wanted = lookup(_placed(items, "item", gram, window).select("fp").distinct(), "item-fingerprints")
    places = stage(_placed(docs, "doc", gram, window).join(wanted, "fp", "left_semi"), "fingerprints")
    index = lookup(_index(items, places, gram, window), "index")
    met = salted_join(places, index.withColumnRenamed("pos", "item_pos"), "fp", ["doc", "pos"], salt_rows)
    return met.select("doc", "item", (F.col("pos") - F.col("item_pos")).alias("shift")).distinct()


def _longest_run(equal: Column) -> Column:
    """``start, run`` of the longest run of true, the first of equally long ones."""
    bits = F.array_join(F.transform(equal, lambda e: F.when(e, "1").otherwise("0")), "")
    run = F.array_max(F.transform(F.split(bits, "0"), lambda s: F.length(s)))
    return F.struct((F.instr(bits, F.repeat(F.lit("1"), run)) - 1).alias("start"), run.alias("run"))


def contained_items(
    documents: DataFrame,
    items: DataFrame,
    doc_id: str,
    item_id: str,
    text: str = "text",
    item_text: str = "text",
    least_share: float = LEAST_SHARE,
    gram: int = GRAM,
    window: int = WINDOW,
    salt_rows: int = SALT_ROWS,
) -> DataFrame:
    """``doc_id, item_id, start, n_words, share`` for every item that a document holds.

    ``start`` is the word (from 0) of the document at which the longest shared run
    begins, ``n_words`` its length and ``share`` that length over the item's words, to
    four digits; of equally long runs the first counts.  Null and blank texts hold
    nothing and lie in nothing.  Ids must be unique; names that clash do no harm, as
    other columns are not taken.  Equal items are found each.
    """
    doc_kind, item_kind = documents.schema[doc_id].dataType, items.schema[item_id].dataType
    texts = documents.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    docs = texts.select("doc", words_of("text").alias("words"))
    wanted = items.select(F.col(item_id).alias("item"), words_of(F.col(item_text)).alias("words")).where(F.size("words") > 0)
    # In whole numbers, so that a share such as 0.8 of 35 words is met by 28.
    ten_thousandths = round(least_share * 10_000)
    wanted = lookup(wanted.withColumn("least_run", F.ceil(F.size("words") * ten_thousandths / F.lit(10_000)).cast("int")), "items")
    usual = gram + window - 1
    short = [r[0] for r in wanted.where(F.col("least_run") < usual).select("least_run").distinct().collect()]  # below ``usual``
    parts = [(wanted.where(F.col("least_run") >= usual), gram, window)]
    parts += [(wanted.where(F.col("least_run") == n), n, 1) for n in sorted(short)]
    found = None
    for some, g, w in parts:
        if some.isEmpty():
            continue
        met = _meetings(docs, some, g, w, salt_rows)
        found = met if found is None else found.unionByName(met)
    if found is None:
        kinds = f"doc {doc_kind.simpleString()}, item {item_kind.simpleString()}, shift int"
        found = documents.sparkSession.createDataFrame([], kinds)
    met = stage(found, "meetings")
    # Only documents that met an item are cut into words again.
    holders = lookup(met.select("doc").distinct(), "holders")
    beside = (
        texts.join(holders, "doc", "left_semi")
        .select("doc", words_of("text").alias("words"))
        .join(met, "doc")
        .join(wanted.select("item", "least_run", F.col("words").alias("own")), "item")
    )
    # The part of the document that lies beside the item: its words before place 0 do not exist.
    before = F.greatest(-F.col("shift"), F.lit(0))
    part = F.slice("words", F.greatest(F.col("shift"), F.lit(0)) + 1, F.size("own") - before)
    mine = F.slice("own", before + 1, F.size("own"))
    equal = F.zip_with(part, mine, lambda a, b: a.eqNullSafe(b) & b.isNotNull())
    runs = beside.select(
        "doc", "item", "least_run", F.size("own").alias("size"), F.greatest(F.col("shift"), F.lit(0)).alias("at"), _longest_run(equal).alias("r")
    )
    best = F.max(F.struct(F.col("r.run").alias("run"), (-(F.col("at") + F.col("r.start"))).alias("place")))
    return (
        runs.where("r.run >= least_run")
        .groupBy("doc", "item", "size")
        .agg(best.alias("b"))
        .select(
            F.col("doc").alias(doc_id),
            F.col("item").alias(item_id),
            (-F.col("b.place")).cast("int").alias("start"),
            F.col("b.run").alias("n_words"),
            F.round(F.col("b.run") / F.col("size"), 4).alias("share"),
        )
    )


def contaminated(documents: DataFrame, found: DataFrame, doc_id: str) -> DataFrame:
    """``documents`` with ``contaminated``: whether ``contained_items`` found an item in the row."""
    held = lookup(found.select(F.col(doc_id).alias("_held")).distinct(), "contaminated")
    flagged = documents.join(held, documents[doc_id] == F.col("_held"), "left")
    return flagged.select(*documents.columns, F.col("_held").isNotNull().alias("contaminated"))

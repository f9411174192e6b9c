"""Near-duplicate documents: fast similarity sketches, banding, exact verification.

1. Every text becomes the set of its five-word shingles, a sketch of the set, and one
   key per band of the sketch.  Equal sets form one class; only classes go on.
2. Classes that share a band key form a bucket.  The first member of a bucket is paired
   with the others, pairs whose sketches lie five standard deviations below the similarity
   are left out, the rest is verified on the full sets, and the links are contracted
   into components.  A group of thousands of near copies costs one pair per member.
3. Buckets that still hold several components are compared within themselves, in tiles of
   bounded size.  Members of the largest component of a bucket have nothing to compare
   among themselves, so their tiles meet those of the others alone: a large group with
   strangers that fit one tile repeats no member of the group.  A task compares the
   sketches of its tiles as a matrix, leaves out pairs that are joined already, that meet
   in an earlier band too, or whose sketches lie too far below the similarity, verifies
   the rest on their full sets, and gives only links that join components.  No pair is
   ever a row.

With 40 bands of 5 coordinates a pair at similarity 0.75 shares a bucket with
probability 1 - (1 - 0.75^5)^40 > 0.99997, and more alike pairs more surely.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanmark.llm.common import fresh_name, release_memory, row_slices, stage
from gleanmark.llm.graph import components
from gleanmark.llm.shingles import band_keys, shingle_set, similarity_sketches

WIDTH = 5
PERCENT = 75
BANDS = 40
COORDINATES = 5 * BANDS

# Ids of at most this many documents (16 MB) may be sent to every task to pick texts.
BROADCAST_IDS = 2_000_000

# Shingles that a tile holds on average.
TILE_SHINGLES = 1_000_000

# Members of a tile; a bucket of more is several tiles, compared two by two.
TILE = 2048

# Shingles that are held against one set at a time.
CHUNK_SHINGLES = 500_000

_SKETCH = "n long, key binary, bands array<long>, sketch binary"


def sketched(docs: DataFrame, width: int = WIDTH, bands: int = BANDS, coordinates: int = COORDINATES) -> DataFrame:
    """(doc_id, n, key, bands, sketch) of (doc_id, text): set size, 128-bit key of the set, band keys and one byte per coordinate.

    Empty sets have nulls.  A batch is sketched in slices that are handed on one by one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in row_slices(batch.column(1)):
                sets = [shingle_set(t, width) for t in texts]
                found = similarity_sketches([s for s in sets if len(s)], coordinates)
                rows, low = iter(band_keys(found, bands)), iter(found.astype(np.uint8))
                columns = [
                    batch.column(0).slice(start, len(sets)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.array([next(rows) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    pa.array([next(low).tobytes() if len(s) else None for s in sets], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "key", "bands", "sketch"])
        release_memory()

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, {_SKETCH}")


def verified(a: Column, b: Column, width: int = WIDTH, percent: int = PERCENT) -> Column:
    """Whether the full shingle sets of two texts reach the similarity."""

    @F.pandas_udf("boolean")
    def run(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for left, right in pairs:
            out, last, kept = [], None, None
            for x, y in zip(left, right):
                if x is not last:
                    last, kept = x, shingle_set(x, width)
                other = shingle_set(y, width)
                common = len(np.intersect1d(kept, other, assume_unique=True))
                out.append(100 * common >= percent * (len(kept) + len(other) - common))
            yield pd.Series(out, dtype=bool)
        release_memory()

    return run(a, b)


def _least_alike(percent: int, coordinates: int) -> float:
    """Coordinates in which the sketches of a pair at the similarity agree, less five standard deviations."""
    p = percent / 100
    return coordinates * (p - 5 * np.sqrt(p * (1 - p) / coordinates))


def _alike(a: Column, b: Column, least: float) -> Column:
    """Whether two sketches agree in enough coordinates."""

    @F.pandas_udf("boolean")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        left, right = (np.frombuffer(b"".join(s), dtype=np.uint8).reshape(len(s), -1) for s in (x, y))
        return pd.Series((left == right).sum(axis=1) >= least)

    return run(a, b)


def _star_links(buckets: DataFrame, classes: DataFrame, texts: DataFrame, width: int, percent: int, coordinates: int) -> DataFrame:
    """Verified links (a, b) between the first member of each bucket and the others.

    Sketches, of one size for all, are compared first; texts move for the pairs left.
    """
    first = buckets.groupBy("band").agg(F.min(F.struct("rep", "n")).alias("p"))
    fits = f"100 * least(n, p.n) >= {percent} * greatest(n, p.n) and p.rep <> rep"
    pairs = buckets.join(first, "band").where(fits).select(F.col("p.rep").alias("a"), F.col("rep").alias("b"))
    pairs = stage(pairs.distinct(), "pairs")
    sketch = lambda c: classes.select(F.col("rep").alias(c), F.col("sketch").alias(f"sketch_{c}"))
    alike = _alike(F.col("sketch_a"), F.col("sketch_b"), _least_alike(percent, coordinates))
    pairs = stage(pairs.join(sketch("a"), "a").join(sketch("b"), "b").where(alike).select("a", "b"), "alike-pairs")
    left = texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b"))
    good = pairs.join(left, "a").join(right, "b").where(verified(F.col("text_a"), F.col("text_b"), width, percent))
    return stage(good.select("a", "b").distinct(), "links")


class _Roots(dict):
    """Union-find over component numbers."""

    def root(self, v: int) -> int:
        while self.setdefault(v, v) != v:
            self[v] = v = self[self[v]]
        return v


def _reach(one: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of the sets reach the similarity with ``one``."""
    sizes = np.array([len(o) for o in others])
    held, ends = np.concatenate(others), np.cumsum(sizes)
    found = one[np.minimum(np.searchsorted(one, held), len(one) - 1)] == held if len(one) else np.zeros(len(held), dtype=bool)
    before = np.concatenate([[0], np.cumsum(found)])
    common = before[ends] - before[ends - sizes]
    return 100 * common >= percent * (len(one) + sizes - common)


def _tile_links(frame: pd.DataFrame, width: int, percent: int, coordinates: int) -> pd.DataFrame:
    """Links that join components among the members of one tile, or between two."""
    frame = frame.sort_values("rep").reset_index(drop=True)
    turn, one_tile = int(frame["turn"].iloc[0]), frame["lo"].iloc[0] == frame["hi"].iloc[0]
    rep, n, tile = frame["rep"].to_numpy(), frame["n"].to_numpy(), frame["mine"].to_numpy()
    component = frame["component"].to_numpy()
    sketch = np.frombuffer(b"".join(frame["sketch"]), dtype=np.uint8).reshape(len(frame), -1)
    bands = np.array(frame["bands"].tolist(), dtype=np.int64)[:, :turn]
    floor = _least_alike(percent, coordinates)
    roots, sets, links = _Roots(), {}, []

    def shingles(i: int) -> np.ndarray:
        if i not in sets:
            sets[i] = shingle_set(frame["text"].iat[i], width)
        return sets[i]

    def apart(i: int, among: np.ndarray) -> np.ndarray:
        """Those that no link joins with ``i`` yet."""
        own = roots.root(int(component[i]))
        return np.array([j for j in among if roots.root(int(component[j])) != own], dtype=np.int64)

    for i in range(len(frame) - 1):
        rest = slice(i + 1, None)
        maybe = (component[rest] != component[i]) & (rep[rest] != rep[i])
        maybe &= 100 * np.minimum(n[rest], n[i]) >= percent * np.maximum(n[rest], n[i])
        if not one_tile:
            maybe &= tile[rest] != tile[i]
        at = i + 1 + np.flatnonzero(maybe)
        alike = (sketch[at] == sketch[i]).sum(axis=1)
        at, alike = at[alike >= floor], alike[alike >= floor]
        # A pair that meets in an earlier band is compared there.
        later = ~(bands[at] == bands[i]).any(axis=1)
        wanted, most = at[later][np.argsort(-alike[later], kind="stable")], 1
        # The most alike first and alone, as it may join what the others belong to.
        while len(wanted := apart(i, wanted)):
            some, wanted = wanted[:most], wanted[most:]
            for j in some[_reach(shingles(i), [shingles(j) for j in some], percent)]:
                a, b = roots.root(int(component[i])), roots.root(int(component[j]))
                if a != b:
                    roots[max(a, b)] = min(a, b)
                    links.append((int(rep[i]), int(rep[j])))
            most = max(1, CHUNK_SHINGLES // int(n[i]))
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def _in_tiles(members: DataFrame, tile: int) -> DataFrame:
    """``members`` of buckets that hold several components, once for each two tiles ``lo, hi`` that their own, ``mine``, is one of.

    Two members of a bucket and different components meet once.  Tiles are bounded by rows and by the length of their texts.
    """
    parts = members.groupBy("band", "component").agg(F.count("*").alias("size"), F.sum("n").alias("all"))
    open_buckets = parts.groupBy("band").agg(
        F.max(F.struct("size", "component", "all")).alias("main"), F.sum("size").alias("size"), F.sum("all").alias("all"), F.count("*").alias("parts")
    ).where("parts > 1")
    tiles = lambda size, of: F.greatest(F.ceil(size / tile), F.ceil(of / TILE_SHINGLES))
    whole = tiles(F.col("size"), F.col("all")) == 1
    open_buckets = open_buckets.select(
        "band",
        F.when(~whole, F.col("main.component")).alias("main"),
        F.when(whole, 0).otherwise(tiles(F.col("main.size"), F.col("main.all"))).alias("main_tiles"),
        F.when(whole, 1).otherwise(tiles(F.col("size") - F.col("main.size"), F.col("all") - F.col("main.all"))).alias("other_tiles"),
    )
    members = stage(members.drop("n").join(open_buckets, "band"), "members")
    # Tiles of the largest component come after the others', and meet those alone.
    in_main = F.col("component").eqNullSafe(F.col("main"))
    place = F.xxhash64("rep")
    mine = F.when(in_main, F.col("other_tiles") + F.pmod(place, F.greatest("main_tiles", F.lit(1)))).otherwise(F.pmod(place, F.col("other_tiles")))
    met = F.when(in_main, F.col("other_tiles")).otherwise(F.col("other_tiles") + F.col("main_tiles"))
    dealt = members.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), met - 1)))
    return dealt.select("band", "turn", "rep", "component", "mine", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"))


def _links(buckets: DataFrame, classes: DataFrame, texts: DataFrame, width: int, percent: int, tile: int, coordinates: int) -> DataFrame:
    """Links (a, b) whose components are those of all verified links."""
    star = _star_links(buckets, classes, texts, width, percent, coordinates)
    found = components(star).withColumnRenamed("node", "rep")
    members = buckets.select("band", "turn", "rep", "n").join(found, "rep", "left")
    members = members.withColumn("component", F.coalesce("component", "rep"))
    tiled = _in_tiles(members, tile)
    dealt = tiled.join(classes.select("rep", "n", "bands", "sketch"), "rep").join(texts, "rep")
    compare = lambda frame: _tile_links(frame, width, percent, coordinates)
    more = dealt.groupBy("band", "lo", "hi").applyInPandas(compare, "a long, b long")
    return star.unionByName(stage(more, "tile-links"))


def _sendable(ids: DataFrame) -> DataFrame:
    """Written ids, marked for broadcast where they are few enough."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
    tile: int = TILE,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    component_id is the smallest id that links reach, kept marks the document that
    carries it.  A null or blank text has the empty set and links with nothing; a text
    below ``width`` words is one shingle.  Rows that share an id count as one document
    and may join several sets (of which one speaks for it in tiles).  A row without an id cannot be named by a link: it stays
    alone, with a null component, and is kept.  An empty table gives an empty one.
    """
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sets = stage(sketched(base, width), "sets")
    named = sets.where("doc_id is not null and key is not null")
    firsts = stage(named.groupBy("key").agg(F.min("doc_id").alias("rep")), "firsts")
    # The class's first document speaks for it.
    speaking = named.join(firsts, "key").where("doc_id = rep").select("rep", "n", "bands", "sketch")
    spread = speaking.select("rep", "n", F.posexplode("bands").alias("turn", "band"))
    shared = spread.groupBy("band").agg(F.min("rep").alias("x"), F.max("rep").alias("y")).where("x < y")
    buckets = stage(spread.join(shared.select("band"), "band", "left_semi").distinct(), "buckets")

    wanted = stage(buckets.select(F.col("rep").alias("doc_id")).distinct(), "candidates")
    wanted = _sendable(wanted)
    picked = base.where("text is not null").join(wanted, "doc_id", "left_semi")
    texts = stage(picked.select(F.col("doc_id").alias("rep"), "text").distinct(), "texts")
    classes = speaking.join(wanted.withColumnRenamed("doc_id", "rep"), "rep", "left_semi").dropDuplicates(["rep"])
    links = _links(buckets, stage(classes, "classes"), texts, width, percent, tile, COORDINATES)

    # Equal sets are linked through their class; rows of one id are one document.
    joined = named.select("doc_id", "key").join(firsts, "key").where("doc_id <> rep")
    ties = joined.select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    found = components(ties.unionByName(links))
    return sets.join(found, sets["doc_id"] == found["node"], "left").select(
        sets["doc_id"],
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce("component", "doc_id").eqNullSafe(sets["doc_id"]).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each group is kept, columns unchanged.

    Of rows that repeat an id with words, one stays (the first by a hash of its text).
    """
    found = near_duplicates(docs, doc_id, text, **options)
    by_id = found.where("doc_id is not null").groupBy("doc_id").agg(
        F.bool_and("kept").alias("kept"), F.count_if(F.col("n_shingles") > 0).alias("n")
    )
    key = fresh_name(docs, "_decided")
    decided = stage(by_id.where("not kept or n > 1").withColumnRenamed("doc_id", key), "decided")
    match = docs[doc_id].cast("long") == F.col(key)
    out = docs.join(_sendable(stage(decided.where("not kept").select(key), "dropped")), match, "left_anti")
    repeated = decided.where("kept")
    if repeated.isEmpty():
        return out
    repeated = _sendable(stage(repeated.select(key), "repeated"))
    match = out[doc_id].cast("long") == F.col(key)
    again = out.join(repeated, match, "left_semi")
    one = again.groupBy(F.col(doc_id).alias("_id")).agg(F.min_by(F.struct(*docs.columns), F.xxhash64(text)).alias("_row"))
    return out.join(repeated, match, "left_anti").unionByName(one.select("_row.*"))

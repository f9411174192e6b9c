"""Near-duplicate vectors by sorted projection passes.

Equal vectors of a label form one class.  A pass gives every class a code of random
hyperplane hashes and orders a label by it, bit for bit from the first.  A class is
compared with its neighbours in that order as long as they share the first ``depth``
bits, which is a window of about ``WINDOW`` classes where codes are spread evenly and a
wider one where vectors crowd; nothing caps it.  ``depth`` follows from the number of
classes, and the number of passes from the depth: vectors at the threshold share a bit
with probability 1 - acos(0.98) / pi = 0.936 wherever the others lie, and a pair at the
threshold is apart in all passes with probability ``MISS`` at most.  Verified pairs are
united across passes.

A label of at most ``WALK`` blocks is ordered and walked in one task, so its vectors
move once; the runs of a larger one are dealt out, and a run of more than ``BLOCK``
classes is cut into tiles that are compared two by two.  Codes, order and windows are the
same in both.

All links of a vector lie within its component, so the number of links is counted there,
exactly: a component is cut into tiles of at most ``TILE`` members and each pair of tiles
is one task's matrix product, of which only counts leave.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanmark.llm.common import stage
from gleanmark.llm.graph import components
from gleanmark.llm.vectors import stacked, usable, vector_key

COSINE = 0.98
WINDOW = 8
MISS = 1e-6
BLOCK = 2048
WALK = 8
TILE = 1024
MOST_DEPTH = 40
CHUNK = 512
SEED = 11


def depth_for(n: int, window: int) -> int:
    """Leading bits that about ``window`` of ``n`` evenly spread codes share."""
    return min(MOST_DEPTH, max(1, math.ceil(math.log2(max(1, n) / window))))


def passes_for(depth: int, cosine: float, miss: float) -> int:
    """Passes in all of which a pair at the threshold differs in ``depth`` bits with probability ``miss`` at most."""
    shared = (1 - math.acos(min(1.0, cosine)) / math.pi) ** depth
    return 1 if shared == 1 else math.ceil(math.log(miss) / math.log1p(-shared))


def _codes(x: np.ndarray, passes: int, seed: int = SEED) -> np.ndarray:
    """One 64-bit code of hyperplane hashes per row and pass, the first bit highest."""
    planes = np.random.default_rng([seed, x.shape[1]]).standard_normal((64 * passes, x.shape[1]))
    bits = (x @ planes.T > 0).reshape(len(x), passes, 8, 8)
    return np.packbits(bits, axis=3).reshape(len(x), passes, 8).copy().view(">i8")[:, :, 0].astype(np.int64)


def codes(vector: Column, passes: int, seed: int = SEED) -> Column:
    """One 64-bit code of hyperplane hashes per pass."""

    @F.pandas_udf("array<long>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for some in batches:
            out = np.empty((len(some), passes), dtype=np.int64)
            lengths = some.map(len).to_numpy()
            for d in np.unique(lengths):
                at = np.flatnonzero(lengths == d)
                out[at] = _codes(stacked(some.iloc[at]), passes, seed)
            yield pd.Series(list(out))

    return run(vector)


def _unit(rows) -> np.ndarray:
    x = stacked(rows)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _by_length(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
    for _, part in frame.groupby(frame["vector"].map(len), sort=True):
        yield part


def _prefix(code: Column, depth: Column) -> Column:
    """The first ``depth`` bits of a code."""
    return F.call_function("shiftrightunsigned", code, (64 - depth).cast("int"))


def runs_of(prefixes: np.ndarray) -> Iterator[np.ndarray]:
    """Places of neighbours in the order of a pass that share their first bits, where there are several."""
    order = np.argsort(prefixes, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(prefixes[order])) + 1):
        if len(at) > 1:
            yield at


def passes_over(x: np.ndarray, window: int, miss: float, cosine: float) -> Iterator[np.ndarray]:
    """The runs of all passes over the vectors of one label."""
    depth = depth_for(len(x), window)
    found = _codes(x, passes_for(depth, cosine, miss)).view(np.uint64) >> np.uint64(64 - depth)
    for turn in range(found.shape[1]):
        yield from runs_of(found[:, turn])


def _forest(x: np.ndarray, left: np.ndarray, right: np.ndarray, cosine: float) -> list[tuple[int, int]]:
    """Pairs of rows of ``x`` that unite what is linked between ``left`` and ``right``."""
    part, links = np.arange(len(x)), []
    for start in range(0, len(left), CHUNK):
        rows = left[start : start + CHUNK]
        near = (x[rows] @ x[right].T >= cosine) & (rows[:, None] != right[None, :])
        for i in np.flatnonzero(near.any(axis=1)):
            own = part[rows[i]]
            met = np.unique(part[right[near[i]]])
            met = met[met != own]
            if len(met):
                links += [(own, m) for m in met]
                part[np.isin(part, met)] = own
    return links


def _dealt(members: DataFrame, sizes: DataFrame, group: str, tile: int, *columns: str) -> DataFrame:
    """Members of groups, once for each pair of tiles that theirs is part of."""
    small = sizes.where(F.col("size") <= tile).agg(F.sum("size")).first()[0] or 0
    bins = math.ceil(2 * small / tile) + 1
    tiles = F.ceil(F.col("size") / tile)
    # Small groups share a task, each compared within itself; a large one has tiles of its own.
    task = F.when(tiles == 1, -1 - F.pmod(F.xxhash64(group), F.lit(bins))).otherwise(F.col(group))
    mine = F.pmod(F.xxhash64(F.lit(1), "rep"), tiles)
    return (
        members.withColumn("task", task).withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1)))
        .select("task", group, "rep", "label", *columns, "mine", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"))
    )


def _links_of_label(x: np.ndarray, window: int, miss: float, cosine: float) -> list[tuple[int, int]]:
    """Pairs of rows that unite what the passes link."""
    part, links = np.arange(len(x)), []
    for at in passes_over(x, window, miss, cosine):
        if (part[at] == part[at[0]]).all():
            continue
        everyone = np.arange(len(at))
        for a, b in _forest(x[at], everyone, everyone, cosine):
            a, b = at[a], at[b]
            if part[a] != part[b]:
                links.append((a, b))
                part[part == part[b]] = part[a]
    return links


def _small_labels(classes: DataFrame, sizes: DataFrame, cosine: float, window: int, miss: float, block: int) -> DataFrame:
    """Links (a, b) in the labels that one task takes whole, several of them in each."""
    rows = sizes.agg(F.sum("n")).first()[0] or 0
    bins = math.ceil(2 * rows / block) + 1

    def walk(frame: pd.DataFrame) -> pd.DataFrame:
        links = []
        for _, of_label in frame.groupby("label", sort=False):
            for part in _by_length(of_label.sort_values("rep")):
                rep = part["rep"].to_numpy()
                links += [(int(rep[a]), int(rep[b])) for a, b in _links_of_label(_unit(part["vector"]), window, miss, cosine)]
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    taken = classes.join(sizes, "label").withColumn("task", F.pmod(F.xxhash64("label"), F.lit(bins)))
    return taken.select("task", "label", "rep", "vector").groupBy("task").applyInPandas(walk, "a long, b long")


def _large_labels(classes: DataFrame, sizes: DataFrame, cosine: float, window: int, miss: float, block: int) -> DataFrame:
    """Links (a, b) found in the runs of larger labels, reduced to a forest within each pair of tiles."""
    depth = F.least(F.greatest(F.ceil(F.log2(F.col("n") / window)), F.lit(1)), F.lit(MOST_DEPTH)).cast("int")
    passes = F.element_at(F.array(*[F.lit(passes_for(d, cosine, miss)) for d in range(1, MOST_DEPTH + 1)]), depth)
    chosen = classes.join(sizes.withColumn("depth", depth).withColumn("passes", passes), "label")
    most = passes_for(depth_for(sizes.agg(F.max("n")).first()[0], window), cosine, miss)
    coded = chosen.select("label", "rep", "depth", F.slice(codes(F.col("vector"), most), F.lit(1), F.col("passes")).alias("codes"))
    coded = coded.select("label", "rep", "depth", F.posexplode("codes").alias("turn", "code"))
    slim = stage(coded.select("label", "rep", "turn", _prefix(F.col("code"), F.col("depth")).alias("prefix")), "passes")
    key = ["label", "turn", "prefix"]
    runs = stage(slim.groupBy(*key).agg(F.count("*").alias("size")).where("size > 1").withColumn("run", F.monotonically_increasing_id()), "runs")
    dealt = _dealt(slim.join(runs, key).select("run", "label", "rep", "size"), runs, "run", block)

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        links = []
        lo, hi = frame["lo"].iloc[0], frame["hi"].iloc[0]
        for part in _by_length(frame):
            part = part.sort_values("run")
            x, rep, run, mine = _unit(part["vector"]), part["rep"].to_numpy(), part["run"].to_numpy(), part["mine"].to_numpy()
            cuts = np.flatnonzero(np.diff(run)) + 1
            for at in np.split(np.arange(len(part)), cuts):
                left, right = np.flatnonzero(mine[at] == lo), np.flatnonzero(mine[at] == hi)
                links += [(int(rep[at[a]]), int(rep[at[b]])) for a, b in _forest(x[at], left, right, cosine)]
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    vectors = classes.select("label", "rep", "vector")
    return dealt.join(vectors, ["label", "rep"]).groupBy("task", "lo", "hi").applyInPandas(compare, "a long, b long")


def _run_links(classes: DataFrame, cosine: float, window: int, miss: float, block: int) -> DataFrame:
    """Links (a, b) whose components are those of all links that the passes meet."""
    sizes = stage(classes.groupBy("label").agg(F.count("*").alias("n")), "labels")
    small, large = sizes.where(F.col("n") <= WALK * block), sizes.where(F.col("n") > WALK * block)
    links = _small_labels(classes, small, cosine, window, miss, block)
    return links if large.isEmpty() else links.unionByName(_large_labels(classes, large, cosine, window, miss, block))


def _link_counts(members: DataFrame, cosine: float, tile: int) -> DataFrame:
    """(rep, links): for every member of a component the rows of other classes linked with it."""
    sizes = stage(members.groupBy("component").agg(F.count("*").alias("size")), "sizes")
    dealt = _dealt(members.join(sizes, "component"), sizes, "component", tile, "m", "vector")

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        lo, hi = frame["lo"].iloc[0], frame["hi"].iloc[0]
        for part in _by_length(frame):
            part = part.sort_values(["component", "label"])
            x, m = _unit(part["vector"]), part["m"].to_numpy()
            group = part.groupby(["component", "label"], sort=False).ngroup().to_numpy()
            ends = np.append(np.flatnonzero(np.diff(group)) + 1, len(part))
            links, start = np.zeros(len(part), dtype=np.int64), 0
            mine = part["mine"].to_numpy()
            for end in ends:
                s = slice(start, end)
                near = x[s] @ x[s].T >= cosine
                if lo != hi:
                    near &= mine[s][:, None] != mine[s][None, :]
                else:
                    np.fill_diagonal(near, False)
                links[s] = near @ m[s]
                start = end
            out.append(pd.DataFrame({"rep": part["rep"].to_numpy(), "links": links}))
        return pd.concat(out)

    found = dealt.groupBy("task", "lo", "hi").applyInPandas(count, "rep long, links long")
    return found.groupBy("rep").agg(F.sum("links").alias("links"))


def near_duplicate_vectors(
    table: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    cosine: float = COSINE,
    window: int = WINDOW,
    miss: float = MISS,
    block: int = BLOCK,
    tile: int = TILE,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``table``.

    Vectors that are null, zero or hold null or non-finite components, and rows without
    label or id, link with nothing and are their own component; vectors of different
    lengths never link.  Rows that repeat an id with an equal vector are one vector.
    An empty table gives an empty one.
    """
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector"))
    keyed = stage(rows.select("vec_id", "label", "vector", F.when(good, vector_key(F.col("vector"))).alias("key")), "keyed")
    ids = keyed.where("key is not null").select("label", "key", "vec_id").distinct()
    named = stage(ids.groupBy("label", "key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("m")), "named")
    speaking = keyed.where("key is not null").join(named, ["label", "key"]).where("vec_id = rep")
    # An id may repeat: one row is enough.
    classes = stage(speaking.groupBy("label", "rep").agg(F.any_value("m").alias("m"), F.any_value("vector").alias("vector")), "classes")

    links = _run_links(classes, cosine, window, miss, block)
    found = components(links)
    members = classes.join(found.withColumnRenamed("node", "rep"), "rep")
    counted = stage(_link_counts(members, cosine, tile), "counted").withColumnRenamed("rep", "r")

    classed = keyed.join(named.withColumnsRenamed({"label": "l", "key": "k"}), (F.col("label") == F.col("l")) & (F.col("key") == F.col("k")), "left")
    out = classed.join(counted, F.col("rep") == F.col("r"), "left").join(
        found.withColumnRenamed("node", "c"), F.col("rep") == F.col("c"), "left"
    )
    component = F.coalesce("component", "rep", "vec_id")
    return out.select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("m") - 1, F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("vec_id")).alias("kept"),
    )

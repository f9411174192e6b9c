"""Nearest neighbours by inner product, over a hierarchical k-means tree.

The tree is fitted on a bounded sample and sent to every task, where it assigns every
row of the table to a leaf.  A query walks the tree best bin first: a priority queue
holds the branches not yet taken, the one whose centre has the largest inner product
with the query comes next, and each leaf that comes out of the queue is one visit.  How
many visits are needed is measured: for a bounded set of calibration queries the exact
neighbours among all rows are found, and visits are widened until the leaves visited
hold the wanted share of them.

Queries and rows meet by leaf.  Leaves are cut into blocks of rows and of queries by
hash, so that a leaf with a third of all rows is many tasks, and every block pair gives
the best k per query.  The matrix product only preselects: every row within its rounding
of the k-th score is scored again in one fixed order, so that equal vectors have equal
scores in all blocks and ties go to the smaller id.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gleanmark.llm.common import stage
from gleanmark.llm.vectors import stacked, usable

NEIGHBOURS = 20
SAMPLE = 20_000  # rows the tree is fitted on
LEAF_SAMPLE = 100  # sample rows a leaf holds at most
BRANCHES = 8
CALIBRATION = 200  # queries whose exact neighbours are found
RECALL = 0.97
ROWS_PER_BLOCK, QUERIES_PER_BLOCK = 8192, 1024
SEED = 5


@dataclass(frozen=True)
class Tree:
    """Centres of all nodes; children of each, empty for a leaf; numbers of the leaves."""

    centres: np.ndarray
    children: list[list[int]]
    leaf: np.ndarray

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf that the nearest centres lead to."""
        out, todo = np.empty(len(x), dtype=np.int64), [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            below = self.children[node]
            if not below:
                out[rows] = self.leaf[node]
                continue
            c = self.centres[below]
            # Unlike a matrix product, this gives equal rows equal values wherever they stand.
            best = np.argmin((c * c).sum(axis=1) - 2 * np.einsum("ij,kj->ik", x[rows], c), axis=1)
            todo += [(below[k], rows[best == k]) for k in range(len(below)) if (best == k).any()]
        return out

    def visits(self, q: np.ndarray, most: int) -> list[int]:
        """Leaves in the order in which they leave the queue."""
        queue, order = [(0.0, 0)], []
        while queue and len(order) < most:
            _, node = heapq.heappop(queue)
            below = self.children[node]
            if not below:
                order.append(int(self.leaf[node]))
                continue
            for k, near in zip(below, self.centres[below] @ q):
                heapq.heappush(queue, (-float(near), k))
        return order


def _means(x: np.ndarray, k: int, rng: np.random.Generator, turns: int = 12) -> tuple[np.ndarray, np.ndarray]:
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(turns):
        nearest = np.argmin((centres * centres).sum(axis=1) - 2 * x @ centres.T, axis=1)
        for j in range(k):
            if (nearest == j).any():
                centres[j] = x[nearest == j].mean(axis=0)
    return centres, np.argmin((centres * centres).sum(axis=1) - 2 * x @ centres.T, axis=1)


def fit_tree(sample: np.ndarray, branches: int = BRANCHES, leaf_rows: int = LEAF_SAMPLE, seed: int = SEED) -> Tree:
    """k-means of k-means, until a node holds few sample rows or equal ones only."""
    rng = np.random.default_rng(seed)
    centres, children = [sample.mean(axis=0)], [[]]
    todo = [(0, np.arange(len(sample)))]
    while todo:
        node, rows = todo.pop()
        x = sample[rows]
        if len(rows) <= leaf_rows or not np.ptp(x, axis=0).any():
            continue
        c, nearest = _means(x, branches, rng)
        parts = [np.flatnonzero(nearest == j) for j in range(branches)]
        if max(map(len, parts)) == len(rows):
            continue
        for j, part in enumerate(parts):
            if len(part):
                children[node].append(len(centres))
                todo.append((len(centres), rows[part]))
                centres.append(c[j])
                children.append([])
    leaf, n = np.full(len(centres), -1), 0
    for i, below in enumerate(children):
        if not below:
            leaf[i], n = n, n + 1
    return Tree(np.array(centres), children, leaf)


def _best(q: np.ndarray, v: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per query the places and scores of the k best rows, ties to the smaller id; ids ascend."""
    scores = q @ v.T
    scores[ids[None, :] == own[:, None]] = -np.inf
    k, d = min(k, len(v)), q.shape[1]
    floors = np.partition(scores, len(v) - k, axis=1)[:, len(v) - k]
    # A sum of d products is off by d * u * |q| * |v| at most in any order (u is half of eps; twice
    # that covers the higher terms).  Two sums of one row, for the k-th row and for the one beside it.
    off = 4 * d * np.finfo(float).eps * np.sqrt((q * q).sum(axis=1) * (v * v).sum(axis=1).max())
    for x, row, floor in zip(q, scores, floors - off):
        at = np.flatnonzero((row >= floor) & np.isfinite(row))
        exact = np.concatenate([_in_order(x, v[at[i : i + 1024]]) for i in range(0, len(at), 1024)]) if len(at) else np.empty(0)
        first = np.argsort(-exact, kind="stable")[:k]
        yield at[first], exact[first]


def _in_order(x: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products, added up in double precision, first to last."""
    return np.add.accumulate(x * v, axis=1)[:, -1] + 0.0


def _pairs(qid: np.ndarray, q: np.ndarray, vid: np.ndarray, v: np.ndarray, k: int) -> pd.DataFrame:
    """The k best rows of a block for each of its queries."""
    vid, first = np.unique(vid, return_index=True)
    v = v[first]
    places, scores = [], []
    for a in range(0, len(qid), 256):
        for at, score in _best(q[a : a + 256], v, vid, qid[a : a + 256], k):
            places.append(at)
            scores.append(score)
    if not places:
        return pd.DataFrame({"query_id": [], "vec_id": [], "near": []})
    # One frame for all queries of the block.
    asked = np.repeat(qid, [len(at) for at in places])
    return pd.DataFrame({"query_id": asked, "vec_id": vid[np.concatenate(places)], "near": np.concatenate(scores)})


_PAIRS = "query_id long, vec_id long, near double"


def _calibrated(rows: DataFrame, tree: Tree, queries: pd.DataFrame, k: int, recall: float) -> int:
    """Visits after which the leaves visited hold ``recall`` of the exact neighbours."""
    qid, q = queries["vec_id"].to_numpy(), stacked(queries["vector"])

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.sort_values("vec_id")
            yield _pairs(qid, q, batch["vec_id"].to_numpy(), stacked(batch["vector"]), k)

    near = rows.select("vec_id", "vector").mapInPandas(exact, _PAIRS)
    order = W.partitionBy("query_id").orderBy(F.desc("near"), "vec_id")
    true = near.distinct().withColumn("r", F.row_number().over(order)).where(F.col("r") <= k)
    leaves = true.join(rows.select("vec_id", "leaf"), "vec_id").select("query_id", "leaf").collect()  # at most k each
    rank = {i: {leaf: r for r, leaf in enumerate(tree.visits(x, tree.leaves))} for i, x in zip(qid.tolist(), q)}
    needed = np.sort([rank[r["query_id"]][r["leaf"]] + 1 for r in leaves])
    if not len(needed):
        return 1
    visits = 1
    while np.searchsorted(needed, visits, side="right") < recall * len(needed):
        visits += max(1, visits // 8)
    return min(visits, tree.leaves)


def nearest(
    table: DataFrame,
    is_query: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = NEIGHBOURS,
    sample: int = SAMPLE,
    leaf_rows: int = LEAF_SAMPLE,
    recall: float = RECALL,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest inner product with each query.

    Rows without id and vectors that are null, zero or hold null or non-finite components
    take no part, as queries nor as candidates; neither do vectors of another length than
    the most frequent one.  A query's own id is no candidate.  Rows that repeat an id are
    one candidate.  Ties go to the smaller id; with fewer candidates all are given.
    """
    spark = table.sparkSession
    rows = table.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("is_query")
    )
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    usual = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if usual is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("vector") == usual["d"])
    mixed = F.xxhash64(F.lit(SEED), "vec_id")
    fitted = rows.select("vector").orderBy(mixed, "vec_id").limit(sample).toPandas()  # bounded by sample
    tree = fit_tree(stacked(fitted["vector"]), leaf_rows=leaf_rows)

    def assigned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(leaf=tree.assign(stacked(batch["vector"])))

    rows = stage(rows.mapInPandas(assigned, "vec_id long, vector array<float>, is_query boolean, leaf long"), "leaves")
    queries = rows.where("is_query").select("vec_id", "vector").dropDuplicates(["vec_id"])
    some = queries.orderBy(mixed, "vec_id").limit(CALIBRATION).toPandas()  # bounded
    if some.empty:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    visits = _calibrated(rows, tree, some, k, recall)

    def routed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            to = [tree.visits(x, visits) for x in stacked(batch["vector"])]
            yield pd.DataFrame({"query_id": batch["vec_id"], "query": batch["vector"], "leaves": to})

    asked = queries.mapInPandas(routed, "query_id long, query array<float>, leaves array<long>")
    asked = asked.withColumn("leaf", F.explode("leaves")).drop("leaves")
    blocks = stage(rows.groupBy("leaf").agg(F.ceil(F.count("*") / ROWS_PER_BLOCK).alias("row_blocks")), "blocks")
    query_blocks = math.ceil(max(1, queries.count()) * visits / tree.leaves / QUERIES_PER_BLOCK)
    each = F.sequence(F.lit(0).cast("long"), F.col("row_blocks") - 1)
    asked = (
        asked.join(F.broadcast(blocks), "leaf").withColumn("rb", F.explode(each))
        .withColumn("qb", F.pmod(F.xxhash64(F.lit(2), "query_id"), F.lit(query_blocks))).drop("row_blocks")
    )
    held = (
        rows.select("leaf", "vec_id", "vector").join(F.broadcast(blocks), "leaf")
        .withColumn("rb", F.pmod(F.xxhash64(F.lit(3), "vec_id"), F.col("row_blocks")))
        .withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_blocks - 1).cast("long")))).drop("row_blocks")
    )

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "near": []})
        right = right.sort_values("vec_id")
        return _pairs(left["query_id"].to_numpy(), stacked(left["query"]), right["vec_id"].to_numpy(), stacked(right["vector"]), k)

    place = ["leaf", "rb", "qb"]
    near = asked.groupBy(*place).cogroup(held.groupBy(*place)).applyInPandas(meet, _PAIRS)
    # An id with several vectors is one candidate, with its best score.
    scored = near.groupBy("query_id", "vec_id").agg(F.max("near").alias("score"))
    by_score = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = scored.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")

"""Quality classifier: a regularised quadratic discriminant over document statistics.

Every text becomes a vector of transformed statistics of its characters, words and
lines.  Each class has a mean and a covariance that is shrunk towards the covariance
of both classes and towards a multiple of the identity.  The score is the logistic of
the difference of the two log densities (Mahalanobis distances from cached Cholesky
factors) and of the log priors.

The fit uses at most ``MOST_ROWS`` labelled rows, taken in the order of a hash of their
id; their sums are added up in Spark, and only class sums reach the driver.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanmark.llm.common import in_slices, release_memory

# The labelled rows that a fit may use, at 16 bytes each the bound of what is broadcast.
MOST_ROWS = 200_000

# Weight of the pooled covariance, and of the identity, in each class covariance.
POOLED = 0.30
SPHERE = 0.02

ACCEPT = 0.7

_LOWER, _UPPER, _DIGIT, _BLANK, _STOP, _SHOUT, _BAR, _OTHER, _HIGH = range(9)
_KIND = np.full(256, _OTHER, dtype=np.uint8)
_KIND[ord("a") : ord("z") + 1] = _LOWER
_KIND[ord("A") : ord("Z") + 1] = _UPPER
_KIND[ord("0") : ord("9") + 1] = _DIGIT
_KIND[[9, 10, 11, 12, 13, 32]] = _BLANK
_KIND[[ord(c) for c in ".,;:?'\"()-"]] = _STOP
_KIND[ord("!")] = _SHOUT
_KIND[[ord(c) for c in "|<>{}[]/\\=_~^"]] = _BAR
_KIND[128:] = _HIGH

STATISTICS = (
    "length", "upper", "digit", "stop", "shout", "bar", "other", "mean_word", "distinct", "echo",
    "pairs", "closed", "capital_words", "odd_words", "line_words",
)


def statistics(text: str) -> list[float]:
    """Transformed statistics of a whole text; the empty text has a vector too.

    Shares go through the square root, which spreads the small ones, counts through
    the logarithm.
    """
    data = text.encode("utf-8", "surrogatepass")
    kinds = np.bincount(_KIND[np.frombuffer(data, dtype=np.uint8)], minlength=9)
    words = data.split()
    n, w = max(1, len(data) - int(kinds[_BLANK])), max(1, len(words))
    share = np.sqrt(kinds / n)
    after = words[1:]
    pairs = max(1, len(after))
    lines = [x for x in data.split(b"\n") if x]
    ends = sum(x.rstrip().endswith((b".", b"?", b'"')) for x in lines)
    # Words that end in a mark no sentence needs, and words of capitals only.
    odd = sum(map(bytes.endswith, words, [(b"%", b"&", b"*", b"$", b"#", b"|", b"!!", b"@", b"~", b"^", b"=", b"_")] * len(words)))
    capital = sum(map(bytes.isupper, words))
    return [
        np.log1p(len(data)),
        share[_UPPER],
        share[_DIGIT],
        share[_STOP],
        share[_SHOUT],
        share[_BAR],
        share[_OTHER],
        np.log1p(n / w),
        len(set(words)) / w,
        np.sqrt(sum(map(operator.eq, words, after)) / pairs),
        len(set(zip(words, after))) / pairs,
        ends / max(1, len(lines)),
        np.sqrt(capital / w),
        np.sqrt(odd / w),
        np.log1p(w / max(1, len(lines))),
    ]


def matrix(texts: list[str]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], dtype=float).reshape(len(texts), len(STATISTICS))


@dataclass(frozen=True)
class Discriminant:
    """Two class densities; everything a task needs is a few kilobytes."""

    means: np.ndarray  # class x statistic
    factors: np.ndarray  # inverse Cholesky factor of each covariance
    offsets: np.ndarray  # log prior minus half the log determinant

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1."""
        density = [
            self.offsets[k] - 0.5 * np.sum(((x - self.means[k]) @ self.factors[k].T) ** 2, axis=1) for k in (0, 1)
        ]
        return 1.0 / (1.0 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def discriminant(counts, sums, squares, pooled: float = POOLED, sphere: float = SPHERE) -> Discriminant:
    """From per-class row counts, sums and sums of outer products.

    A class without rows borrows the other's density, so that only the prior (one row
    at least) speaks; without any row every score is one half.
    """
    counts = np.asarray(counts, dtype=float)
    d = len(STATISTICS)
    if not counts.sum():
        return Discriminant(np.zeros((2, d)), np.stack([np.eye(d)] * 2), np.zeros(2))
    filled = [k if counts[k] else 1 - k for k in (0, 1)]
    means = np.stack([sums[k] / counts[k] for k in filled])
    own = [squares[k] / counts[k] - np.outer(means[k], means[k]) for k in (0, 1)] if counts.all() else None
    if own is None:
        k = filled[0]
        own = [squares[k] / counts[k] - np.outer(means[k], means[k])] * 2
    both = (counts[0] * own[0] + counts[1] * own[1]) / counts.sum()
    factors, offsets = [], []
    for k in (0, 1):
        shrunk = (1 - pooled) * own[k] + pooled * both
        # The floor keeps a class of equal rows invertible.
        shrunk = (1 - sphere) * shrunk + (sphere * np.trace(both) / d + 1e-6) * np.eye(d)
        lower = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.inv(lower))
        offsets.append(np.log(max(1.0, counts[k])) - np.log(np.diag(lower)).sum())
    return Discriminant(means, np.stack(factors), np.array(offsets))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def labelled_sample(labels: DataFrame, most_rows: int = MOST_ROWS) -> DataFrame:
    """(doc_id, label) of at most ``most_rows`` training ids, first by hash; contradicting labels are left out."""
    known = labels.where("doc_id is not null and quality in (0, 1)")
    train = known.where(~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    train = train.agg(F.min("quality").alias("label"), F.max("quality").alias("other")).where("label = other")
    return train.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows).select("doc_id", "label")


def fit(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> Discriminant:
    """Class sums over the labelled training rows of ``docs`` (doc_id, text)."""
    sample = F.broadcast(labelled_sample(labels, most_rows))  # bounded by most_rows
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(sample, "doc_id")

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = matrix(batch["text"].fillna("").tolist())
            y = batch["label"].to_numpy()
            for k in (0, 1):
                some = x[y == k]
                if len(some):
                    flat = np.concatenate([[len(some)], some.sum(axis=0), (some.T @ some).ravel()])
                    yield pd.DataFrame({"label": k, "at": np.arange(len(flat)), "value": flat})

    found = rows.select("text", "label").mapInPandas(sums, "label int, at int, value double")
    found = found.groupBy("label", "at").agg(F.sum("value").alias("value")).collect()  # two classes x statistics
    d = len(STATISTICS)
    total = np.zeros((2, 1 + d + d * d))
    for row in found:
        total[row["label"], row["at"]] = row["value"]
    return discriminant(total[:, 0], total[:, 1 : 1 + d], total[:, 1 + d :].reshape(2, d, d))


def score(text: Column, model: Discriminant) -> Column:
    """Probability that a whole text is of class 1; null counts as empty."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            parts = [model.score(matrix(some)) for some in in_slices(texts.fillna("").tolist())]
            yield pd.Series(np.concatenate(parts) if parts else [], dtype=float)
        release_memory()

    return run(text)


def scored_documents(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS, accept: float = ACCEPT) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Labels, ids and sources are never inputs of a score.  A null id is not held out,
    null and unknown labels teach nothing, an id labelled both ways neither.  Rows that
    repeat are scored alike.  Without labels every score is one half.
    """
    model = fit(docs, labels, most_rows)
    scored = docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text"), model).alias("score")
    )
    return scored.withColumn("predicted", F.when(F.col("score") >= accept, 1).otherwise(0))


def accepted(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS, accept: float = ACCEPT) -> DataFrame:
    """The rows of ``docs`` whose text is accepted, all their columns unchanged."""
    return docs.where(score(F.col("text"), fit(docs, labels, most_rows)) >= accept)

"""Label vocabularies: dictionaries, dense ids, set algebra and similar names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanmark.functions.keys import seeded_order
from gleanmark.functions.labels import is_irregular_label, jaccard, label_tokens, round4
from gleanmark.operators.ranking import dense_ids
from gleanmark.session import lookup, stage

# The bounds on the k-th similarity that a search tries, one after the other.
LEAST_SIMILARITIES = [0.8, 0.6, 0.4, 0.2, 0.0]

# Names that share a word before it indexes only a few of each kind.
HOT_NAMES = 100

# Fixed value: label columns, the first one found wins.
LABEL_PREFERENCE = ["label_name", "label"]


def label_table(spark: SparkSession, labels: DataFrame | Sequence[str]) -> DataFrame:
    """Distinct non-null ``label``s of a table, or of a list."""
    if not isinstance(labels, DataFrame):
        labels = spark.createDataFrame([(n,) for n in labels], "label string")
    return labels.select(F.col("label").cast("string").alias("label")).where("label is not null").distinct()


def with_membership(df: DataFrame, value: str, labels: DataFrame, out: str = "known") -> DataFrame:
    """Add whether ``value`` is a label of a table; a null value has a null answer."""
    known = lookup(labels.select(F.col("label").alias("_known")).where("_known is not null").distinct(), "labels")
    held = F.when(F.col(value).isNotNull(), F.col("_known").isNotNull())
    return df.join(known, F.col(value) == F.col("_known"), "left").select(*df.columns, held.alias(out))


def with_label_name(df: DataFrame, dictionary: DataFrame, label: str, out: str = "label_name") -> DataFrame:
    """Look an id up in a ``(label, label_name)`` dictionary; unknown ids give null.

    The dictionary is broadcast when its measured size allows.
    """
    names = dictionary.select(F.col("label").alias("_id"), F.col("label_name").alias(out))
    return df.join(names, F.col(label) == F.col("_id"), "left").drop("_id")


def resolve_label(df: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """Add ``resolved_label`` as a string from the best label column there is."""
    for name in LABEL_PREFERENCE:
        if name not in df.columns:
            continue
        if not isinstance(df.schema[name].dataType, T.IntegralType):
            return df.withColumn("resolved_label", F.col(name).cast("string"))
        if dictionary is None:
            raise ValueError(f"integer label column {name!r} needs a dictionary")
        return with_label_name(df, dictionary, name, "resolved_label")
    raise ValueError(f"no label column; tried {LABEL_PREFERENCE}, found {df.columns}")


def label_space(df: DataFrame, label: str) -> DataFrame:
    """``label, label_id``: sorted distinct labels, ids from 0."""
    names = stage(df.where(F.col(label).isNotNull()).select(F.col(label).alias("label")).distinct(), "names")
    return dense_ids(names, "label", "label_id").withColumn("label_id", F.col("label_id").cast("int"))


def encode(df: DataFrame, space: DataFrame, label: str) -> DataFrame:
    """Add ``label_id``; a label outside the space fails the job."""
    ids = space.select(F.col("label").alias("_name"), F.col("label_id").alias("_id"))
    unknown = F.raise_error(F.concat(F.lit("label outside the label space: "), F.col(label)))
    return (
        df.join(ids, F.col(label) == F.col("_name"), "left")
        .withColumn("label_id", F.coalesce(F.col("_id"), unknown.cast("int")))
        .drop("_name", "_id")
    )


def union_of_labels(frames: Sequence[DataFrame], label: str) -> DataFrame:
    """Sorted distinct labels over all tables."""
    out = None
    for df in frames:
        part = df.select(label).distinct()
        out = part if out is None else out.unionByName(part)
    return out.where(F.col(label).isNotNull()).distinct().orderBy(label)


def common_labels(a: DataFrame, b: DataFrame, label: str) -> DataFrame:
    return a.select(label).intersect(b.select(label))


def only_in_first(a: DataFrame, b: DataFrame, label: str) -> DataFrame:
    return a.select(label).subtract(b.select(label))


def same_labels(a: DataFrame, b: DataFrame, label: str) -> DataFrame:
    """One row: labels on one side only, and whether there are none."""
    sides = a.select(label, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(label, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    seen = sides.groupBy(label).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    return seen.agg(
        F.count_if((F.col("_a") == 1) & (F.col("_b") == 0)).alias("only_first"),
        F.count_if((F.col("_a") == 0) & (F.col("_b") == 1)).alias("only_second"),
        (F.count_if(F.col("_a") != F.col("_b")) == 0).alias("equal"),
    )


def irregular_labels(df: DataFrame, label: str) -> DataFrame:
    return df.select(label).distinct().where(is_irregular_label(label))


def _word_index(labels: DataFrame, label: str) -> DataFrame:
    """``name, words`` (structs of count and word, from rare to frequent) of the distinct names with words."""
    names = labels.select(F.col(label).cast("string").alias("name")).where("name is not null").distinct()
    words = stage(names.select("name", F.explode(label_tokens("name")).alias("word")), "name-words")
    held = words.groupBy("word").agg(F.count("*").alias("n"))
    return words.join(held, "word").groupBy("name").agg(F.array_sort(F.collect_list(F.struct("n", "word"))).alias("words"))


def name_pairs(names: DataFrame, least: float, k: int, hot: int = HOT_NAMES) -> DataFrame:
    """``a, b, jaccard``: pairs of names at or above ``least`` and above 0, enough of them for the top ``k``.

    Names are indexed under their rarest words, as many as a pair at ``least`` needs,
    and a pair meets under the first word that both have.  A word of more than ``hot``
    names indexes only the ``k + 1`` smallest names of each kind, which is the set of
    such words in a name and its size: two names that share hot words alone are as
    alike as any others of their kinds, so a pair with a greater name has ``k`` pairs
    before it.
    """
    least_words = F.greatest(F.ceil(F.size("words") * F.lit(least) - 1e-9), F.lit(1))
    held = names.withColumn("hot", F.filter("words", lambda w: w["n"] > hot)["word"])
    first = F.row_number().over(Window.partitionBy("hot", F.size("words")).orderBy("name"))
    # Everyone counts for a rare word, the smallest of a kind for a hot one.
    kind = held.where(F.size("hot") > 0).select("name", "words", "hot", first.alias("place")).where(F.col("place") <= k + 1)

    def under(rows: DataFrame, side: str, is_hot: bool) -> DataFrame:
        part = rows.select("name", F.col("words.word").alias(f"words_{side}"), F.explode(F.slice("words", 1, (F.size("words") - least_words + 1).cast("int"))).alias("w"))
        chosen = F.col("w.n") > hot if is_hot else F.col("w.n") <= hot
        return part.where(chosen).select(F.col("name").alias(side), f"words_{side}", F.col("w.word").alias("word"))

    out = None
    for rows, is_hot in ((held, False), (kind, True)):
        met = under(rows, "a", is_hot).join(under(rows, "b", is_hot), "word").where("a < b")
        both = F.array_intersect("words_a", "words_b")
        met = met.where(F.element_at(both, 1) == F.col("word"))
        part = met.select("a", "b", jaccard(F.col("words_a"), F.col("words_b")).alias("jaccard")).where(F.col("jaccard") >= least)
        out = part if out is None else out.unionByName(part)
    return out


def similar_labels(labels: DataFrame, label: str, k: int = 10, hot: int = HOT_NAMES) -> DataFrame:
    """The ``k`` most similar pairs of names by Jaccard of their words, above 0; ties by name.

    The bound on the k-th score starts high and is lowered until ``k`` pairs lie above
    it, so the usual search looks at few words of a name.
    """
    names = stage(_word_index(labels, label), "name-index")
    for least in LEAST_SIMILARITIES:
        found = name_pairs(names, least, k, hot).orderBy(F.desc("jaccard"), "a", "b").limit(k)
        found = stage(found, "similar")
        if found.count() == k:
            break
    return found.orderBy(F.desc("jaccard"), "a", "b").select("a", "b", round4("jaccard").alias("jaccard"))


def sample_rows(df: DataFrame, row_id: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows, the same ones for any partitioning."""
    return df.orderBy(seeded_order(seed, row_id), row_id).limit(n)

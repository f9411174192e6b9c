"""Mixing sources to target weights by weighted fair queueing.

Every copy of a document gets a virtual finish time: the words of its source up to
and with it, in a shuffled order, divided by the target of the source.  Copies are
taken in the order of that time until the budget, the sum of all targets, is used up.
A source thus takes words in proportion to its target at any point of the order.

The running sums are exact and no source is one task: a source is cut into about
sqrt(rows) slots of its shuffled order, the slots' sums are accumulated, and rows are
accumulated within a slot.  The global order is a range-sorted table; the budget ends
in one of its ranges, and only that range is accumulated row by row.

Only sizes and ids are dealt out and sorted.  What the mix takes of a source in one
epoch is a prefix of the source's order, so a row is held against the last place taken
and its text stays where it was read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gleanmark.llm.common import stage
from gleanmark.session import lookup

# Fixed values of the mix: weights by rank of the source, share of all words, most
# times a source may be repeated.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2

_WORD = r"[^\x20\x09-\x0D]+"
_SLOT_BITS = 60


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def shuffle_key(doc_id: Column, seed: int) -> Column:
    """60 bits of the MD5 of seed and id: the same order in any engine and at any time."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Sources by code point, null last, take the weights in turn.  Targets share
    ``share`` of all words by weight; those that would pass ``most_epochs`` times
    their source stop there, and what they leave goes to the others.  Sorted by
    cap over weight, the capped ones come first, so two running sums tell where the
    caps end.  One row per source is ranked here, never one per document.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    rank = (F.row_number().over(by_name) - 1) % len(weights)
    table = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), rank + 1))
    cap = F.lit(most_epochs) * F.col("source_size")
    by_cap = W.orderBy(cap / F.col("w"), F.col("source").asc_nulls_last())
    everything = W.partitionBy()
    before = by_cap.rowsBetween(W.unboundedPreceding, -1)
    table = (
        table.withColumn("all", F.sum("source_size").over(everything))
        .withColumn("capped", F.coalesce(F.sum(cap).over(before), F.lit(0)))
        .withColumn("open", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0)))
        .withColumn("level", (F.lit(share) * F.col("all") - F.col("capped")) / F.col("open"))
        .withColumn("is_open", F.col("w") * F.col("level") <= cap)
    )
    # The level of the first source that is not capped holds for all that follow.
    first = table.where("is_open").agg(
        F.min(F.struct(cap / F.col("w"), F.col("source").isNull(), F.col("source"), "level")).alias("f")
    )
    found = first.select(F.col("f.level").alias("final")).first()
    final = None if found is None else found["final"]
    target = F.col("source_size") * F.lit(float(most_epochs))
    if final is not None:
        target = F.least(target, F.col("w") * F.lit(final))
    return table.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    source: str = "source",
    text: str = "text",
    doc_id: str = "doc_id",
    weights=WEIGHTS,
    share: float = SHARE,
    most_epochs: int = MOST_EPOCHS,
    seed: int = 0,
) -> DataFrame:
    """``docs`` as column ``row``, with size, source_size, target, copies and taken.

    copies says how often the mix takes the document, taken how many words that is.
    A null or blank text has size 0; it takes nothing and, as it uses nothing up, has
    one copy.  A null source is a source of its own, ranked last.  Null ids and
    repeated rows are rows like others; equal rows are interchangeable.  A document
    is taken whole or not at all: the order stops before the first copy that passes
    the budget, and a source stops with the copy that reaches its target.
    """

    def sized(table: DataFrame) -> DataFrame:
        return table.select(
            F.struct(*table.columns).alias("row"),
            F.col(source).alias("source"),
            F.col(doc_id).alias("doc_id"),
            word_count(F.col(text)).alias("size"),
            shuffle_key(F.col(doc_id), seed).alias("key"),
        )

    rows = sized(docs)
    slim = stage(rows.select("source", "doc_id", "size", "key"), "sizes")
    by_source = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    aims = stage(targets(by_source.drop("n"), weights, share, most_epochs), "targets")
    facts = aims.agg(F.sum("target").alias("budget")).first()
    n = slim.count()
    if not n:
        empty = rows.withColumns({"source_size": F.lit(0).cast("long"), "target": F.lit(0.0)})
        return empty.withColumns({"copies": F.lit(0), "taken": F.lit(0).cast("long")}).drop("source", "doc_id", "key")
    budget = math.floor(facts["budget"] + 1e-6)

    bits = max(1, math.ceil(math.log2(n) / 2))
    slot = F.shiftright("key", _SLOT_BITS - bits)
    one_source = W.partitionBy("source").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    slots = (
        slim.groupBy("source", slot.alias("slot")).agg(F.sum("size").alias("sum"))
        .select("source", "slot", F.coalesce(F.sum("sum").over(one_source), F.lit(0)).alias("before"))
        .join(aims.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    )
    slots = stage(slots, "slots").withColumnsRenamed({"source": "s", "slot": "t"})
    in_slot = W.partitionBy("source", "slot").orderBy("key", F.col("doc_id").asc_nulls_last(), "size")

    # "behind": words of the equal rows that come after this one.
    placed = (
        slim.withColumn("slot", slot)
        .withColumns({
            "run": F.sum("size").over(in_slot.rowsBetween(W.unboundedPreceding, 0)),
            "equal": F.sum("size").over(in_slot.rangeBetween(W.unboundedPreceding, 0)),
        })
        .join(slots, F.col("source").eqNullSafe(F.col("s")) & (F.col("slot") == F.col("t")))
        .withColumns({"cum": F.col("run") + F.col("before"), "behind": F.col("equal") - F.col("run")})
    )

    def finish(epoch: Column) -> Column:
        """Virtual finish time of a copy."""
        return (F.col("cum") + epoch * F.col("source_size")) / F.col("target")

    def reaches(epoch: Column) -> Column:
        """Whether a copy begins before its source's target."""
        return F.col("cum") - F.col("size") + epoch * F.col("source_size") < F.col("target")

    place = ["time", "key", "doc_id", "source", "epoch", "cum"]
    copies = (
        placed.where("size > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(most_epochs - 1))))
        .where(reaches(F.col("epoch"))).withColumn("time", finish(F.col("epoch"))).select(*place, "size", "behind")
    )
    order = [F.col(c).asc_nulls_last() for c in place]
    ranges = max(1, math.ceil(math.sqrt(n) / 8))
    queue = stage(
        copies.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
        .withColumn("range", F.spark_partition_id()),
        "queue",
    )
    sums = queue.groupBy("range").agg(F.sum("size").alias("sum"))
    sums = sums.withColumn("upto", F.sum("sum").over(W.orderBy("range").rowsBetween(W.unboundedPreceding, 0)))
    last = sums.where(F.col("upto") > budget).orderBy("range").first()
    taken = queue
    if last is not None:
        # The budget ends in this range; the first copy that passes it ends the mix.
        run = F.sum("size").over(W.partitionBy("range").orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
        passing = queue.where(F.col("range") == last["range"]).withColumn("upto", run + (last["upto"] - last["sum"]))
        end = passing.where(F.col("upto") > budget).orderBy("upto").first()
        before_end = F.lit(False)
        for c in reversed(place):
            lower = F.col(c).isNotNull() if end[c] is None else F.col(c) < F.lit(end[c])
            before_end = F.coalesce(lower, F.lit(False)) | (F.col(c).eqNullSafe(F.lit(end[c])) & before_end)
        taken = queue.where(before_end)

    # The last place that each epoch takes of a source; no row moves to learn whether it lies before it.
    spot = F.struct("key", F.col("doc_id").isNull().alias("no_id"), "doc_id", "size")
    ends = [f"end{e}" for e in range(most_epochs)]
    lasts = [
        F.max(F.when(F.col("epoch") == e, F.struct(spot.alias("spot"), "cum", "behind"))).alias(end)
        for e, end in enumerate(ends)
    ]
    taken = taken.groupBy(F.col("source").alias("s")).agg(*lasts)
    bounds = aims.join(taken, F.col("source").eqNullSafe(F.col("s")), "left").drop("s").withColumnRenamed("source", "s")
    bounds = lookup(bounds, "bounds")

    def bounded(table: DataFrame) -> DataFrame:
        return sized(table).join(bounds, F.col("source").eqNullSafe(F.col("s")))

    placed_rows = bounded(docs).withColumn("nth", F.lit(1))
    # Where an epoch ends between equal rows, those alone are numbered: it takes the last of them.
    cut = bounds.select("s", F.explode(F.array(*ends)).alias("end")).where("end.behind > 0")
    cut = lookup(cut.select("s", F.col("end.spot.doc_id").alias("id")).distinct(), "cut")
    if not cut.isEmpty():
        halved = [(F.col(f"{end}.spot") == spot) & (F.col(f"{end}.behind") > 0) for end in ends]
        halved = F.greatest(F.lit(False), *halved)
        few = docs.join(cut, docs[source].eqNullSafe(cut["s"]) & docs[doc_id].eqNullSafe(cut["id"]), "left_semi")
        equal_rows = W.partitionBy("source", "key", "doc_id", "size").orderBy("size")
        numbered = bounded(few).where(halved).withColumn("nth", F.row_number().over(equal_rows))
        placed_rows = placed_rows.where(~halved).unionByName(numbered)

    def takes(end: str) -> Column:
        at_end = (spot == F.col(f"{end}.spot")) & (F.col("nth") * F.col("size") > F.col(f"{end}.behind"))
        return F.when((spot < F.col(f"{end}.spot")) | at_end, 1).otherwise(0)

    copies_taken = F.when(F.col("size") == 0, 1).otherwise(sum(map(takes, ends[1:]), takes(ends[0])))
    return placed_rows.select(
        "row", "size", "source_size", "target", copies_taken.alias("copies"),
        (F.col("size") * copies_taken).cast("long").alias("taken"),
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The columns of ``docs``, each row as often as the mix takes it."""
    taken = mix(docs, **options).where("copies > 0")
    again = taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return again.select("row.*")

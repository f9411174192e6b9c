"""Similar names and membership against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from gleanmark.operators import labelspace as ls


def plain(names, k):
    sets = sorted((n, frozenset(w for w in n.lower().replace("?", "").split("_") if w)) for n in {x for x in names if x is not None})
    pairs = [(len(x & y) / len(x | y), a, b) for i, (a, x) in enumerate(sets) for b, y in sets[i + 1 :] if x & y]
    return [(a, b, round(s + 1e-12, 4)) for s, a, b in sorted(pairs, key=lambda p: (-p[0], p[1], p[2]))[:k]]


def frame(spark, names):
    return spark.createDataFrame([(n,) for n in names], "n string")


@pytest.mark.parametrize("seed, vocabulary, hot, k", [(0, 8, 3, 10), (1, 40, 2, 25), (2, 200, 1, 10), (3, 5, 100, 60), (4, 12, 4, 1)])
def test_top_pairs_of_random_names(spark, seed, vocabulary, hot, k):
    rng = random.Random(seed)
    names = ["_".join(f"w{int(rng.random() ** 2 * vocabulary)}" for _ in range(rng.randrange(1, 7))) for _ in range(120)]
    names += [None, "", "_", "?", "W1_w1", "w1?"]
    got = [tuple(r) for r in ls.similar_labels(frame(spark, names), "n", k, hot).collect()]
    assert got == plain(names, k)


def test_fewer_pairs_than_asked_for(spark):
    got = [tuple(r) for r in ls.similar_labels(frame(spark, ["a_b", "b_c", "d", "e_f"]), "n", 10).collect()]
    assert got == [("a_b", "b_c", 0.3333)]
    assert ls.similar_labels(frame(spark, []), "n", 10).count() == 0


def test_a_word_in_a_third_of_the_names_makes_no_pair_explosion(spark):
    """1,000 names that share one word alone are 499,500 pairs of one similarity."""
    names = [f"card_x{i}_y{i}" if i % 3 == 0 else f"z{i}_v{i}_u{i}" for i in range(3000)]
    index = ls._word_index(frame(spark, names), "n")
    found = ls.name_pairs(index, 0.0, 10, hot=50)
    assert found.count() <= 11 * 10 // 2
    top = [tuple(r) for r in ls.similar_labels(frame(spark, names), "n", 10, hot=50).collect()]
    own = sorted(n for n in names if n.startswith("card"))
    assert top == [(own[0], b, 0.2) for b in own[1:11]]


def test_membership(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "v string").withColumn("_x", F.lit(1))
    labels = spark.createDataFrame([("a",), ("a",), (None,), ("c",)], "label string")
    got = ls.with_membership(df, "v", labels)
    assert got.columns == ["v", "_x", "known"]
    assert rows(got) == sorted([("a", 1, True), ("b", 1, False), (None, 1, None), ("a", 1, True)], key=repr)
    assert rows(ls.label_table(spark, ["a", "a", "b"])) == [("a",), ("b",)] and rows(ls.label_table(spark, labels)) == [("a",), ("c",)]

import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gleanmark.operators import split as sp
from gleanmark.operators.ranking import BUCKET_ROWS, cut_points
from gleanmark.plans.splitting import THREE_WAY, TWO_WAY, split_and_check


def largest_remainder(counts, fraction):
    """Rows each class keeps when ceil(fraction * n) are held out."""
    n = sum(counts.values())
    keep = n - math.ceil(fraction * n)
    whole = {c: keep * k // n for c, k in counts.items()}
    rest = sorted(counts, key=lambda c: (-(keep * counts[c] % n), c))
    for c in rest[: keep - sum(whole.values())]:
        whole[c] += 1
    return whole


def brute_force(data, seed=42):
    counts = Counter(label for _, label in data)
    keep = largest_remainder(counts, 0.25)
    left = {c: counts[c] - keep[c] for c in counts}
    val = largest_remainder(left, 0.60)
    out = {}
    for c in counts:
        ids = sorted(
            (i for i, label in data if label == c), key=lambda i: hashlib.md5(f"{seed}:{i}".encode()).hexdigest()
        )
        n_test = left[c] - val[c]
        for place, i in enumerate(ids):
            out[i] = "test" if place < n_test else "val" if place < left[c] else "train"
    return out


def test_split_equals_brute_force(spark):
    rng = random.Random(1)
    sizes = {"a": 1, "b": 2, "c": 3, "d": 9, "e": 35, "f": 187, "hot": 9000}
    labels = [c for c, n in sizes.items() for _ in range(n)]
    rng.shuffle(labels)
    data = list(enumerate(labels))
    expected = brute_force(data)
    for n in (1, 6):
        df = spark.createDataFrame(data, "id long, label string").repartition(n)
        got = {r["id"]: r["split"] for r in sp.stratified_split(df, "label", "id", THREE_WAY).collect()}
        assert got == expected


@pytest.mark.parametrize(
    "total,rounds,expected",
    [
        (23_326, THREE_WAY, {"train": 17_494, "val": 2_332, "test": 3_500}),
        (9_999, TWO_WAY, {"train": 8_799, "val": 1_200}),
    ],
)
def test_published_split_sizes(spark, total, rounds, expected):
    df = spark.range(total).select("id", F.concat(F.lit("c"), F.col("id") * F.col("id") % 27).alias("label"))
    parts = sp.stratified_split(df, "label", "id", rounds)
    assert {r["split"]: r["count"] for r in parts.groupBy("split").count().collect()} == expected


def test_quotas_stay_exact_beyond_double_precision(spark):
    big = {"a": 2**52 + 1, "b": 2**52 + 3, "c": 5}
    df = spark.createDataFrame(list(big.items()), "grp string, n long")
    got = {r["grp"]: r["kept"] for r in sp.kept_quota(df, "n", 0.25, "grp", "kept").collect()}
    n = sum(big.values())
    held = math.ceil(0.25 * n)
    assert sum(got.values()) == n - held
    assert all(abs(got[c] - (n - held) * big[c] / n) <= 1 for c in big)


@pytest.mark.parametrize("bucket_rows", [BUCKET_ROWS, 1])
def test_cut_points_select_exactly(spark, bucket_rows):
    keys = [(g, hashlib.md5(f"{g}{i}".encode()).hexdigest()) for g in "xy" for i in range(5000)]
    quotas = [("x", 0, 0), ("x", 1, 1), ("x", 2, 4999), ("y", 0, 2500), ("y", 1, 5000)]
    cuts = cut_points(
        spark.createDataFrame(keys, "grp string, order_key string"),
        spark.createDataFrame(quotas, "grp string, slot int, quota long"),
        bucket_rows,
    )
    got = {(r["grp"], r["slot"]): r["cut"] for r in cuts.collect()}
    for g, slot, quota in quotas:
        assert sum(1 for h, k in keys if h == g and k <= got[g, slot]) == quota


def test_checks_of_a_split(spark, rows):
    df = spark.range(1000).selectExpr("id", "concat('t', id) as text", "concat('l', id % 4) as label")
    checks = {(c, s): (v, ok) for c, ok, s, v in rows(split_and_check(df, "text", "label", "id").checks.select("check", "ok", "subject", "value"))}
    assert checks["conservation", "all"] == (1000.0, True)
    assert checks["missing_classes", "all"] == (0.0, True)
    assert all(ok for _, ok in checks.values())


def test_missing_class_is_found(spark, rows):
    df = spark.createDataFrame([("a", "train"), ("a", "val"), ("b", "train"), (None, "val")], "label string, split string")
    assert rows(sp.missing_classes(df, "label", "split", ["train", "val"])) == [("val", "b")]
    drift = {r["split"]: (r["max_change"], r["ok"]) for r in sp.class_drift(df, "label", "split", ["train", "val"]).collect()}
    assert drift["val"] == (0.333333, False)

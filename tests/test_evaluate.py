import math
import random

import pytest
from pyspark.sql import functions as F

from gleanmark.functions.labels import PARSE_ERROR
from gleanmark.operators import evaluate as ev
from gleanmark.plans.evaluation import evaluate


def brute_force(pairs, labels):
    """Per class and overall figures by counting, one class at a time."""
    classes = {}
    for c in labels:
        tp = sum(t == c == p for t, p in pairs)
        predicted = sum(p == c for _, p in pairs)
        support = sum(t == c for t, _ in pairs)
        precision = tp / predicted if predicted else 0.0
        recall = tp / support if support else 0.0
        f1 = 2 * tp / (predicted + support) if predicted + support else 0.0
        classes[c] = (precision, recall, f1, support)
    n = sum(s for *_, s in classes.values())
    return classes, {
        "accuracy": sum(t == p for t, p in pairs) / len(pairs),
        "macro_precision": sum(v[0] for v in classes.values()) / len(labels),
        "macro_recall": sum(v[1] for v in classes.values()) / len(labels),
        "macro_f1": sum(v[2] for v in classes.values()) / len(labels),
        "weighted_f1": sum(v[2] * v[3] for v in classes.values()) / n if n else 0.0,
    }


EDGES = [
    ("a", "a"), ("a", "a"), ("a", "b"), ("b", "b"), ("b", PARSE_ERROR), ("b", "elsewhere"),
    ("never", "a"), ("a", None), ("b", "b"),
]
LABELS = ["a", "b", "never", "empty"]


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "t string, p string")


def labels_frame(spark, labels):
    return spark.createDataFrame([(x,) for x in labels], "label string")


@pytest.mark.parametrize("labels", [LABELS, [*LABELS, PARSE_ERROR], ["a", "b"]])
def test_metrics_equal_brute_force(spark, labels):
    counts = ev.confusion(frame(spark, EDGES), "t", "p")
    classes, whole = brute_force(EDGES, labels)
    got = {r["label"]: r for r in ev.per_class(counts, labels_frame(spark, labels)).collect()}
    assert set(got) == set(labels)
    for c, (precision, recall, f1, support) in classes.items():
        assert got[c]["support"] == support
        for name, value in (("precision", precision), ("recall", recall), ("f1", f1)):
            assert math.isclose(got[c][name], value, abs_tol=5.1e-5)
    row = ev.overall(counts, labels_frame(spark, labels)).first()
    assert row["n_rows"] == len(EDGES)
    for name, value in whole.items():
        assert math.isclose(row[name], value, abs_tol=5.1e-5), name


def test_grouped_metrics_equal_single_ones(spark):
    rng = random.Random(2)
    data = [(g, rng.choice("abc"), rng.choice("abcd")) for g in ("x", "y") for _ in range(200)]
    df = spark.createDataFrame(data, "g string, t string, p string")
    counts = ev.confusion(df, "t", "p", ["g"])
    got = {r["g"]: r.asDict() for r in ev.overall(counts, labels_frame(spark, list("abc")), ["g"]).collect()}
    for g in ("x", "y"):
        _, whole = brute_force([(t, p) for h, t, p in data if h == g], list("abc"))
        assert all(math.isclose(got[g][k], v, abs_tol=5.1e-5) for k, v in whole.items())


def test_parse_error_lowers_macro_but_not_weighted(spark):
    pairs = [("a", "a")] * 9 + [("a", PARSE_ERROR)]
    counts = ev.confusion(frame(spark, pairs), "t", "p")
    listed = labels_frame(spark, ["a"])
    plain = ev.overall(counts, listed).first()
    policy = ev.labels_with_parse_error(listed, counts)
    assert policy.count() == 2
    widened = ev.overall(counts, policy).first()
    assert widened["macro_f1"] == round(plain["macro_f1"] / 2, 4)
    assert widened["weighted_f1"] == plain["weighted_f1"]
    none = ev.confusion(frame(spark, [("a", "a")]), "t", "p")
    assert ev.labels_with_parse_error(listed, none).count() == 1


def test_observed_labels(spark, rows):
    counts = ev.confusion(frame(spark, EDGES), "t", "p")
    assert [r[0] for r in rows(ev.observed_labels(counts))] == ["PARSE_ERROR", "a", "b", "elsewhere", "never"]


def test_confusion_grid(spark):
    counts = ev.confusion(frame(spark, EDGES), "t", "p")
    grid = {(r[0], r[1]): (r[2], r[3]) for r in ev.normalised_confusion(counts, labels_frame(spark, LABELS)).collect()}
    assert len(grid) == 16
    assert grid["a", "a"] == (2, 0.6667) and grid["empty", "a"] == (0, 0.0) and grid["never", "a"] == (1, 1.0)


def test_error_rows_keep_null_predictions(spark):
    df = frame(spark, EDGES).withColumn("text", F.lit("four"))
    errors = ev.error_rows(df, "t", "p", "text")
    assert errors.count() == 5 and errors.where("text_length = 4").count() == 5


def test_duration_summary(spark):
    rng = random.Random(4)
    values = [rng.random() * 10 for _ in range(300)]
    df = spark.createDataFrame([(i, v, "g") for i, v in enumerate(values)], "i long, v double, g string").repartition(5)
    row = ev.duration_summary(df, "v", "i", warmup=50, samples=100, by=["g"]).first()
    timed = values[50:150]
    mean = sum(timed) / 100
    assert row["n_samples"] == 100
    assert math.isclose(row["mean_ms"], mean, abs_tol=1e-4)
    assert math.isclose(row["std_ms"], math.sqrt(sum((x - mean) ** 2 for x in timed) / 100), abs_tol=1e-4)
    s = sorted(timed)
    assert math.isclose(row["p50_ms"], (s[49] + s[50]) / 2, abs_tol=1e-4)
    assert math.isclose(row["throughput_per_sec"], 1000 / mean, abs_tol=1e-3)


def test_empty_duration_window(spark):
    df = spark.createDataFrame([(1, 2.0, "g")], "i long, v double, g string")
    assert ev.duration_summary(df, "v", "i", warmup=5, samples=5, by=["g"]).count() == 0


def test_evaluate_bundle(spark):
    df = frame(spark, [("a", "a"), ("b", "a")]).withColumn("text", F.lit("x"))
    result = evaluate(df, labels_frame(spark, ["a", "b"]), "t", "p", "text")
    assert result.overall.first()["accuracy"] == 0.5
    assert result.errors.count() == 1 and result.confusion.count() == 4 and result.per_class.count() == 2


def test_no_timed_rows_give_nulls(spark):
    df = spark.createDataFrame([(1, 2.0)], "i long, v double")
    row = ev.duration_summary(df, "v", "i", warmup=5, samples=5).first()
    assert row["n_samples"] == 0 and row["mean_ms"] is None and row["throughput_per_sec"] is None

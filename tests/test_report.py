import json

import pytest
from pyspark.sql import functions as F

from gleanmark import schemas
from gleanmark.operators import profile as pf
from gleanmark.operators import report as rp
from gleanmark.plans.consolidation import consolidate
from gleanmark.sources.runs import read_runs

# Published per-class F1 of three models, the best model and the gap in points.
PUBLISHED = [
    ("balance_not_updated_after_bank_transfer", 0.6905, 0.7901, 0.7229, "encoder", 9.96),
    ("topping_up_by_card", 0.7838, 0.7949, 0.8649, "generator", 8.11),
    ("why_verify_identity", 0.8354, 0.8, 0.975, "generator", 17.5),
    ("declined_transfer", 0.9067, 0.8169, 0.8571, "linear", 8.98),
]
MODELS = ["linear", "encoder", "generator"]


def test_published_comparison_rows(spark):
    cells = [
        ("d", m, label, 0.5, 0.5, f1, 40) for label, *scores, _, _ in PUBLISHED for m, f1 in zip(MODELS, scores)
    ]
    df = spark.createDataFrame(
        cells, "dataset string, model string, label string, precision double, recall double, f1 double, support long"
    )
    got = rp.compare_models(df, MODELS, ["encoder", "linear", "generator"], "encoder").collect()
    assert [(r["label"], r["best_model"], r["max_model_gap_pp"]) for r in got] == [
        (label, best, gap) for label, _, _, _, best, gap in PUBLISHED
    ]


def test_ties_and_missing_classes(spark):
    df = spark.createDataFrame(
        [("b", "x", 0.5, 3), ("a", "x", 0.5, 3), ("a", "y", 0.9, 4)], "model string, label string, f1 double, support long"
    ).withColumns({"precision": F.lit(0.1), "recall": F.lit(0.2)})
    got = {r["label"]: r for r in rp.compare_models(df, ["a", "b"], ["b", "a"], "b").collect()}
    assert got["x"]["best_model"] == "a" and not got["x"]["missing_somewhere"]
    assert got["y"]["best_model"] == "a" and got["y"]["missing_somewhere"] and got["y"]["b_f1"] is None
    assert got["y"]["max_model_gap_pp"] == 0.0 and got["y"]["support"] == 4
    assert [r["label"] for r in rp.compare_models(df, ["a", "b"], ["b", "a"], "b").collect()] == ["x", "y"]


def document(run, model, acc, f1, **over):
    per_class = {"x": {"precision": acc, "recall": acc, "f1": f1, "support": 4}, "PARSE_ERROR": {"precision": 0, "recall": 0, "f1": 0, "support": 0}}
    metrics = {"accuracy": acc, "macro_f1": f1, "macro_precision": acc, "macro_recall": acc, "weighted_f1": f1, "per_class": per_class}
    out = {
        "run_id": run, "dataset": "d", "model": model, "test_set_hash": "sha256:1",
        "training_wallclock_seconds": 2.5, "metrics": {"intent": metrics, "intent_val": metrics},
        "latency": {"p50_ms": 1.0, "p95_ms": 2.0}, "resources": {"parameters_total": 7, "disk_size_mb": 1.5},
    }
    out.update(over)
    return out


def runs(spark, tmp_path, *documents):
    folder = tmp_path / "runs"
    folder.mkdir()
    for i, d in enumerate(documents):
        (folder / f"{i}.json").write_text(json.dumps(d, indent=2))
    return read_runs(spark, str(folder))


def test_consolidation_with_fallbacks(spark, tmp_path):
    df = runs(
        spark, tmp_path, document("r1", "a", 0.9, 0.85),
        document("r2", "b", 0.6, 0.99, training_wallclock_seconds=None, resources={"disk_size_mb": None}, latency={}, test_set_hash="sha256:2"),
    )
    log = spark.createDataFrame([("r2", 9.0)], "run_id string, train_runtime double")
    sizes = spark.createDataFrame([("b", 77, 0.5)], "model string, parameters_total long, disk_size_mb double")
    result = consolidate(df, ["a", "b"], ["a", "b"], "a", "d", log, sizes)
    got = {r["model"]: r for r in result.summary.collect()}
    assert (got["a"]["training_time_sec"], got["a"]["model_params"], got["a"]["size_mb"]) == (2.5, 7, 1.5)
    assert (got["b"]["training_time_sec"], got["b"]["model_params"], got["b"]["size_mb"]) == (9.0, 77, 0.5)
    assert got["b"]["inference_p50_ms"] is None and len(result.summary.columns) == 11
    assert result.differences.count() == 0
    assert [r["label"] for r in result.comparison.collect()] == ["x"]
    failed = {(r["run_id"], r["gate"]) for r in result.gates.where("not ok").collect()}
    assert failed == {("r2", "f1_close_to_accuracy")}
    assert result.fingerprints.first()["ok"] is False
    ship = {r["run_id"]: r["ship"] for r in rp.ship_decision(df).collect()}
    assert ship == {"r1": True, "r2": True}
    assert sorted(r["file"] for r in df.collect()) == ["0.json", "1.json"]


def test_gates(spark, tmp_path):
    df = runs(spark, tmp_path, document("perfect", "a", 1.0, 1.0), document("low", "b", 0.04, 0.01), document("mid", "c", 0.4, 0.4))
    failed = {(r["run_id"], r["gate"]) for r in rp.sanity_gates(df).where("not ok").collect()}
    assert failed == {("perfect", "accuracy_not_perfect"), ("low", "accuracy_above_floor")}
    strict = rp.sanity_gates(df, rp.STRICT_ACCURACY_FLOOR).where("not ok and run_id = 'mid'")
    assert strict.first()["gate"] == "accuracy_above_floor"


def test_required_fields_and_gates_stop_a_consolidation(spark, tmp_path):
    (tmp_path / "good").mkdir(), (tmp_path / "bad").mkdir()
    good = runs(spark, tmp_path / "good", document("r1", "a", 0.9, 0.85), document("r2", "b", 0.9, 0.85))
    bad = runs(spark, tmp_path / "bad", document("r1", "a", 0.9, 0.85, model_name=" ", resources=None))
    missing = {(r["run_id"], r["field"]) for r in rp.required_fields(bad).where("not ok").collect()}
    assert missing == {("r1", "model_name"), ("r1", "resources")}
    stated = good.withColumn("model_name", F.lit("m"))
    consolidate(stated, ["a", "b"], ["a", "b"], "a", "d", enforced=True)
    with pytest.raises(ValueError, match="model_name|resources"):
        consolidate(bad, ["a"], ["a"], "a", "d", enforced=True)
    with pytest.raises(ValueError, match="n_fingerprints"):
        odd = stated.withColumn("test_set_hash", F.concat("test_set_hash", "run_id"))
        consolidate(odd, ["a", "b"], ["a", "b"], "a", "d", enforced=True)
    with pytest.raises(ValueError, match="accuracy_not_perfect"):
        perfect = stated.withColumn("metrics", F.col("metrics").withField("intent.accuracy", F.lit(1.0)))
        consolidate(perfect, ["a", "b"], ["a", "b"], "a", "d", enforced=True)


def test_cross_check_names_differences_and_gaps(spark, rows):
    a = spark.createDataFrame([("x", 1.0, None), ("y", 2.0, 3.0)], "k string, m double, n double")
    b = spark.createDataFrame([("x", 1.0, None), ("z", 2.0, 3.0)], "k string, m double, n double")
    assert rows(rp.cross_check(a, b, ["k"], ["m", "n"])) == [
        ("y", "m", 2.0, None), ("y", "n", 3.0, None), ("z", "m", None, 2.0), ("z", "n", None, 3.0),
    ]


def test_last_logged_skips_nulls(spark):
    log = spark.createDataFrame([(1, 5.0), (2, 7.0), (3, None)], "step long, train_runtime double").withColumn("run_id", F.lit("r"))
    assert rp.last_logged(log, ["run_id"], "train_runtime", ["step"]).first()["train_runtime"] == 7.0


def test_fingerprint_ignores_order_but_not_content(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", "c"), (2, "b", "c")], "i int, t string, u string")

    def print_of(x):
        return rp.content_fingerprint(x).first()["fingerprint"]

    base = print_of(df)
    assert print_of(df.select("u", "i", "t").repartition(3).orderBy(F.desc("i"))) == base
    assert print_of(df.distinct()) != base
    assert print_of(df.withColumn("t", F.when(F.col("i") == 1, "x").otherwise(F.col("t")))) != base


def test_schemas_parse(spark):
    for ddl in (schemas.RUN, schemas.TRAINING_LOG, schemas.GENERATION, schemas.CHAT, schemas.TIMING, schemas.HIERARCHICAL_CORPUS, schemas.FLAT_CORPUS):
        assert spark.createDataFrame([], ddl).count() == 0


def test_length_profile_and_histogram(spark, rows):
    texts = ["a", "bb c", "d" * 11, "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["measure"]: r for r in pf.length_profile(df, pf.text_lengths("t")).collect()}
    chars = sorted(len(t or "") for t in texts)
    assert got["chars"]["mean"] == sum(chars) / 5 and got["chars"]["p50"] == chars[2] and got["chars"]["max"] == 11
    mean = sum(chars) / 5
    assert abs(got["chars"]["std"] - (sum((c - mean) ** 2 for c in chars) / 4) ** 0.5) < 1e-4
    bins = pf.fixed_bin_histogram(df, {"chars": F.char_length(F.coalesce("t", F.lit("")))}, 11)
    assert dict(rows(bins.select("bin", "n"))) == {1: 2, 2: 1, 5: 1, 11: 1}
    one = pf.fixed_bin_histogram(df.where("t = 'a'"), {"chars": F.char_length("t")}, 4)
    assert rows(one.select("bin", "n")) == [(1, 1)]
    single = pf.length_profile(df.where("t = 'a'"), pf.text_lengths("t")).where("measure = 'chars'").first()
    assert single["std"] is None and single["p99"] == 1.0


def test_tags(spark, rows):
    df = spark.createDataFrame([("BQ",), ("B Q",), ("B",), (None,), ("",)], "f string")
    assert rows(pf.tag_letters(df, "f")) == [("B", 3), ("Q", 2)]
    assert rows(pf.empty_tags(df, "f")) == [(2, 4)]
    assert pf.tag_values(df, "f", 1).first()["tags"] == ""


def test_crosstab_and_feasibility(spark, rows):
    df = spark.createDataFrame([("a", "x")] * 9 + [("b", "y")] * 2, "c string, l string")
    assert rows(pf.crosstab(df, "c", "l", ["x", "y", "z"])) == [("a", 9, 0, 0, 0), ("b", 0, 2, 0, 0)]
    assert rows(pf.crosstab(df, "c", "l", ["x"])) == [("a", 9, 0), ("b", 0, 2)]
    got = pf.split_feasibility(df, "l").first()
    assert (got["n_too_small"], got["expected_of_rarest"], got["feasible"]) == (1, 0.24, False)


def test_rows_that_differ_are_found_from_the_root_down(spark, tmp_path, rows):
    from gleanmark.operators import fingerprints as fp

    first = spark.range(3000).selectExpr("id", "concat('text ', id) as text", "if(id % 7 = 0, null, id) as n")
    second = (
        first.where("id not in (5, 2999)").withColumn("text", F.expr("if(id = 1234, 'other', text)"))
        .unionByName(spark.createDataFrame([(9000, "new", 1), (77, "text 77", None)], "id long, text string, n long"))
    )
    paths = [str(tmp_path / name) for name in "abc"]
    for df, path in zip((first, second, first.repartition(3)), paths):
        fp.write_fingerprinted(df, ["id"], path)
    assert rows(fp.differing_rows(first, ["id"], *paths[:2])) == sorted(
        [(5, "only_first"), (2999, "only_first"), (1234, "changed"), (77, "changed"), (9000, "only_second")], key=repr
    )
    buckets = fp.differing_buckets(spark, *paths[:2])
    assert buckets.count() == 5
    assert fp.differing_rows(first, ["id"], paths[0], paths[2]).count() == 0
    plan = fp.differing_rows(first, ["id"], *paths[:2])._jdf.queryExecution().toString()
    assert "PartitionFilters: [_folder" in plan


def test_consolidation_names_cells_that_the_documents_do_not_state(spark):
    from gleanmark.operators import report as rp
    from gleanmark.plans.consolidation import CHECKED

    runs = spark.createDataFrame(
        [("d", "m", 0.5)], "dataset string, model string, x double"
    ).selectExpr("dataset", "model", "named_struct('intent', named_struct('accuracy', x, 'macro_f1', x), 'intent_val', named_struct('accuracy', x, 'macro_f1', x)) as metrics", "named_struct('p50_ms', 1.0D, 'p95_ms', 2.0D) as latency")
    summary = rp.document_cells(runs, CHECKED)
    assert rp.cross_check(summary, summary, ["dataset", "model"], list(CHECKED)).count() == 0
    changed = summary.withColumn("test_acc", F.lit(0.6))
    assert [tuple(r) for r in rp.cross_check(changed, summary, ["dataset", "model"], list(CHECKED)).collect()] == [("d", "m", "test_acc", 0.6, 0.5)]

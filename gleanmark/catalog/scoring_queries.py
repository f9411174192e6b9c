"""Classifier metrics, answer parsing, run reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanmark.catalog.inputs import (
    documents,
    CATEGORIES,
    EVENT_LABELS,
    MODELS,
    ORDER_LABELS,
    SQL_EVENT_PREDICTIONS,
    SQL_PARSED,
    SQL_PREDICTIONS,
    SQL_TWO_LINE,
    answers,
    category_of,
    digit,
    event_predictions,
    label_table,
    predictions,
    sql_category_of,
    sql_digit,
    sql_list,
    sql_metrics,
    two_line_answers,
)
from gleanmark.catalog.registry import query
from gleanmark.operators import closest as cl
from gleanmark.operators import evaluate as ev
from gleanmark.operators import fingerprints as fp
from gleanmark.operators import labelspace as ls
from gleanmark.operators import parse as ps
from gleanmark.operators import report as rp
from gleanmark.plans import evaluation as pe
from gleanmark.session import scratch_path, stage
from gleanmark.sources.runs import read_runs
from gleanmark.sources.tables import read_table

BY = ["dataset", "model", "split"]
SQL_BY = "dataset, model, split"


def _sql_labels(name: str = "listed", groups: str = SQL_BY, source: str = "predictions") -> str:
    """Each data set's own label list, per group."""
    return f"""{name} AS (
  SELECT {groups}, unnest(CASE dataset WHEN 'events' THEN {sql_list([*EVENT_LABELS, 'refund'])} ELSE {sql_list(ORDER_LABELS)} END) AS label
  FROM (SELECT DISTINCT {groups} FROM {source}))"""


def _label_lists(spark):
    """``dataset, label``; the events list has a class that never occurs."""
    rows = [("events", x) for x in [*EVENT_LABELS, "refund"]] + [("orders", x) for x in ORDER_LABELS]
    return spark.createDataFrame(rows, "dataset string, label string")


def _spine(spark, counts):
    """The label list of each group's data set."""
    groups = counts.select(*BY).distinct()
    return groups.join(F.broadcast(_label_lists(spark)), "dataset").select(*BY, "label")


def _confusion(spark, d):
    return ev.confusion(predictions(spark, d), "true_label", "predicted_label", BY)


# --- metrics ----------------------------------------------------------------------


@query(f"WITH {SQL_PREDICTIONS}, {_sql_labels()}, {sql_metrics('predictions', SQL_BY, 'listed')} SELECT * FROM avg")
def overall_metrics(spark, d):
    counts = _confusion(spark, d)
    return ev.overall(counts, _spine(spark, counts), BY)


@query(f"WITH {SQL_PREDICTIONS}, {_sql_labels()}, {sql_metrics('predictions', SQL_BY, 'listed')} SELECT * FROM cls")
def per_class_metrics(spark, d):
    counts = _confusion(spark, d)
    return ev.per_class(counts, _spine(spark, counts), BY)


@query(f"""WITH {SQL_PREDICTIONS},
observed AS (SELECT DISTINCT {SQL_BY}, true_label AS label FROM predictions UNION SELECT DISTINCT {SQL_BY}, predicted_label FROM predictions),
{sql_metrics('predictions', SQL_BY, 'observed')} SELECT * FROM avg WHERE split = 'val'""")
def validation_metrics_over_observed_labels(spark, d):
    counts = _confusion(spark, d).where("split = 'val'")
    return ev.overall(counts, ev.observed_labels(counts, BY), BY)


@query(f"""WITH {SQL_EVENT_PREDICTIONS}
SELECT split, accuracy, n_rows FROM (
  SELECT split, round(avg((true_label = predicted_label)::INT), 4) AS accuracy, count(*) AS n_rows FROM (
    SELECT split, true_label, {sql_list(EVENT_LABELS)}[list_position(list_transform({sql_list(EVENT_LABELS)}, lambda x: CASE WHEN x = predicted_label THEN 0.9 ELSE 0.1 END), 0.9)] AS predicted_label
    FROM event_predictions) GROUP BY split)""")
def accuracy_from_scores(spark, d):
    """Predictions given as one score per label: the first greatest one wins."""
    labels = F.array(*[F.lit(x) for x in EVENT_LABELS])
    rows = event_predictions(spark, d)
    scores = F.transform(labels, lambda x: F.when(x == F.col("predicted_label"), 0.9).otherwise(0.1))
    named = rows.withColumn("predicted_label", F.element_at(labels, ev.argmax_label(scores) + 1))
    counts = ev.confusion(named, "true_label", "predicted_label", ["split"])
    return ev.overall(counts, ev.observed_labels(counts, ["split"]), ["split"]).select("split", "accuracy", "n_rows")


@query(f"""WITH {SQL_PREDICTIONS} SELECT {SQL_BY}, true_label, predicted_label, count(*) AS n FROM predictions GROUP BY ALL""")
def confusion_counts(spark, d):
    return _confusion(spark, d)


@query(f"""WITH {SQL_EVENT_PREDICTIONS}, labels AS (SELECT unnest({sql_list([*EVENT_LABELS, 'refund'])}) AS label),
cells AS (SELECT t.label AS true_label, p.label AS predicted_label,
  (SELECT count(*) FROM event_predictions e WHERE e.true_label = t.label AND e.predicted_label = p.label) AS n FROM labels t, labels p)
SELECT true_label, predicted_label, n,
  round(CASE WHEN sum(n) OVER (PARTITION BY true_label) > 0 THEN n / sum(n) OVER (PARTITION BY true_label) ELSE 0 END, 4) AS share FROM cells""")
def confusion_shares(spark, d):
    counts = ev.confusion(event_predictions(spark, d), "true_label", "predicted_label")
    return ev.normalised_confusion(counts, label_table(spark, [*EVENT_LABELS, "refund"]))


_SQL_POLICIES = f"""{SQL_PARSED},
preds AS (SELECT true_intent AS true_label, coalesce(pred_intent, 'PARSE_ERROR') AS predicted_label FROM parsed),
policies AS (
  SELECT 'listed' AS policy, unnest({sql_list([*EVENT_LABELS, 'refund'])}) AS label
  UNION ALL SELECT 'with_parse_error', unnest({sql_list([*EVENT_LABELS, 'refund', 'PARSE_ERROR'])})
  UNION ALL SELECT 'observed', label FROM (SELECT true_label AS label FROM preds UNION SELECT predicted_label FROM preds)
  UNION ALL SELECT 'gold', label FROM (SELECT DISTINCT true_label AS label FROM preds)),
grouped AS (SELECT policy, true_label, predicted_label FROM preds, (SELECT DISTINCT policy FROM policies))"""


@query(f"""WITH {_SQL_POLICIES}, {sql_metrics('grouped', 'policy', 'policies')} SELECT * FROM avg""")
def metrics_under_each_label_policy(spark, d):
    rows = pe.parse_generations(answers(spark, d), EVENT_LABELS)
    counts = stage(ev.confusion(rows, "true_intent", "predicted_intent"), "counts")
    listed = label_table(spark, [*EVENT_LABELS, "refund"])
    policies = {
        "listed": listed,
        "with_parse_error": ev.labels_with_parse_error(listed, counts),
        "observed": ev.observed_labels(counts),
        "gold": counts.select(F.col("true_label").alias("label")).distinct(),
    }
    out = None
    for name, labels in policies.items():
        part = ev.overall(counts, labels).withColumn("policy", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


@query(f"""WITH {SQL_EVENT_PREDICTIONS},
lifted AS (SELECT split, {sql_category_of('true_label')} AS true_label, {sql_category_of('predicted_label')} AS predicted_label FROM event_predictions),
listed AS (SELECT split, unnest({sql_list(CATEGORIES)}) AS label FROM (SELECT DISTINCT split FROM lifted)),
{sql_metrics('lifted', 'split', 'listed')} SELECT * FROM cls""")
def category_level_metrics(spark, d):
    lifted = event_predictions(spark, d).select(
        "split", category_of(F.col("true_label")).alias("true_label"), category_of(F.col("predicted_label")).alias("predicted_label")
    )
    counts = ev.confusion(lifted, "true_label", "predicted_label", ["split"])
    return ev.per_class(counts, label_table(spark, CATEGORIES), ["split"])


@query(f"""WITH {SQL_EVENT_PREDICTIONS},
listed AS (SELECT split, unnest({sql_list(EVENT_LABELS)}) AS label FROM (SELECT DISTINCT split FROM event_predictions)),
{sql_metrics('event_predictions', 'split', 'listed')},
long AS (SELECT * FROM (SELECT split, accuracy, macro_f1, macro_precision, macro_recall, weighted_f1 FROM avg)
  UNPIVOT (value FOR metric IN (accuracy, macro_f1, macro_precision, macro_recall, weighted_f1)))
SELECT metric, max(value) FILTER (WHERE split = 'val') AS val, max(value) FILTER (WHERE split = 'test') AS test FROM long GROUP BY metric""")
def validation_beside_test_metrics(spark, d):
    counts = ev.confusion(event_predictions(spark, d), "true_label", "predicted_label", ["split"])
    metrics = ev.overall(counts, label_table(spark, EVENT_LABELS), ["split"])
    return ev.side_by_side(metrics, "split", ["val", "test"])


@query(f"""WITH {SQL_PREDICTIONS}, {_sql_labels()}, {sql_metrics('predictions', SQL_BY, 'listed')}
SELECT label, precision, recall, f1, support FROM cls WHERE dataset = 'orders' AND model = 'rules' AND split = 'test' ORDER BY f1, label LIMIT 3""")
def weakest_classes(spark, d):
    counts = _confusion(spark, d).where("dataset = 'orders' and model = 'rules' and split = 'test'").drop(*BY)
    return ev.weakest_classes(ev.per_class(counts, label_table(spark, ORDER_LABELS)), 3)


@query("""WITH timed AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS place FROM events)
SELECT event_type, round(quantile_cont(value, 0.5), 4) AS p50_ms, round(quantile_cont(value, 0.95), 4) AS p95_ms,
  round(quantile_cont(value, 0.99), 4) AS p99_ms, round(avg(value), 4) AS mean_ms, round(stddev_pop(value), 4) AS std_ms,
  round(1000.0 / greatest(avg(value), 1e-9), 4) AS throughput_per_sec, count(*) AS n_samples
FROM timed WHERE place > 50 AND place <= 550 GROUP BY 1""")
def duration_summary(spark, d):
    events = read_table(spark, d, "events")
    return ev.duration_summary(events, "value", "event_id", warmup=50, samples=500, by=["event_type"])


# --- parsing -----------------------------------------------------------------------


@query(f"WITH {SQL_PARSED} SELECT row_id, pred_intent, parse_error, parse_path FROM parsed")
def parsed_answers(spark, d):
    return ps.parse_answers(answers(spark, d), "pred_raw", EVENT_LABELS).select(
        "row_id", "pred_intent", "parse_error", "parse_path"
    )


@query(f"""WITH {SQL_TWO_LINE} SELECT row_id, pred_category, pred_intent, parse_error FROM two_line""")
def parsed_two_line_answers(spark, d):
    return ps.parse_two_line_answers(two_line_answers(spark, d), "raw", CATEGORIES, EVENT_LABELS).select(
        "row_id", "pred_category", "pred_intent", "parse_error"
    )


@query(f"""WITH {SQL_PARSED}, paths AS (SELECT unnest(['regex', 'bare', 'fuzzy', 'none']) AS parse_path)
SELECT parse_path, count(row_id) AS n, round(count(row_id) / (SELECT count(*) FROM parsed), 6) AS share
FROM paths LEFT JOIN parsed USING (parse_path) GROUP BY 1""")
def parse_path_counts(spark, d):
    return ps.path_counts(ps.parse_answers(answers(spark, d), "pred_raw", EVENT_LABELS))


@query(f"""WITH {SQL_PARSED}, f AS (SELECT * FROM parsed ORDER BY row_id LIMIT 10)
SELECT count(*) FILTER (WHERE parse_path = 'regex') AS n_regex, count(*) FILTER (WHERE parse_path = 'bare') AS n_bare,
  count(*) FILTER (WHERE parse_path = 'fuzzy') AS n_fuzzy, count(*) FILTER (WHERE parse_path = 'none') AS n_none,
  count(*) FILTER (WHERE parse_path = 'none') <= 2 AS ok FROM f""")
def parser_preflight(spark, d):
    return ps.preflight(answers(spark, d), "pred_raw", "row_id", EVENT_LABELS)


@query(f"""SELECT event_id, event_type IN ('click', 'view', 'refund') AS known FROM events""")
def vocabulary_membership(spark, d):
    events = read_table(spark, d, "events").select("event_id", "event_type")
    labels = label_table(spark, ["click", "view", "refund"])
    return ls.with_membership(events, "event_type", labels).drop("event_type")


# A label with one letter dropped or doubled is still closest to itself.
@query(f"""SELECT doc_id, CASE WHEN {sql_digit('typo', 'doc_id')} = 0 THEN NULL ELSE source END AS nearest FROM documents""")
def nearest_labels(spark, d):
    docs = documents(spark, d)
    n = digit("typo", "doc_id")
    typo = (
        F.when(n == 0, "nothing like it")
        .when(n < 8, F.concat("source", F.lit("_")))
        .otherwise(F.concat(F.lit("s"), "source"))
    )
    asked = docs.select("doc_id", typo.alias("typo"))
    found = cl.closest_labels(asked, "typo", docs.select("source"), "source")
    return asked.join(found, asked["typo"] == found["candidate"], "left").select("doc_id", F.col("label").alias("nearest"))


# A brand whose number is illegible is as close to every brand with a number of one digit.
@query("""WITH brands AS (SELECT DISTINCT p_brand AS brand FROM part),
shortest AS (SELECT max(brand) AS brand FROM brands WHERE length(brand) = (SELECT min(length(brand)) FROM brands)),
blurred AS (SELECT p_partkey, 'Brand#' || repeat('x', (p_partkey % 3)::INT + 1) AS written FROM part)
SELECT p_partkey, written, brand AS nearest, round(12 / (length(written) + length(brand)), 4) AS ratio
FROM blurred, shortest WHERE 12 / (length(written) + length(brand)) >= 0.7""")
def nearest_labels_with_ties(spark, d):
    """Of many equally close labels the greatest is the answer."""
    part = read_table(spark, d, "part").select("p_partkey", "p_brand")
    part = part.withColumn("written", F.concat(F.lit("Brand#"), F.repeat(F.lit("x"), (F.col("p_partkey") % 3 + 1).cast("int"))))
    found = cl.closest_labels(part, "written", part, "p_brand")
    return part.join(found, part["written"] == found["candidate"]).select(
        "p_partkey", "written", F.col("label").alias("nearest"), F.round("ratio", 4).alias("ratio")
    )


@query(f"""WITH {SQL_PARSED},
preds AS (SELECT 'x' AS one, true_intent AS true_label, coalesce(pred_intent, 'PARSE_ERROR') AS predicted_label FROM parsed),
listed AS (SELECT 'x' AS one, unnest({sql_list([*EVENT_LABELS, 'PARSE_ERROR'])}) AS label),
{sql_metrics('preds', 'one', 'listed')} SELECT label, precision, recall, f1, support FROM cls""")
def reparsed_and_evaluated(spark, d):
    return pe.reparse_and_evaluate(answers(spark, d), EVENT_LABELS, "row_id").evaluation.per_class


@query(f"""WITH {SQL_PARSED}
SELECT row_id, true_intent, coalesce(pred_intent, 'PARSE_ERROR') AS predicted_intent, parse_path, length(text)::INT AS text_length
FROM parsed WHERE coalesce(pred_intent, 'PARSE_ERROR') <> true_intent""")
def reparsed_errors(spark, d):
    errors = pe.reparse_and_evaluate(answers(spark, d), EVENT_LABELS, "row_id").evaluation.errors
    return errors.select(
        "row_id", "true_intent", "predicted_intent", "parse_path", "text_length"
    )


# --- run reports ------------------------------------------------------------------------

_SQL_TEST = "predictions_test AS (SELECT dataset, model, true_label, predicted_label FROM predictions WHERE split = 'test')"
_SQL_VAL = "predictions_val AS (SELECT dataset, model, true_label, predicted_label FROM predictions WHERE split = 'val')"
_DM = "dataset, model"
_SQL_RUNS = f"""{SQL_PREDICTIONS}, {_SQL_TEST}, {_SQL_VAL}, {_sql_labels('listed', _DM)},
{sql_metrics('predictions_test', _DM, 'listed', 't_')},
{sql_metrics('predictions_val', _DM, 'listed', 'v_')},
durations AS (
  SELECT model, round(quantile_cont(value, 0.5), 4) AS p50_ms, round(quantile_cont(value, 0.95), 4) AS p95_ms
  FROM (SELECT m.model, value, row_number() OVER (PARTITION BY m.model ORDER BY event_id) AS place FROM events, models m
        WHERE m.k % 5 = events.event_id % 5) WHERE place > 50 AND place <= 550 GROUP BY 1),
training AS (SELECT model, round(sum(value), 4) AS seconds FROM events, models WHERE event_type = 'error' AND models.k % 5 = event_id % 5 GROUP BY 1)"""


def _runs(spark, d):
    """One nested document per data set and model, written as files and read back.

    The forest has no training time and the rules no sizes, so the fall-backs are
    needed.
    """
    counts = stage(_confusion(spark, d), "run-confusions")
    spine = _spine(spark, counts)
    overall = ev.overall(counts, spine, BY)
    classes = (
        ev.per_class(counts, spine, BY)
        .groupBy(*BY)
        .agg(
            F.map_from_entries(
                F.collect_list(F.struct("label", F.struct("precision", "recall", "f1", "support")))
            ).alias("per_class")
        )
    )
    metrics = overall.join(classes, BY).select(*BY, F.struct(*ev.SCALARS, "per_class").alias("m"), "n_rows")
    both = metrics.groupBy("dataset", "model").agg(
        F.max_by("m", F.when(F.col("split") == "test", 1)).alias("intent"),
        F.max_by("m", F.when(F.col("split") == "val", 1)).alias("intent_val"),
        F.sum(F.when(F.col("split") == "test", F.col("n_rows"))).alias("n_samples"),
    )
    events = _timed_events(spark, d)
    latency = ev.duration_summary(events, "value", "event_id", 50, 500, ["model"]).withColumnRenamed(
        "n_samples", "n_samples_timed"
    )
    seconds = _training_seconds(spark, d)
    rule = F.col("model") == "rules"
    # Every run names the rows that it was tested on.
    tested = predictions(spark, d).where("split = 'test'").select("dataset", "model", "row_id", "text", "true_label")
    hashes = rp.content_fingerprint(tested, ["dataset", "model"]).drop("n_rows")
    documents = both.join(latency, "model").join(seconds, "model").join(hashes, ["dataset", "model"]).select(
        F.concat_ws("_", "model", "dataset").alias("run_id"),
        "dataset",
        "model",
        F.col("fingerprint").alias("test_set_hash"),
        "n_samples",
        F.when(F.col("model") != "forest", F.col("seconds")).alias("training_wallclock_seconds"),
        F.struct("intent", "intent_val").alias("metrics"),
        F.struct("p50_ms", "p95_ms", "p99_ms", "mean_ms", "std_ms", "throughput_per_sec", "n_samples_timed").alias("latency"),
        F.struct(
            F.when(~rule, F.char_length("model") * 1000).alias("parameters_total"),
            F.when(~rule, F.lit(2.5)).alias("disk_size_mb"),
        ).alias("resources"),
    )
    path = scratch_path(spark, "runs")
    documents.select(F.to_json(F.struct("*")).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return read_runs(spark, path)


def _timed_events(spark, d):
    models = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.lit(k).alias("k")) for m, k in MODELS.items()]))
    return (
        read_table(spark, d, "events")
        .select("event_id", "event_type", "value", models.alias("m"))
        .where(F.col("m.k") % 5 == F.col("event_id") % 5)
        .select("event_id", "event_type", "value", "m.model")
    )


def _training_seconds(spark, d):
    errors = _timed_events(spark, d).where("event_type = 'error'")
    return errors.groupBy("model").agg(F.round(F.sum("value"), 4).alias("seconds"))


def _known_sizes(spark):
    return spark.createDataFrame([("rules", 77, 0.1)], "model string, parameters_total long, disk_size_mb double")


def _training_log(spark, d, runs):
    """Training times by run, for runs whose document lacks them."""
    return runs.select("run_id", "model").join(_training_seconds(spark, d), "model").select(
        "run_id", F.col("seconds").alias("train_runtime")
    )


@query(f"""WITH {_SQL_RUNS}
SELECT dataset, model, label, precision, recall, f1, support FROM t_cls""")
def nested_run_documents(spark, d):
    return rp.per_class_of_runs(_runs(spark, d))


@query(f"""WITH {_SQL_RUNS}
SELECT dataset, model, v.accuracy AS val_acc, v.macro_f1 AS val_macro_f1, t.accuracy AS test_acc, t.macro_f1 AS test_macro_f1,
  p50_ms AS inference_p50_ms, p95_ms AS inference_p95_ms, CASE WHEN model = 'rules' THEN 77 ELSE length(model) * 1000 END::BIGINT AS model_params,
  seconds AS training_time_sec, CASE WHEN model = 'rules' THEN 0.1 ELSE 2.5 END::DOUBLE AS size_mb
FROM t_avg t JOIN v_avg v USING (dataset, model) JOIN durations USING (model) JOIN training USING (model)""")
def run_summary_table(spark, d):
    runs = _runs(spark, d)
    return rp.run_summary(runs, _training_log(spark, d, runs), _known_sizes(spark))


@query(f"""WITH {_SQL_RUNS}
SELECT dataset, model, 'test_acc' AS metric, round(t.accuracy + 0.01, 4) AS cell, t.accuracy AS source FROM t_avg t WHERE model = 'rules'""")
def summary_cells_that_differ(spark, d):
    """One model's accuracy is changed in the summary; the check must name exactly it."""
    runs = _runs(spark, d)
    source = rp.run_summary(runs)
    changed = source.withColumn(
        "test_acc",
        F.when(F.col("model") == "rules", F.round(F.col("test_acc") + 0.01, 4)).otherwise(F.col("test_acc")),
    )
    return rp.cross_check(changed, source, ["dataset", "model"], ["val_acc", "val_macro_f1", "test_acc", "test_macro_f1"])


_SQL_WIDE = f"""{_SQL_RUNS},
cls AS (SELECT * FROM t_cls WHERE dataset = 'events' AND NOT (model = 'forest' AND label = 'refund')),
wide AS (SELECT label,
  {', '.join(f"max({c}) FILTER (WHERE model = '{m}') AS {m}_{c}" for m in MODELS for c in ('f1', 'precision', 'recall'))},
  coalesce(max(support) FILTER (WHERE model = 'linear'), max(support) FILTER (WHERE model = 'forest')) AS support,
  count(*) < 3 AS missing_somewhere FROM cls GROUP BY label)"""


@query(f"""WITH {_SQL_WIDE}
SELECT *, CASE greatest(forest_f1, linear_f1, rules_f1) WHEN forest_f1 THEN 'forest' WHEN linear_f1 THEN 'linear' ELSE 'rules' END AS best_model,
  round((greatest(forest_f1, linear_f1, rules_f1) - least(forest_f1, linear_f1, rules_f1)) * 100, 2) AS max_model_gap_pp
FROM wide ORDER BY linear_f1 NULLS LAST, label""")
def models_compared_per_class(spark, d):
    """The forest's document lacks one class, which must show as missing."""
    classes = rp.per_class_of_runs(_runs(spark, d)).where("dataset = 'events'")
    classes = classes.where("not (model = 'forest' and label = 'refund')")
    return rp.compare_models(classes, list(MODELS), ["linear", "forest"], "linear")


@query(f"""WITH {_SQL_RUNS},
runs AS (SELECT model || '_' || dataset AS run_id, t.accuracy AS acc, t.macro_f1 AS f1, p50_ms, p95_ms FROM t_avg t JOIN durations USING (model))
SELECT run_id, 'accuracy_in_range' AS gate, acc BETWEEN 0 AND 1 AS ok FROM runs
UNION ALL SELECT run_id, 'accuracy_not_perfect', acc <> 1 FROM runs
UNION ALL SELECT run_id, 'accuracy_above_floor', acc > 0.7 FROM runs
UNION ALL SELECT run_id, 'f1_close_to_accuracy', f1 <= acc + 0.05 FROM runs
UNION ALL SELECT run_id, 'p95_not_below_p50', p95_ms >= p50_ms FROM runs""")
def run_sanity_gates(spark, d):
    return rp.sanity_gates(_runs(spark, d), accuracy_floor=0.7)


@query(f"""WITH {_SQL_RUNS}
SELECT model || '_' || dataset AS run_id, macro_f1 AS val_macro_f1, macro_f1 >= 0.80 AS ship FROM v_avg""")
def ship_decisions(spark, d):
    return rp.ship_decision(_runs(spark, d))


@query(f"""WITH {SQL_PREDICTIONS},
hashed AS (
  SELECT dataset, model, sha256(length(row_id::VARCHAR) || ':' || row_id || '|' || length(text) || ':' || text || '|' || length(true_label) || ':' || true_label) AS h
  FROM predictions WHERE split = 'test'),
prints AS (
  SELECT dataset, model, sum(('0x' || substr(h, 1, 8))::BIGINT)::BIGINT || '-' || sum(('0x' || substr(h, 9, 8))::BIGINT)::BIGINT || '-' ||
    sum(('0x' || substr(h, 17, 8))::BIGINT)::BIGINT || '-' || sum(('0x' || substr(h, 25, 8))::BIGINT)::BIGINT AS p FROM hashed GROUP BY ALL)
SELECT dataset, count(*) AS n_runs, count(DISTINCT p) AS n_fingerprints, count(DISTINCT p) = 1 AS ok FROM prints GROUP BY 1""")
def fingerprints_of_runs_agree(spark, d):
    """Do the runs of a data set name the same test rows?  Each names the fingerprint of its own."""
    return rp.fingerprints_agree(_runs(spark, d))


@query(f"""WITH {SQL_PREDICTIONS},
first AS (SELECT row_id, true_label FROM predictions WHERE split = 'test' AND dataset = 'events' AND model = 'linear')
SELECT row_id, CASE WHEN row_id = (SELECT min(row_id) FROM first) THEN 'only_first' ELSE 'changed' END AS change
FROM first WHERE row_id IN ((SELECT min(row_id) FROM first), (SELECT max(row_id) FROM first))
UNION ALL SELECT -1, 'only_second'""")
def rows_that_differ_between_runs(spark, d):
    """Two runs' test rows, of which one is changed, one missing and one new: the trees of fingerprints lead to them."""
    first = event_predictions(spark, d).where("split = 'test'").select("row_id", "text", "true_label")
    ends = first.agg(F.min("row_id").alias("low"), F.max("row_id").alias("high")).first()
    new = F.when(F.col("row_id") == ends["high"], F.lit("view?")).otherwise(F.col("true_label"))
    second = first.where(F.col("row_id") != ends["low"]).withColumn("true_label", new)
    second = second.unionByName(spark.createDataFrame([(-1, "{}", "view")], "row_id long, text string, true_label string"))
    paths = [scratch_path(spark, "test-rows") for _ in range(2)]
    for rows, path in zip((first, second), paths):
        fp.write_fingerprinted(rows, ["row_id"], path)
    return fp.differing_rows(first, ["row_id"], *paths)


@query(f"""WITH {_SQL_RUNS},
runs AS (SELECT model || '_' || dataset AS run_id, model FROM t_avg),
fields(field) AS (VALUES ('run_id'), ('test_set_hash'), ('metrics'), ('latency'), ('resources'))
SELECT run_id, field, NOT (field = 'latency' AND model = 'forest') AS ok FROM runs, fields""")
def run_required_fields(spark, d):
    """The forest's documents state no latency."""
    runs = _runs(spark, d).withColumn("latency", F.when(F.col("model") != "forest", F.col("latency")))
    return rp.required_fields(runs, ["run_id", "test_set_hash", "metrics", "latency", "resources"])


@query(f"""WITH {_SQL_RUNS}
SELECT dataset, model, 'test_macro_f1' AS metric, round(t.macro_f1 - 0.1, 4) AS cell, t.macro_f1 AS source FROM t_avg t WHERE model = 'linear'
UNION ALL SELECT dataset, model, 'inference_p95_ms', p95_ms + 1, p95_ms FROM t_avg JOIN durations USING (model) WHERE model = 'rules'""")
def consolidated_differences(spark, d):
    """A summary in which two cells were changed, against what the documents state."""
    from gleanmark.plans.consolidation import consolidate

    runs = _runs(spark, d)
    of = lambda model, new, c: F.when(F.col("model") == model, new).otherwise(F.col(c)).alias(c)
    summary = rp.run_summary(runs)
    changed = summary.withColumns(
        {
            "test_macro_f1": of("linear", F.round(F.col("test_macro_f1") - 0.1, 4), "test_macro_f1"),
            "inference_p95_ms": of("rules", F.col("inference_p95_ms") + 1, "inference_p95_ms"),
        }
    )
    return consolidate(runs, list(MODELS), ["linear"], "linear", "orders", summary=changed).differences


@query(f"""WITH {_SQL_RUNS}
SELECT 'summary' AS part, count(*) AS n FROM t_avg
UNION ALL SELECT 'differences', 0 UNION ALL SELECT 'comparison', count(*) FROM t_cls WHERE dataset = 'orders' AND model = 'rules'
UNION ALL SELECT 'gates', 5 * count(*) FROM t_avg UNION ALL SELECT 'fingerprints', count(DISTINCT dataset) FROM t_avg""")
def consolidated_reports(spark, d):
    """Sizes of all consolidated reports; the cross-check must be empty."""
    from gleanmark.plans.consolidation import consolidate

    runs = _runs(spark, d)
    c = consolidate(
        runs, list(MODELS), ["linear", "forest"], "linear", "orders", _training_log(spark, d, runs), _known_sizes(spark)
    )
    parts = {"summary": c.summary, "differences": c.differences, "comparison": c.comparison, "gates": c.gates, "fingerprints": c.fingerprints}
    out = None
    for name, df in parts.items():
        part = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n")
        out = part if out is None else out.unionByName(part)
    return out

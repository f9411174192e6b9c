"""Run documents to the consolidated reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanmark.operators import report as rp
from gleanmark.operators.expectations import stop_unless_met

KEYS = ["dataset", "model"]
# Cells of the summary and where a run document states them.
CHECKED = {
    "val_acc": "metrics.intent_val.accuracy",
    "val_macro_f1": "metrics.intent_val.macro_f1",
    "test_acc": "metrics.intent.accuracy",
    "test_macro_f1": "metrics.intent.macro_f1",
    "inference_p50_ms": "latency.p50_ms",
    "inference_p95_ms": "latency.p95_ms",
}


@dataclass
class Consolidated:
    summary: DataFrame
    differences: DataFrame
    comparison: DataFrame
    gates: DataFrame
    fingerprints: DataFrame


def consolidate(
    runs: DataFrame,
    models: Sequence[str],
    support_from: Sequence[str],
    sort_by: str,
    dataset: str,
    training_log: DataFrame | None = None,
    known_sizes: DataFrame | None = None,
    drop_labels: Sequence[str] = ("PARSE_ERROR",),
    enforced: bool = False,
    summary: DataFrame | None = None,
) -> Consolidated:
    """Summary, cross-check against the documents, per-class comparison and gates.

    ``enforced`` stops the job when a run misses a required field or a gate, or when
    the runs of a data set name different test sets.  A ``summary`` given, such as one
    that was written before, is checked against the documents instead of a new one.
    """
    gates, agreed = rp.sanity_gates(runs), rp.fingerprints_agree(runs)
    if enforced:
        for checks in (rp.required_fields(runs), gates, agreed):
            stop_unless_met(checks)
    if summary is None:
        summary = rp.run_summary(runs, training_log, known_sizes)
    classes = rp.per_class_of_runs(runs, drop_labels).where(F.col("dataset") == dataset)
    return Consolidated(
        summary,
        rp.cross_check(summary, rp.document_cells(runs, CHECKED), KEYS, list(CHECKED)),
        rp.compare_models(classes, models, support_from, sort_by),
        gates,
        agreed,
    )

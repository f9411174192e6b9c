import random
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gleanmark.operators import audit as au
from gleanmark.operators.inject import DEFECT_FRACTIONS, inject_defects, injection_report
from gleanmark.plans import cleaning as cl

CAP, RESPONSE_CAP = 60, 90


def corpus(n=400):
    rng = random.Random(5)
    words = ["card", "lost", "it's", "où", "ﬁne", "pay  twice", "x\ty", "refund", "É"]
    out = []
    for i in range(n):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(1, 6)))
        out.append((i, text, rng.choice(["ORDER", "SHIP_TO"]), f"intent{rng.randrange(4)}", "it's " + text))
    return out


def raw(spark):
    return spark.createDataFrame(
        corpus(), "row_id long, instruction string, category string, intent string, response string"
    )


def injected(spark, n=3):
    fractions = {k: min(v * 4, 0.2) for k, v in DEFECT_FRACTIONS.items()}
    return inject_defects(
        raw(spark).repartition(n), "row_id", "instruction", "response", "category", "intent", fractions
    )


COLUMNS = ["row_id", "instruction", "category", "intent", "response"]


def step_by_step(data):
    """The pipeline in plain Python: rows in row order, one step after another."""
    log = []

    def done(step, before, after):
        log.append((step, before, after, before - after))

    rows = sorted(data)
    kept = [r for r in rows if r[3] is not None]
    done("drop_null_label", len(rows), len(kept))
    rows, seen, kept = kept, set(), []
    for r in rows:
        if (r[1], r[3]) not in seen:
            seen.add((r[1], r[3]))
            kept.append(r)
    done("dedup_text_label", len(rows), len(kept))
    clean = []
    for i, text, category, label, response in kept:
        response = " ".join(response.split())
        for a, b in [("â€™", "'"), ("â€œ", '"'), ("â€\x9d", '"'), ("Ã©", ""), ("ï»¿", "")]:
            response = response.replace(a, b)
        clean.append(
            (
                i,
                unicodedata.normalize("NFKC", " ".join(text.split())),
                category.upper(),
                label,
                unicodedata.normalize("NFKC", response),
            )
        )
    kept = [r for r in clean if len(r[1]) <= CAP and len(r[4]) <= RESPONSE_CAP]
    done("drop_length_outliers", len(clean), len(kept))
    rows, seen, kept = kept, set(), []
    for r in rows:
        if (r[1], r[3]) not in seen:
            seen.add((r[1], r[3]))
            kept.append(r)
    done("dedup_after_normalising", len(rows), len(kept))
    return kept, log


def test_hierarchical_cleaning_equals_step_by_step(spark):
    dirty = injected(spark).select(*COLUMNS)
    expected, log = step_by_step([tuple(r) for r in dirty.collect()])
    tagged = cl.tag_hierarchical(dirty, text_cap=CAP, response_cap=RESPONSE_CAP)
    got = [tuple(r) for r in tagged.where("failed_step is null").drop("failed_step").collect()]
    assert sorted(got) == sorted(expected)
    spark_log = cl.cleaning_log(tagged, cl.HIERARCHICAL_STEPS).orderBy("step_no").drop("step_no").collect()
    assert [tuple(r) for r in spark_log] == log
    assert all(dropped > 0 for *_, dropped in log)


def test_cleaning_again_changes_nothing(spark):
    once = cl.clean_hierarchical(injected(spark).select(*COLUMNS), text_cap=CAP, response_cap=RESPONSE_CAP, recollapse=True)
    tagged = cl.tag_hierarchical(once, text_cap=CAP, response_cap=RESPONSE_CAP, recollapse=True)
    assert tagged.where("failed_step is not null").count() == 0
    assert tagged.drop("failed_step").exceptAll(once).count() == 0


def test_audit_is_zero_after_cleaning(spark):
    counters = au.hierarchical_counters("instruction", "response", "category", "intent", COLUMNS[1:], CAP, RESPONSE_CAP)
    dirty = injected(spark).select(*COLUMNS)
    before = au.audit(dirty, counters).first().asDict()
    clean = cl.clean_hierarchical(dirty, text_cap=CAP, response_cap=RESPONSE_CAP)
    after = au.audit(clean, counters).first().asDict()
    assert all(v > 0 for k, v in before.items() if k != "response_over_cap")
    assert all(v == 0 for k, v in after.items() if k != "n_rows")
    gate = au.gate(au.audit(clean, counters), [c for c in counters if c != "n_rows"])
    assert gate.where("not ok").count() == 0


def test_injection_is_exact_and_independent_of_partitions(spark, rows):
    one, other = injected(spark, 1), injected(spark, 9)
    assert rows(one) == rows(other)
    fractions = {k: min(v * 4, 0.2) for k, v in DEFECT_FRACTIONS.items()}
    assert dict(rows(injection_report(one))) == {k: round(400 * f) for k, f in fractions.items()}
    assert one.count() == 400 + round(400 * fractions["duplicate"])
    assert one.select("row_id").distinct().count() == one.count()


def test_flat_cleaning(spark, rows):
    df = spark.createDataFrame(
        [(1, " a  b", "x", "train"), (2, "a b", "x", "train"), (3, "a b", "x", "test"), (4, " 　", "x", "train"),
         (5, None, "x", "train"), (6, "a b", "y", "train"), (7, "c", None, "train"), (8, "c", None, "train")],
        "row_id long, text string, label string, split string",
    )
    tagged = cl.tag_flat(df, split="split")
    kept = tagged.where("failed_step is null").select("row_id", "text")
    assert rows(kept) == [(1, "a b"), (3, "a b"), (6, "a b"), (7, "c")]
    log = cl.cleaning_log(tagged, cl.FLAT_STEPS, ["split"]).where("split = 'train'")
    assert rows(log.drop("split")) == [(1, "drop_empty_text", 7, 5, 2), (2, "dedup_text_label", 5, 3, 2)]


def test_hot_label_and_hot_text(spark):
    """Half of all rows are copies of one text."""
    df = spark.range(2000).selectExpr(
        "id as row_id", "if(id % 2 = 0, 'same  text', concat('t', id % 100)) as instruction",
        "'A' as category", "'l' as intent", "'r' as response",
    )
    steps = Counter(r["failed_step"] for r in cl.tag_hierarchical(df).collect())
    assert steps[None] == 51 and steps["dedup_text_label"] == 1949


def test_before_after_report(spark, rows):
    df = spark.createDataFrame([(" a", "x", "train"), ("b", "x", "test")], "text string, label string, split string")
    counters = {k: v for k, v in au.flat_counters("text", "label", ["text", "label"]).items() if k in ("n_rows", "edge_whitespace")}
    after = df.withColumn("text", F.trim("text"))
    report = au.before_after(au.audit(df, counters, ["split"]), au.audit(after, counters, ["split"]), list(counters), "split")
    assert report.columns == ["metric", "test_after", "test_before", "train_after", "train_before"]
    assert rows(report) == [("edge_whitespace", 0, 0, 0, 1), ("n_rows", 1, 1, 1, 1)]


def test_before_after_runs_each_audit_once(spark, rows):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    made = [(" a", "x", "train"), (None, "x", "test"), (" a", "x", "train"), ("b", None, None)]
    df = spark.createDataFrame(made, "text string, label string, split string").mapInPandas(
        counted, "text string, label string, split string"
    )
    counters = {k: v for k, v in au.flat_counters("text", "label", ["text", "label"]).items() if k in ("n_rows", "duplicate_text")}
    after = df.withColumn("text", F.trim("text"))
    report = au.before_after(au.audit(df, counters, ["split"]), au.audit(after, counters, ["split"]), list(counters), "split")
    assert report.columns == ["metric", "after", "before", "test_after", "test_before", "train_after", "train_before"]
    assert rows(report) == [("duplicate_text", 0, 0, 0, 0, 1, 1), ("n_rows", 1, 1, 1, 1, 2, 2)]
    assert seen.value == 8  # four rows before and four after


def test_cleaning_stops_on_a_label_under_two_categories(spark):
    rows = [(i, f"text {i}", f"r{i}", "A" if i % 2 else "B", f"l{i % 3}") for i in range(12)]
    crossed = spark.createDataFrame(rows, "row_id int, instruction string, response string, category string, intent string")
    nested = crossed.withColumn("intent", F.concat("category", "intent"))
    gate = cl.hierarchy_gate(cl.clean_hierarchical(crossed)).first()
    assert tuple(gate) == (3, 3, "l0", False)
    assert tuple(cl.hierarchy_gate(cl.clean_hierarchical(nested)).first()) == (6, 0, None, True)
    with pytest.raises(ValueError, match="first_violation"):
        cl.clean_hierarchical(crossed, enforced=True)
    assert cl.clean_hierarchical(nested, enforced=True).count() == 12

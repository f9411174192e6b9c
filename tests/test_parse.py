import random
import re
from difflib import SequenceMatcher, get_close_matches

import pytest
from pyspark.sql import functions as F

from gleanmark.operators import closest as cl
from gleanmark.operators import parse as ps

LABELS = ["card_arrival", "Refund_not_showing_up", "reverted_card_payment?", "lost_card", "top_up_failed", "exchange_rate"]
EDGES = [
    "Intent: card_arrival", "intent = lost_card", "Intent:CARD_ARRIVAL", "card_arrival", "lost_card is it",
    "card_arival", "Intent: top_up_faild", "zzz", "", "   ", "reverted_card_payment?", "Intent: reverted_card_payment?",
    "Refund_not_showing_up", "Category: order\nIntent: lost_card", "Intent : lost_card", "Intent: zzz lost_card",
    "???", "lost_card Intent: zzz", "Intent:\n\n exchange_rate",
]


def expected_path(text):
    """The same decisions, one answer at a time."""

    def near(c):
        found = get_close_matches(c, LABELS, n=1, cutoff=0.7)
        return found[0] if found else None

    anchored = re.search(r"[Ii]ntent\s*[:=]\s*([A-Za-z0-9_]+)", text)
    bare = re.search(r"[A-Za-z0-9_]+", text)
    a = anchored.group(1).lower() if anchored else None
    b = bare.group(0).lower() if bare else None
    if a in LABELS:
        return a, "regex"
    if a and near(a):
        return near(a), "fuzzy"
    if b in LABELS:
        return b, "bare"
    if b and near(b):
        return near(b), "fuzzy"
    return None, "none"


def frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, raw string")


def test_cascade_on_edges_and_random_typos(spark):
    rng = random.Random(6)
    typos = []
    for _ in range(300):
        s = list(rng.choice(LABELS))
        for _ in range(rng.randrange(4)):
            s[rng.randrange(len(s))] = rng.choice("abcxyz_")
        typos.append(rng.choice(["Intent: ", "", "intent=", "so: "]) + "".join(s))
    values = EDGES + typos
    parsed = ps.parse_answers(frame(spark, values), "raw", LABELS).orderBy("i").collect()
    for r, v in zip(parsed, values):
        label, path = expected_path(v)
        assert (r["pred_intent"], r["parse_path"], r["parse_error"]) == (label, path, label is None), v


def test_labels_with_capitals_only_resolve_fuzzily(spark):
    df = frame(spark, ["Intent: Refund_not_showing_up"])
    assert ps.parse_answers(df, "raw", LABELS).first()["parse_path"] == "fuzzy"
    folded = ps.parse_answers(df, "raw", LABELS, fold_case=True).first()
    assert (folded["pred_intent"], folded["parse_path"]) == ("Refund_not_showing_up", "regex")


def test_ties_go_to_the_greatest_label(spark):
    labels = spark.createDataFrame([("cat_a",), ("cat_b",)], "label string")
    assert cl.closest_labels(frame(spark, ["cat_c"]), "raw", labels).first()["label"] == "cat_b"


def test_null_answer_is_unparsable(spark):
    row = ps.parse_answers(frame(spark, [None]), "raw", LABELS).first()
    assert (row["pred_intent"], row["parse_error"], row["parse_path"]) == (None, True, "none")


def test_two_line_answers(spark):
    values = [
        "Category: ORDER\nIntent: lost_card", "category = REFUN\nintent = Top_up_failed", "Intent: lost_card",
        "Category: ORDER\nIntent: unknown_thing", "Category: order\nIntent: lost_card", "",
    ]
    got = ps.parse_two_line_answers(frame(spark, values), "raw", ["ORDER", "REFUND"], LABELS).orderBy("i")
    assert [tuple(r)[2:] for r in got.collect()] == [
        ("ORDER", "lost_card", False),
        ("REFUND", "top_up_failed", False),
        (None, "lost_card", True),
        ("ORDER", "unknown_thing", True),
        (None, "lost_card", True),
        (None, None, True),
    ]
    strict = ps.parse_two_line_answers(frame(spark, values), "raw", ["ORDER", "REFUND"], LABELS, keep_unmatched=False)
    assert strict.where("i = 3").first()["pred_intent"] is None


def test_path_counts_and_preflight(spark, rows):
    values = ["Intent: lost_card", "lost_card", "lost_crd", "zzz", "zzz"]
    parsed = ps.parse_answers(frame(spark, values), "raw", LABELS)
    assert rows(ps.path_counts(parsed)) == [("bare", 1, 0.2), ("fuzzy", 1, 0.2), ("none", 2, 0.4), ("regex", 1, 0.2)]
    assert ps.preflight(frame(spark, values), "raw", "i", LABELS).first()["ok"] is True
    assert ps.preflight(frame(spark, values), "raw", "i", LABELS, max_unparsed=1).first()["ok"] is False
    assert ps.preflight(frame(spark, values), "raw", "i", LABELS, n=2).first()["n_none"] == 0


def test_failed_preflight_stops_the_job(spark):
    from gleanmark.plans.evaluation import reparse_and_evaluate

    df = frame(spark, ["zzz"] * 3).withColumn("gold", F.lit("Intent: lost_card")).withColumn("text", F.lit("t"))
    with pytest.raises(ValueError, match="n_none"):
        reparse_and_evaluate(df, LABELS, "i", raw="raw", enforced=True)
    assert reparse_and_evaluate(df, LABELS, "i", raw="raw").rows.count() == 3


def test_search_sees_only_what_it_must(spark, monkeypatch):
    """What is a label itself is not searched, nor the bare token of an answer whose anchor gave a label."""
    asked, search = [], ps.closest_labels

    def spy(values, column, *args):
        asked.append(sorted(r[0] for r in values.select(column).collect()))
        return search(values, column, *args)

    monkeypatch.setattr(ps, "closest_labels", spy)
    values = ["Intent: lost_card", "intent: lost_crd", "so: lost_card", "xxx", None]
    got = ps.parse_answers(frame(spark, values), "raw", LABELS).orderBy("i").collect()
    assert [r["parse_path"] for r in got] == ["regex", "fuzzy", "none", "none", "none"]
    assert asked == [["lost_crd"], ["so", "xxx"]]


def _names(rng, n):
    return sorted({"".join(rng.choice("abcdeé_") for _ in range(rng.randrange(1, 16))) for _ in range(n)})


@pytest.mark.parametrize("salt_rows", [100_000, 7])
def test_closest_of_two_thousand_labels(spark, salt_rows):
    """As the library decides one by one, ties to the greatest label."""
    rng = random.Random(11)
    labels = _names(rng, 2100)[:2000]
    asked = ["", "a", "é" * 40, "🙂a", "zzzz"] + [x[:-1] + rng.choice("abxyé") for x in rng.sample(labels, 60)] + ["".join(rng.sample(x, len(x))) for x in rng.sample(labels, 20)]
    table = spark.createDataFrame([(x,) for x in [*labels, None, ""]], "label string")
    found = cl.closest_labels(frame(spark, [*asked, None, *asked]), "raw", table, salt_rows=salt_rows)
    got = {r["candidate"]: (r["label"], r["ratio"]) for r in found.collect()}
    want = {x: get_close_matches(x, labels, n=1, cutoff=0.7) for x in asked}
    assert {x: y[0] for x, y in got.items()} == {x: y[0] for x, y in want.items() if y} and len(got) > 60
    assert all(r == SequenceMatcher(None, label, x).ratio() for x, (label, r) in got.items())


def test_letters_prune_pairs_before_the_search(spark):
    rng = random.Random(3)
    names = lambda n: spark.createDataFrame([("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(12)),) for _ in range(n)], "name string").distinct()
    labels, asked = names(1500), names(200)
    assert cl.comparable_pairs(asked, labels).count() < 0.05 * 1500 * 200


def test_labels_stay_out_of_the_plan(spark, tmp_path):
    path = str(tmp_path / "labels")
    spark.createDataFrame([(x,) for x in LABELS], "label string").write.parquet(path)
    df = frame(spark, EDGES)
    for parsed in (
        ps.parse_answers(df, "raw", spark.read.parquet(path), fold_case=True),
        ps.parse_two_line_answers(df, "raw", spark.read.parquet(path), spark.read.parquet(path)),
    ):
        text = parsed._jdf.queryExecution().toString()
        assert not any(x in text.replace(path, "") for x in LABELS) and "Python" not in text


def test_columns_named_like_the_values(spark):
    df = frame(spark, ["Category: ORDER\nIntent: lost_card"]).selectExpr("*", "'x' as category", "'y' as intent", "'z' as label")
    one = ps.parse_answers(df, "raw", LABELS)
    assert tuple(one.first()) == (0, "Category: ORDER\nIntent: lost_card", "x", "y", "z", "lost_card", False, "regex")
    two = ps.parse_two_line_answers(df, "raw", ["ORDER"], LABELS)
    assert tuple(two.first())[5:] == ("ORDER", "lost_card", False)

import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleanmark.functions import labels as lb
from gleanmark.functions import text as tx
from gleanmark.functions.keys import content_key

WS_EDGES = [
    "", " ", "  a  b ", "\ta\tb\t", "\na\n\nb", "a\x1cb\x1db\x1eb\x1fb", "a\x85b", " a ",
    " a b　", "​a﻿", "a", "a b", "\r\n", "x   y  ", "\x0ba\x0c", " z",
]
UNICODE_EDGES = ["ﬁ", "①", "ｆｕｌｌ", "é", "a´b", "£5", "€ 7", "plain", "", None, "Å", "㎏"]
MOJIBAKE_EDGES = ["itâ€™s", "â€œq", "â€\x9d", "Ã©t", "ï»¿x", "Â£", "Ã", "Ã\n", "é", "Ã ", None]


def column(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")


def evaluate(spark, values, expr):
    return [r[0] for r in column(spark, values).select("i", expr.alias("x")).orderBy("i").select("x").collect()]


def test_collapse_matches_split_and_join(spark):
    assert evaluate(spark, WS_EDGES, tx.collapse_whitespace("s")) == [" ".join(s.split()) for s in WS_EDGES]


def test_every_code_point_below_0x3100(spark):
    values = [f"a{chr(c)}{chr(c)}b" for c in range(0x3100)]
    assert evaluate(spark, values, tx.collapse_whitespace("s")) == [" ".join(s.split()) for s in values]
    assert evaluate(spark, values, tx.word_count("s")) == [len(s.split()) for s in values]


@pytest.mark.parametrize(
    "expr,plain",
    [
        (tx.word_count, lambda s: len(s.split())),
        (tx.is_blank, lambda s: s.strip() == ""),
        (tx.has_leading_whitespace, lambda s: s != s.lstrip()),
        (tx.has_trailing_whitespace, lambda s: s != s.rstrip()),
        (tx.has_edge_whitespace, lambda s: s != s.strip()),
        (tx.has_multi_space, lambda s: "  " in s),
        (tx.has_tab, lambda s: "\t" in s),
        (tx.has_newline, lambda s: "\n" in s),
        (tx.has_non_ascii, lambda s: not s.isascii()),
    ],
)
def test_flags_match_python(spark, expr, plain):
    assert evaluate(spark, WS_EDGES, expr("s")) == [plain(s) for s in WS_EDGES]


def test_nfkc_matches_unicodedata(spark):
    expected = [None if s is None else unicodedata.normalize("NFKC", s) for s in UNICODE_EDGES]
    assert evaluate(spark, UNICODE_EDGES, tx.nfkc("s")) == expected


def test_mojibake_detection_is_wider_than_repair(spark):
    import re

    pattern = re.compile("(?:Ã.|â€.|Â.|ï»¿)")
    values = [v for v in MOJIBAKE_EDGES if v is not None]
    assert evaluate(spark, values, tx.has_mojibake("s")) == [bool(pattern.search(v)) for v in values]
    repaired = evaluate(spark, MOJIBAKE_EDGES, tx.repair_mojibake("s"))
    assert repaired == ["it's", '"q', '"', "t", "x", "Â£", "Ã", "Ã\n", "é", "Ã ", None]


def test_title_case_per_word(spark):
    values = ["SHIPPING_ADDRESS", "account", "Account", "A", ""]
    assert evaluate(spark, values, tx.title_label("s")) == [v.title() for v in values]


def test_irregular_labels(spark):
    values = ["Refund_not_showing_up", "reverted_card_payment?", "card_arrival", "top 9", "___"]
    assert evaluate(spark, values, lb.is_irregular_label("s")) == [True, False, False, True, True]


def test_label_tokens(spark):
    assert evaluate(spark, ["Lost_card__card?"], F.array_sort(lb.label_tokens("s"))) == [["card", "lost"]]


def test_keys_keep_neighbours_and_nulls_apart(spark):
    df = spark.createDataFrame(
        [("ab", "c"), ("a", "bc"), (None, "a"), ("a", None), (None, None), ("", None), ("null", "a"), ("1:a|", "b")],
        "a string, b string",
    )
    assert df.select(content_key("a", "b").alias("k")).distinct().count() == 8
    same = spark.createDataFrame([(None, "a"), (None, "a")], "a string, b string")
    assert same.select(content_key("a", "b").alias("k")).distinct().count() == 1


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(blacklist_categories=["Cs"], blacklist_characters="\x00")), min_size=1, max_size=20))
def test_any_text(spark, values):
    assert evaluate(spark, values, tx.collapse_whitespace("s")) == [" ".join(s.split()) for s in values]
    assert evaluate(spark, values, tx.word_count("s")) == [len(s.split()) for s in values]
    assert evaluate(spark, values, tx.nfkc("s")) == [unicodedata.normalize("NFKC", s) for s in values]


def test_nfkc_of_batches_longer_than_a_slice(spark, monkeypatch):
    """Python holds a few values of a batch as strings, nulls stay, order stays."""
    import pyarrow as pa

    values = [(i, None if i % 7 == 0 else f"ﬁ{i}é" if i % 3 else f"a{i}") for i in range(500)]
    got = dict(spark.createDataFrame(values, "i int, t string").coalesce(1).select("i", tx.nfkc("t")).collect())
    assert got == {i: None if t is None else t.replace("ﬁ", "fi") for i, t in values}
    sizes = []
    run = tx._nfkc.func
    seen = type("Seen", (), {"null_count": 0, "type": pa.string(), "__len__": lambda s: 500})()
    seen.slice = lambda i, n: sizes.append(n) or pa.array([t for _, t in values[i : i + n]])
    assert run(seen).to_pylist() == [got[i] for i in range(500)] and max(sizes) <= 64

"""A profile from cells: every figure beside a plain count, and how often tables are read."""

from collections import Counter

from pyspark.sql.readwriter import DataFrameWriter

from gleanmark.operators import profile as pf
from gleanmark.plans import profiling as pl

ROWS = [
    (1, "a  b", "x", "P", "AB"), (2, "a  b", "x", "Q", ""), (3, None, "y", "P", None), (4, " tab\t", None, None, "B"),
    (5, "", "y", "P", "AB"), (6, "été\n", "x", None, "C "), (7, "a  b", "x", "P", "AB"),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "id int, t string, l string, p string, g string")


def test_facts(spark):
    facts = {r["fact"]: r["value"] for r in pl.profile_facts(pl.profile_cells(frame(spark), "t", "l", "p", "g")).collect()}
    want = {
        "n_rows": 7, "duplicate_rows": 0, "duplicate_text": 2, "duplicate_text_label": 2, "null.t": 1, "null.id": 0, "null.(any)": 3,
        "flag.blank_text": 2, "flag.has_tab": 1, "flag.has_newline": 1, "flag.multi_space": 3, "flag.non_ascii": 1, "flag.mojibake": 0,
        "flag.very_long": 0, "classes.n_classes": 2, "classes.max": 4, "classes.ratio": 2, "classes.n_too_small": 2, "label.x": 4,
        "label.x.fraction": 0.666667, "class.x|P": 2, "class.x|Q": 1, "class.x": 1, "parents.x": 2, "parents.y": 1, "chars.count": 7,
        "chars.min": 0, "chars.max": 5, "words.max": 2, "tags.n_distinct": 4, "tags.n_empty": 2, "tags.AB": 3, "letter.A": 3, "letter.B": 4, "letter.C": 1,
    }
    assert {k: facts[k] for k in want} == want
    assert sum(v for k, v in facts.items() if k.startswith("chars.bin") and not k.endswith("fraction")) == 7


def test_tables_equal_the_single_operators(spark, rows):
    df, p = frame(spark), pl.profile(frame(spark), "t", "l", "p", "g")
    assert rows(p.classes) == rows(pf.class_counts(df, "l")) and rows(p.fractions) == rows(pf.class_fractions(df, "l"))
    assert rows(p.imbalance) == rows(pf.imbalance(df, "l")) and rows(p.class_stats) == rows(pf.class_count_stats(df, "l"))
    assert rows(p.feasibility) == rows(pf.split_feasibility(df, "l"))
    assert rows(p.lengths) == rows(pf.length_profile(df, pf.text_lengths("t")))
    assert rows(p.histogram) == rows(pf.fixed_bin_histogram(df, pf.text_lengths("t"), pl.BINS))
    assert rows(p.letters) == rows(pf.tag_letters(df, "g"))
    assert rows(p.crosstab) == sorted(((*k, n) for k, n in Counter((r[2], r[3]) for r in ROWS if r[2]).items()), key=repr)
    assert dict(rows(p.audit))["duplicate_text"] == 2 and dict(rows(p.audit))["null_text"] == 1


def test_an_empty_corpus_has_zeros(spark):
    facts = {r["fact"]: r["value"] for r in pl.profile_facts(pl.profile_cells(frame(spark, []), "t", "l")).collect()}
    assert facts["n_rows"] == 0 and facts["null.t"] == 0 and facts["flag.mojibake"] == 0


def test_the_corpus_is_read_once_and_its_cells_twice(spark, tmp_path, monkeypatch):
    path, plans, write = str(tmp_path / "t"), [], DataFrameWriter.parquet
    frame(spark).write.parquet(path)

    def parquet(self, place, *args, **kwargs):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, place, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    facts = pl.profile_facts(pl.profile_cells(spark.read.parquet(path), "t", "l", "p", "g"))
    last = facts._jdf.queryExecution().executedPlan().toString()
    assert sum(p.count("FileScan") for p in plans) == 1 and last.count("FileScan") == 2
    assert "partial_sum" in plans[0]  # equal cells are counted before they move

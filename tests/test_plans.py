"""What the optimiser is left with: pruned scans, no skewed shuffles, shared limits."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from gleanmark import catalog
from gleanmark.operators import evaluate as ev
from gleanmark.operators import profile as pf
from gleanmark.operators.dedup import keep_first
from gleanmark.operators.leakage import drop_leakage
from gleanmark.operators.split import stratified_split
from gleanmark.plans.cleaning import HIERARCHICAL_STEPS, cleaning_log, tag_hierarchical
from gleanmark.plans.splitting import THREE_WAY, split_and_check

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def written(monkeypatch):
    """``(columns, plan)`` of every table that is written, staged ones included."""
    seen, write = [], DataFrameWriter.parquet

    def parquet(self, path, *args, **kwargs):
        seen.append((self._df.columns, plan(self._df)))
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    return seen


def table(spark, tmp_path, n=2000):
    path = str(tmp_path / "t")
    spark.range(n).selectExpr(
        "id as row_id", "concat('text ', id) as text", "concat('r', id) as response", "'C' as category",
        "concat('l', id % 3) as label", "if(id % 4 = 0, 'test', 'train') as split", "repeat('x', 50) as unused",
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_dedup_broadcasts_its_small_lookup(spark, tmp_path):
    p = plan(keep_first(table(spark, tmp_path), ["text", "label"], "row_id"))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p and "hashpartitioning" not in p


def test_cleaning_moves_no_rows_and_normalises_once(spark, tmp_path, written):
    df = table(spark, tmp_path).drop("split", "unused")
    written.clear()
    p = plan(tag_hierarchical(df, text="text", label="label"))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p and "hashpartitioning" not in p
    everything = "".join([p, *[w for _, w in written]])
    assert everything.count("regexp_replace(text") == 1  # collapsed once although referred to often
    assert everything.count("ArrowEvalPython") == 1


def test_cleaning_log_reads_no_text_again(spark, tmp_path, written):
    df = table(spark, tmp_path).drop("split", "unused")
    written.clear()
    p = plan(cleaning_log(tag_hierarchical(df, text="text", label="label"), HIERARCHICAL_STEPS))
    assert "text:string" not in p and "ArrowEvalPython" not in p


def test_audit_of_a_cleaned_corpus_moves_no_text(spark, tmp_path, written):
    """Also where the fates of the keys are too many to broadcast."""
    from gleanmark.operators import audit as au
    from gleanmark.plans.cleaning import clean_hierarchical

    columns = ("text", "response", "category", "label", ["text", "label", "category", "response"])
    df = table(spark, tmp_path).drop("split", "unused").withColumn("text", F.expr("if(row_id % 4 = 1, 'a  b', text)"))
    copies = df.where("row_id < 300").withColumns({"row_id": F.col("row_id") + 2000, "category": F.lit("c")})
    df.unionByName(copies).write.parquet(str(tmp_path / "copied"))
    df = spark.read.parquet(str(tmp_path / "copied"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plain = clean_hierarchical(df, text="text", label="label")
        written.clear()
        cleaned = clean_hierarchical(df, text="text", label="label", facts=au.hierarchical_facts(*columns))
        report = au.audit(cleaned, au.hierarchical_counters(*columns, measured=True))
        p = plan(report)
        assert "SortMergeJoin" in p and "text:string" not in p and "response:string" not in p
        assert not any("text" in c for c, w in written if "normalised" in w)  # read again for keys alone
        assert "".join(w for _, w in written).count("ArrowEvalPython") == 1
        assert report.first() == au.audit(plain, au.hierarchical_counters(*columns)).first()
        assert cleaned.select(*plain.columns).exceptAll(plain).isEmpty() and cleaned.count() == plain.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_split_of_a_cleaned_corpus_normalises_once(spark, written):
    p = plan(catalog.load()["clean_split_sizes"].run(spark, SF_DIR))
    plans = [p, *[w for _, w in written]]
    assert "".join(plans).count("ArrowEvalPython") == 1
    assert sum("text:string" in w for w in plans) == 1


def test_checked_split_writes_no_text_again(spark, tmp_path, written):
    df = table(spark, tmp_path)
    written.clear()
    split_and_check(df, "text", "label", "row_id").checks.collect()
    assert written and not any("text" in columns for columns, _ in written)


def test_leakage_moves_no_rows(spark, tmp_path):
    p = plan(drop_leakage(table(spark, tmp_path), ["text", "label"], "split", ("test", "train")))
    assert "hashpartitioning" not in p


def test_split_moves_no_rows_and_sorts_no_class(spark, tmp_path):
    p = plan(stratified_split(table(spark, tmp_path), "label", "row_id", THREE_WAY))
    assert "hashpartitioning" not in p and "Window" not in p


def test_scans_are_pruned(spark, tmp_path):
    p = plan(pf.class_counts(table(spark, tmp_path), "label"))
    assert "ReadSchema: struct<label:string>" in p and "PushedFilters: [IsNotNull(label)]" in p


def test_warm_up_limit_is_applied_before_the_shuffle(spark, tmp_path):
    df = table(spark, tmp_path).withColumn("ms", F.col("row_id").cast("double"))
    p = plan(ev.duration_summary(df, "ms", "row_id", 5, 20, ["label"]))
    assert p.count("WindowGroupLimit") == 2 and "Partial" in p


def test_first_rows_per_split_are_limited_before_the_shuffle(spark, tmp_path):
    p = plan(pf.first_per_split(table(spark, tmp_path), "split", "row_id", 5))
    assert p.count("WindowGroupLimit") == 2


def test_one_audit_is_one_scan(spark, tmp_path):
    from gleanmark.operators.audit import audit, flat_counters

    df = table(spark, tmp_path)
    counters = flat_counters("text", "label", ["row_id", "text", "label"])
    p = plan(audit(df, counters, ["split"]))
    assert p.count("FileScan") == 1 and "unused" not in p


def test_python_runs_once_per_row(spark, tmp_path, written):
    """A filter above a Python step must not copy the step into itself."""
    from gleanmark.operators.parse import parse_answers
    from gleanmark.plans.cleaning import clean_flat, drop_empty, normalise_columns

    df = table(spark, tmp_path)
    parsed = parse_answers(df, "text", ["abc"]).where("pred_intent is null and parse_path = 'none'")
    assert "ArrowEvalPython" not in plan(parsed)  # the search is over before the rows are joined
    assert plan(normalise_columns(drop_empty(df, "text"), ["text"])).count("ArrowEvalPython") == 1
    written.clear()
    cleaned = plan(clean_flat(df, split="split"))
    assert "".join([cleaned, *[w for _, w in written]]).count("ArrowEvalPython") == 1


def test_copies_are_settled_with_one_shuffle(spark, tmp_path, written):
    """After the table of keys is written, neither rows nor reports are dealt out by key again."""
    from gleanmark.plans.splitting import settle_copies

    df = table(spark, tmp_path)
    written.clear()
    done = settle_copies(df, ["text", "label"], "row_id")
    assert [p.count("hashpartitioning") for _, p in written] == [1, 0]
    assert "partial_count" in written[0][1] and "text" not in written[0][0]
    for part in (done.rows, done.log, done.overlap_before):
        assert "hashpartitioning" not in plan(part)
    assert "FileScan" in plan(done.log) and "text" not in plan(done.log)

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gleanmark import schemas
from gleanmark.operators import expectations as ex
from gleanmark.operators import instruct as ins
from gleanmark.operators import labelspace as ls
from gleanmark.plans.export import export_instructions
from gleanmark.session import stage, vocabulary
from gleanmark.sources import csvfiles, jsonl, tables
from gleanmark.sources import runs as rn

NASTY = ['say "hi"', "a,b", "two\nlines", " lead and trail ", "", None, "ünï €", "tab\there", "back\\slash", '"', "\\\"x"]


def test_json_lines_round_trip(spark, tmp_path, rows):
    df = spark.createDataFrame([(i, v or "x", "l") for i, v in enumerate(NASTY)], "i int, text string, label string")
    path = str(tmp_path / "out")
    jsonl.write_json_lines(df.select(ins.flat_record("text", "label").alias("r")), "r", path)
    back = jsonl.read_instructions(spark, path)
    assert sorted(r["input"] for r in back.collect()) == sorted(v or "x" for v in NASTY)
    assert jsonl.check_json_lines(spark, path).count() == 0
    text = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "out").glob("part-*"))
    assert "ünï €" in text


def test_blank_lines_and_missing_input(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text('{"instruction":"a","output":"b"}\n\n   \n{"instruction":"c","input":"i","output":"d"}\n')
    got = [tuple(r) for r in jsonl.read_instructions(spark, str(path)).orderBy("instruction").collect()]
    assert got == [("a", "", "b"), ("c", "i", "d")]
    first = jsonl.read_instructions(spark, str(path), limit=1).collect()
    assert first == jsonl.read_instructions(spark, str(path)).limit(1).collect()


def test_required_keys_and_broken_lines_fail(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"instruction":"a"}\n')
    with pytest.raises(Exception, match="instruction line without 'output'"):
        jsonl.read_instructions(spark, str(tmp_path / "a.jsonl")).collect()
    (tmp_path / "b.jsonl").write_text('{"instruction":"a","output":"b"}\n{"instruction":\n')
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        jsonl.read_instructions(spark, str(tmp_path / "b.jsonl")).collect()


def test_line_numbers_across_file_blocks(spark, tmp_path):
    good = json.dumps({"instruction": "a", "input": "x" * 100, "output": "b"})
    lines = [good] * 4000
    bad = [1, 17, 2345, 4000]
    for n in bad:
        lines[n - 1] = lines[n - 1][:-3] + str(n)
    (tmp_path / "one.jsonl").write_text("\n".join(lines) + "\n")
    (tmp_path / "two.jsonl").write_text(good + "\nnot json\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        found = jsonl.check_json_lines(spark, str(tmp_path)).select("file", "line_number").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(tuple(r) for r in found) == [("one.jsonl", n) for n in bad] + [("two.jsonl", 2)]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [(v, "a", "b", 0.5, 3) for v in NASTY], schemas.ERROR_ROW
    )
    path = str(tmp_path / "errors")
    csvfiles.write_table(df, path)
    back = csvfiles.read_table(spark, path, schemas.ERROR_ROW)
    assert sorted(((r["text"], r["confidence"], r["text_length"]) for r in back.collect()), key=repr) == sorted(
        ((v, 0.5, 3) for v in NASTY), key=repr
    )


def test_splits_on_disk(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "train"), (2, "val"), (3, "train")], "id long, split string")
    path = str(tmp_path / "splits")
    tables.write_splits(df, path)
    assert (tmp_path / "splits" / "split=val").is_dir()
    assert rows(tables.read_splits(spark, path, "id long")) == [(1, "train"), (2, "val"), (3, "train")]
    assert tables.verify_written(df, path).first()["ok"] is True
    assert tables.verify_written(df.limit(2), path).first()["ok"] is False
    assert tables.verify_written(df.withColumn("x", F.lit(1)), path).first()["same_schema"] is False
    plan = tables.read_splits(spark, path, "id long").where("split = 'val'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_report_sections_are_replaced_alone(spark, tmp_path, rows):
    path = str(tmp_path / "report")

    def report(v):
        return spark.createDataFrame([("d", "train", "n", float(v))], "dataset string, split string, metric string, value double")

    rn.write_report(report(1), path, "eda")
    rn.write_report(report(2), path, "cleaning")
    rn.write_report(report(3), path, "eda")
    back = rn.read_report(spark, path)
    assert rows(back.select("section", "value")) == [("cleaning", 2.0), ("eda", 3.0)]
    docs = {r[0]: json.loads(r[1]) for r in rn.report_as_json(back).collect()}
    assert json.loads(docs["eda"]["d/train"]) == {"n": 3.0}


def test_mixed_training_log(spark, tmp_path):
    path = tmp_path / "log.jsonl"
    path.write_text('{"step":1,"loss":0.5}\n{"step":2,"eval_loss":0.4}\n{"step":3,"train_runtime":9.5}\n')
    got = jsonl.read_training_log(spark, str(path)).orderBy("step").select("loss", "eval_loss", "train_runtime").collect()
    assert [tuple(r) for r in got] == [(0.5, None, None), (None, 0.4, None), (None, None, 9.5)]


def test_export_with_limit(spark, tmp_path, rows):
    df = spark.range(30).selectExpr("id", "concat('t', id) as text", "'l' as label", "if(id < 20, 'train', 'val') as split")
    result = export_instructions(
        df, ins.flat_record("text", "label"), str(tmp_path / "x"), ["train", "val", "test"], limit=5, row_id="id"
    )
    assert rows(result.counts) == [("test", 0), ("train", 5), ("val", 5)]
    assert result.bad_lines.count() == 0


def test_load_split_needs_columns_and_order(spark):
    df = spark.createDataFrame([(2, "b", 1), (1, "a", 0)], "id long, text string, label int")
    assert [tuple(r) for r in tables.load_split(df, "text", "label", "id", limit=1).collect()] == [(1, "a", "0")]
    with pytest.raises(ValueError):
        tables.load_split(df, "text", "missing")
    with pytest.raises(ValueError):
        tables.load_split(df, "text", "label", limit=1)


def test_label_column_resolution(spark):
    names = spark.createDataFrame([(0, "zero"), (1, "one")], schemas.LABEL_DICTIONARY)
    ints = spark.createDataFrame([(1,)], "label int")
    assert ls.resolve_label(ints, names).first()["resolved_label"] == "one"
    both = spark.createDataFrame([(1, "named")], "label int, label_name string")
    assert ls.resolve_label(both).first()["resolved_label"] == "named"
    with pytest.raises(ValueError):
        ls.resolve_label(ints)
    with pytest.raises(ValueError):
        ls.resolve_label(spark.range(1))


def test_label_space_rejects_unknown_labels(spark):
    space = ls.label_space(spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "l string"), "l")
    assert [tuple(r) for r in space.orderBy("label_id").collect()] == [("a", 0), ("b", 1)]
    with pytest.raises(PySparkException):
        ls.encode(spark.createDataFrame([("c",)], "l string"), space, "l").collect()


def test_published_label_similarities(spark):
    names = [
        "card_not_working", "virtual_card_not_working", "lost_or_stolen_card", "lost_or_stolen_phone",
        "top_up_by_bank_transfer_charge", "top_up_by_card_charge", "automatic_top_up", "pending_top_up",
    ]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    top = [tuple(r) for r in ls.similar_labels(df, "n", 4).collect()]
    assert top == [
        ("card_not_working", "virtual_card_not_working", 0.75),
        ("lost_or_stolen_card", "lost_or_stolen_phone", 0.6),
        ("top_up_by_bank_transfer_charge", "top_up_by_card_charge", 0.5714),
        ("automatic_top_up", "pending_top_up", 0.5),
    ]


def test_vocabulary_is_bounded(spark):
    df = spark.range(11).selectExpr("cast(id as string) as l")
    assert len(vocabulary(df, "l", 11)) == 11
    with pytest.raises(ValueError):
        vocabulary(df, "l", 10)


def test_expectations(spark, rows):
    df = spark.range(5)
    checks = ex.expectations(df, {"n": (F.count("*"), 5), "m": (F.max("id"), 9)})
    assert rows(checks) == [("m", 4, 9, False), ("n", 5, 5, True)]
    with pytest.raises(PySparkException):
        ex.enforce(checks).collect()
    assert ex.enforce(checks.where("ok")).count() == 1


def test_stage_keeps_schema(spark):
    df = spark.createDataFrame([(1, [("a", 2.0)], None)], "i long, l array<struct<x:string,y:double>>, n string")
    again = stage(df, "test")
    assert again.collect() == df.collect() and [f.dataType for f in again.schema] == [f.dataType for f in df.schema]


def test_chat_rendering(spark):
    df = spark.createDataFrame([("hello", "Intent: x")], "t string, a string")
    train = df.select(ins.render_chat(ins.chat_messages("t", "a", "S", "U: "))).first()[0]
    ask = df.select(ins.render_chat(ins.chat_messages("t", None, "S", "U: "), for_generation=True)).first()[0]
    assert train == "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\nU: hello<|im_end|>\n<|im_start|>assistant\nIntent: x<|im_end|>\n"
    assert ask == "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\nU: hello<|im_end|>\n<|im_start|>assistant\n"
    other = df.select(ins.render_chat(ins.chat_messages("t", None, "S", ""), template="[{role}] {content};")).first()[0]
    assert other == "[system] S;[user] hello;"


def test_hierarchical_record(spark):
    df = spark.createDataFrame([("t", "order", "Cancel_Order")], "t string, c string, l string")
    record = df.select(ins.hierarchical_record("t", "c", "l").alias("r")).first()["r"]
    assert record["output"] == "Category: ORDER\nIntent: cancel_order" and record["input"] == "t"


def test_a_failed_write_leaves_the_old_section_readable(spark, tmp_path, rows):
    path = str(tmp_path / "report")
    old = spark.createDataFrame([("d", "train", "n", 1.0)], "dataset string, split string, metric string, value double")
    rn.write_report(old, path, "eda")
    half = spark.range(0, 4, 1, 4).selectExpr(
        "'d' as dataset", "'train' as split", "'n' as metric", "if(id = 3, cast(raise_error('disk full') as double), 2.0D) as value"
    )
    with pytest.raises(Exception, match="disk full"):
        rn.write_report(half, path, "eda")
    assert rows(rn.read_report(spark, path)) == [("d", "train", "n", 1.0, "eda")]
    rn.write_report(old.withColumn("value", F.lit(5.0)), path, "eda")
    assert rows(rn.read_report(spark, path)) == [("d", "train", "n", 5.0, "eda")]


def test_documents_of_unknown_shape(spark, tmp_path, rows):
    from gleanmark.sources import variants as vr

    lines = ['{"a": 1, "b": {"c": "x"}}', '{"a": "one", "new": [1, 2]}', "", "no json", '{"b": {"c": 3}}', "7", "null"]
    (tmp_path / "log.jsonl").write_text("\n".join(lines) + "\n")
    log = vr.read_lines(spark, str(tmp_path / "log.jsonl"))
    assert log.count() == 6 and log.where("doc is null").count() == 1
    assert rows(vr.keys_found(log)) == sorted(
        [("a", "BIGINT", 1), ("a", "STRING", 1), ("b", "OBJECT<c: STRING>", 1), ("b", "OBJECT<c: BIGINT>", 1), ("new", "ARRAY<BIGINT>", 1)], key=repr
    )
    got = vr.extracted(log, {"a": ("$.a", "bigint"), "c": ("$.b.c", "string"), "last": ("$.new[1]", "int")})
    assert got.columns == ["file", "a", "c", "last"]
    assert rows(got.drop("file")) == sorted([(1, "x", None), (None, None, 2), (None, None, None), (None, "3", None), (None, None, None), (None, None, None)], key=repr)
    assert "new" in vr.schema_found(log.where("doc is not null and not is_variant_null(doc)").where("schema_of_variant(doc) like 'OBJECT%'")).first()[0]
    one = vr.read_documents(spark, str(tmp_path / "log.jsonl"))
    assert one.count() == 1


def test_an_export_stops_before_writing_when_the_anchor_is_missing(spark, tmp_path):
    from gleanmark.operators import instruct as ins

    df = spark.createDataFrame([(1, "a", "x", "train"), (2, "b", "y", "train")], "id int, text string, label string, split string")
    record = ins.flat_record("text", "label")
    path = tmp_path / "out"
    rendered = F.concat(F.lit("<|assistant|>"), F.when(F.col("id") == 1, "ok").otherwise("no"))
    with pytest.raises(ValueError, match="n_missing"):
        export_instructions(df, record, str(path), ["train"], row_id="id", rendered=rendered, anchor="ok")
    assert not path.exists()
    done = export_instructions(df, record, str(path), ["train"], row_id="id", rendered=rendered, anchor="<|assistant|>")
    assert [tuple(r) for r in done.counts.collect()] == [("train", 2)]


def test_presence_of_columns(spark, rows):
    assert rows(ex.column_presence(spark.range(1), ["id", "x"])) == [("id", True), ("x", False)]

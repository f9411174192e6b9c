"""Scans, sinks, instruction records, and files written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanmark.catalog.inputs import (
    documents,
    SQL_EVENT_PREDICTIONS,
    SQL_INJECTED,
    SQL_SPLIT_DOCUMENTS,
    digit,
    dirty,
    event_predictions,
    split_documents,
    sql_digit,
)
from gleanmark.catalog.registry import query
from gleanmark.operators import expectations as ex
from gleanmark.operators import instruct as ins
from gleanmark.operators import report as rp
from gleanmark.operators.audit import as_long, audit, flat_counters
from gleanmark.operators.evaluate import error_rows
from gleanmark.plans.export import export_instructions, instruction_lines
from gleanmark.session import scratch_path
from gleanmark.sources import csvfiles, jsonl, tables
from gleanmark.sources import runs as rn
from gleanmark.sources import variants as vr
from gleanmark.sources.tables import read_table

SPLITS = ["train", "val", "test"]


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


_SQL_HIER_OUTPUT = "'Category: ' || upper(lang) || chr(10) || 'Intent: ' || lower(source)"


# --- scans ----------------------------------------------------------------------------


@query("SELECT doc_id, text, source AS label FROM documents")
def text_and_label_scan(spark, d):
    return tables.load_split(documents(spark, d), "text", "source", "doc_id")


@query("SELECT doc_id, text, source AS label FROM documents ORDER BY doc_id LIMIT 100")
def first_rows_of_a_split(spark, d):
    return tables.load_split(documents(spark, d), "text", "source", "doc_id", limit=100)


@query("""SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'test' ELSE 'train' END AS split,
  label::INT AS label, source AS label_name
FROM documents JOIN (SELECT source, row_number() OVER (ORDER BY source) - 1 AS label FROM (SELECT DISTINCT source FROM documents)) USING (source)""")
def corpus_with_native_test_split(spark, d):
    """A train and a test table with integer labels, and the dictionary of their names."""
    from gleanmark.operators.labelspace import encode, label_space, with_label_name

    docs = documents(spark, d).select("doc_id", "source")
    space = label_space(docs, "source")
    coded = encode(docs, space, "source").select("doc_id", F.col("label_id").alias("label"))
    held = read_table(spark, d, "labels").select("doc_id").distinct()
    both = tables.union_splits(
        {"train": coded.join(held, "doc_id", "left_anti"), "test": coded.join(held, "doc_id", "left_semi")}
    )
    dictionary = space.select(F.col("label_id").alias("label"), F.col("label").alias("label_name"))
    return with_label_name(both, dictionary, "label")


@query("""SELECT event_type, count(*) AS n, sum((props->>'$.k')::BIGINT)::BIGINT AS total_k, max((props->>'$.k')::BIGINT) AS max_k
FROM events GROUP BY 1""")
def json_column_scan(spark, d):
    parsed = F.from_json("props", "k long", {"mode": "FAILFAST"})
    return (
        read_table(spark, d, "events")
        .select("event_type", parsed["k"].alias("k"))
        .groupBy("event_type")
        .agg(F.count("*").alias("n"), F.sum("k").alias("total_k"), F.max("k").alias("max_k"))
    )


# --- instruction records -----------------------------------------------------------------


@query(f"""SELECT doc_id, to_json({{'instruction': {_sql_text(ins.HIERARCHICAL_TASK)}, 'input': text, 'output': {_SQL_HIER_OUTPUT}}})::VARCHAR AS line
FROM documents""")
def hierarchical_instruction_lines(spark, d):
    return instruction_lines(documents(spark, d), ins.hierarchical_record("text", "lang", "source"), "doc_id")


@query(f"""SELECT doc_id, to_json({{'instruction': {_sql_text(ins.FLAT_TASK)}, 'input': text, 'output': 'Intent: ' || source}})::VARCHAR AS line
FROM documents""")
def flat_instruction_lines(spark, d):
    return instruction_lines(documents(spark, d), ins.flat_record("text", "source"), "doc_id")


@query(f"""SELECT doc_id, to_json([
  {{'role': 'system', 'content': {_sql_text(ins.HIERARCHICAL_SYSTEM)}}},
  {{'role': 'user', 'content': {_sql_text(ins.HIERARCHICAL_USER)} || text}},
  {{'role': 'assistant', 'content': {_SQL_HIER_OUTPUT}}}])::VARCHAR AS messages FROM documents""")
def chat_messages_with_answer(spark, d):
    answer = ins.hierarchical_record("text", "lang", "source")["output"]
    messages = ins.chat_messages("text", answer, ins.HIERARCHICAL_SYSTEM, ins.HIERARCHICAL_USER)
    return documents(spark, d).select("doc_id", F.to_json(messages).alias("messages"))


@query(f"""SELECT doc_id,
  '<|im_start|>system' || chr(10) || {_sql_text(ins.FLAT_SYSTEM)} || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) ||
  {_sql_text(ins.FLAT_USER)} || text || '<|im_end|>' || chr(10) AS head,
  '<|im_start|>assistant' || chr(10) || 'Intent: ' || source || '<|im_end|>' || chr(10) AS answer,
  '<|im_start|>assistant' || chr(10) AS cue FROM documents""")
def rendered_prompts(spark, d):
    """Training and generation text, cut where the answer begins."""
    rows = documents(spark, d).select(
        "doc_id",
        ins.render_chat(
            ins.chat_messages("text", F.concat(F.lit("Intent: "), "source"), ins.FLAT_SYSTEM, ins.FLAT_USER)
        ).alias("train"),
        ins.render_chat(
            ins.chat_messages("text", None, ins.FLAT_SYSTEM, ins.FLAT_USER), for_generation=True
        ).alias("ask"),
    )
    n = F.char_length("ask") - len(ins.ANSWER_CUE)
    return rows.select(
        "doc_id",
        F.expr(f"left(train, char_length(ask) - {len(ins.ANSWER_CUE)})").alias("head"),
        F.expr(f"substring(train, char_length(ask) - {len(ins.ANSWER_CUE)} + 1)").alias("answer"),
        F.substring("ask", n + 1, F.lit(len(ins.ANSWER_CUE))).alias("cue"),
    )


@query("""SELECT count(*) AS n_rows, count(*) FILTER (WHERE NOT contains(text, ' the ')) AS n_missing,
  min(doc_id) FILTER (WHERE NOT contains(text, ' the ')) AS first_missing,
  count(*) FILTER (WHERE NOT contains(text, ' the ')) = 0 AS ok FROM documents""")
def anchor_presence(spark, d):
    messages = ins.chat_messages("text", None, ins.FLAT_SYSTEM, "")
    rendered = ins.render_chat(F.slice(messages, 2, 1))
    return ins.anchor_presence(documents(spark, d), rendered, " the ", "doc_id")


@query("""SELECT conv_id, turn, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS rendered FROM conversations""")
def rendered_conversation_turns(spark, d):
    message = F.struct("role", F.col("text").alias("content"))
    return read_table(spark, d, "conversations").select(
        "conv_id", "turn", ins.render_chat(F.array(message)).alias("rendered")
    )


# --- files written and read back --------------------------------------------------------------


@query(f"""WITH {SQL_SPLIT_DOCUMENTS}
SELECT split, instruction, input, output FROM (
  SELECT split, {_sql_text(ins.FLAT_TASK)} AS instruction, text AS input, 'Intent: ' || source AS output FROM split_documents)""")
def instruction_files_read_back(spark, d):
    path = scratch_path(spark, "instructions")
    docs = split_documents(spark, d)
    export_instructions(docs, ins.flat_record("text", "source"), path, SPLITS)
    out = None
    for s in SPLITS:
        part = jsonl.read_instructions(spark, f"{path}/split={s}").withColumn("split", F.lit(s))
        out = part if out is None else out.unionByName(part)
    return out


@query(f"""WITH {SQL_SPLIT_DOCUMENTS} SELECT split, count(*) AS n FROM split_documents GROUP BY 1""")
def exported_rows_per_split(spark, d):
    path = scratch_path(spark, "instructions")
    record = ins.hierarchical_record("text", "lang", "source")
    return export_instructions(split_documents(spark, d), record, path, SPLITS).counts


@query(f"""SELECT line FROM (
  SELECT CASE WHEN {sql_digit('cut', 'doc_id')} < 2 THEN substr(line, 1, length(line) - 2) ELSE line END AS line FROM (
    SELECT doc_id, to_json({{'instruction': {_sql_text(ins.FLAT_TASK)}, 'input': text, 'output': 'Intent: ' || source}})::VARCHAR AS line
    FROM documents)) WHERE NOT json_valid(line)""")
def unparsable_lines(spark, d):
    """Lines of an export, some cut short by hash, that no longer parse."""
    lines = instruction_lines(documents(spark, d), ins.flat_record("text", "source"), "doc_id")
    cut = F.when(digit("cut", "doc_id") < 2, F.expr("left(line, char_length(line) - 2)")).otherwise(F.col("line"))
    path = scratch_path(spark, "cut-lines")
    lines.select(cut.alias("value")).write.text(path)
    return jsonl.check_json_lines(spark, path).select("line")


@query(f"""WITH lines AS (
  SELECT doc_id, doc_id % 8 AS part, CASE WHEN {sql_digit('cut', 'doc_id')} < 2 THEN substr(line, 1, length(line) - 2) ELSE line END AS line FROM (
    SELECT doc_id, to_json({{'instruction': {_sql_text(ins.FLAT_TASK)}, 'input': text, 'output': 'Intent: ' || source}})::VARCHAR AS line FROM documents))
SELECT line_number, line FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY doc_id) AS line_number FROM lines) WHERE NOT json_valid(line)""")
def unparsable_line_numbers(spark, d):
    """The same from eight files in the order of their ids: which line of its file is broken."""
    lines = instruction_lines(documents(spark, d), ins.flat_record("text", "source"), "doc_id")
    cut = F.when(digit("cut", "doc_id") < 2, F.expr("left(line, char_length(line) - 2)")).otherwise(F.col("line"))
    path = scratch_path(spark, "numbered-lines")
    dealt = lines.select("doc_id", cut.alias("value"), (F.col("doc_id") % 8).cast("int").alias("part"))
    # One task, and so one file, for each part.
    dealt.repartitionById(8, F.col("part")).sortWithinPartitions("part", "doc_id").select("value", "part").write.partitionBy("part").text(path)
    return jsonl.check_json_lines(spark, f"{path}/*").select("line_number", "line")


@query("""WITH asked(c) AS (VALUES ('doc_id'), ('text'), ('label_name'), ('source'), ('TEXT')),
held AS (SELECT column_name FROM (DESCRIBE documents))
SELECT c AS "column", c IN (SELECT column_name FROM held) AS present FROM asked""")
def required_columns(spark, d):
    return ex.column_presence(documents(spark, d), ["doc_id", "text", "label_name", "source", "TEXT"])


# A log whose lines have no common shape: a key of its own for each kind of event.
def _odd_log(spark, d):
    kind, k = F.col("event_type"), F.col("event_id") % 10
    line = (
        F.when(k == 0, F.concat(F.lit('{"note": "'), kind, F.lit('"}')))
        .when(k == 1, F.lit("not json"))
        .when(k == 2, F.concat(F.lit('{"'), kind, F.lit('": {"at": '), F.col("event_id"), F.lit(', "props": '), F.col("props"), F.lit("}}")))
        .when(k == 3, F.concat(F.lit('{"'), kind, F.lit('": "'), kind, F.lit('"}')))
        .when(k == 4, F.lit(" "))
        .otherwise(F.concat(F.lit('{"'), kind, F.lit('": '), F.col("event_id"), F.lit("}")))
    )
    path = scratch_path(spark, "odd-log")
    tables.read_table(spark, d, "events").select(line.alias("value")).write.text(path)
    return vr.read_lines(spark, path)


@query("""SELECT CASE WHEN event_id % 10 = 0 THEN 'note' ELSE event_type END AS key,
  CASE WHEN event_id % 10 IN (0, 3) THEN 'STRING' WHEN event_id % 10 = 2 THEN 'OBJECT<at: BIGINT, props: OBJECT<k: BIGINT>>' ELSE 'BIGINT' END AS type, count(*) AS n
FROM events WHERE event_id % 10 NOT IN (1, 4) GROUP BY ALL""")
def keys_of_an_unknown_log(spark, d):
    """Which keys the lines have, and of which types; nobody named them."""
    return vr.keys_found(_odd_log(spark, d))


@query("""SELECT count(*) AS n_lines, count(*) FILTER (WHERE event_type = 'click' AND event_id % 10 > 4) AS n_plain,
  sum(event_id) FILTER (WHERE event_type = 'click' AND event_id % 10 > 4)::BIGINT AS sum_plain,
  sum((props->>'$.k')::BIGINT) FILTER (WHERE event_type = 'click' AND event_id % 10 = 2)::BIGINT AS sum_k
FROM events WHERE event_id % 10 <> 4""")
def values_of_a_key_found(spark, d):
    """A key that was found in the log, read by its path as a number and as an object."""
    log = _odd_log(spark, d)
    key = vr.keys_found(log).where("key like 'cl%'").agg(F.min("key")).first()[0]
    found = vr.extracted(log, {"plain": (f"$.{key}", "bigint"), "k": (f"$.{key}.props.k", "bigint")})
    return found.agg(
        F.count("*").alias("n_lines"), F.count("plain").alias("n_plain"), F.sum("plain").alias("sum_plain"), F.sum("k").alias("sum_k")
    )


@query(f"""WITH {SQL_SPLIT_DOCUMENTS}
SELECT true AS same_schema, count(*)::BIGINT AS n_written, count(*)::BIGINT AS n_read, true AS ok FROM split_documents""")
def parquet_splits_verified(spark, d):
    path = scratch_path(spark, "splits")
    docs = split_documents(spark, d)
    tables.write_splits(docs, path)
    return tables.verify_written(docs, path)


@query(f"""WITH {SQL_SPLIT_DOCUMENTS} SELECT doc_id, text, lang, source, split FROM split_documents WHERE split = 'val'""")
def one_split_read_back(spark, d):
    path = scratch_path(spark, "splits")
    tables.write_splits(split_documents(spark, d), path)
    return tables.read_splits(spark, path, "doc_id long, text string, lang string, source string").where("split = 'val'")


@query(f"""WITH {SQL_EVENT_PREDICTIONS}
SELECT d.text, true_label, predicted_label, length(d.text)::INT AS text_length FROM event_predictions e JOIN documents d ON d.doc_id = e.row_id
WHERE true_label <> predicted_label""")
def error_table_read_back(spark, d):
    """Errors with whole, multi-line document texts through a CSV file."""
    docs = documents(spark, d).select(F.col("doc_id").alias("row_id"), F.col("text"))
    rows = event_predictions(spark, d).drop("text").join(docs, "row_id")
    errors = error_rows(rows, "true_label", "predicted_label", "text").select(
        "text", "true_label", "predicted_label", "text_length"
    )
    path = scratch_path(spark, "errors")
    csvfiles.write_table(errors, path)
    return csvfiles.read_table(
        spark, path, "text string, true_label string, predicted_label string, text_length int"
    )


@query("""SELECT user_id::VARCHAR AS run_id, arg_max(value, event_id) AS train_runtime FROM events
WHERE event_type = 'purchase' AND value IS NOT NULL GROUP BY 1""")
def last_training_time_of_mixed_log(spark, d):
    """A log whose lines carry different keys, written as JSON lines and read back."""
    events = read_table(spark, d, "events")
    line = F.to_json(
        F.struct(
            F.col("event_id").alias("step"),
            F.col("user_id").cast("string").alias("run_id"),
            F.when(F.col("event_type") == "view", F.col("value")).alias("loss"),
            F.when(F.col("event_type") == "click", F.col("value")).alias("eval_loss"),
            F.when(F.col("event_type") == "purchase", F.col("value")).alias("train_runtime"),
        )
    )
    path = scratch_path(spark, "log")
    events.select(line.alias("value")).write.text(path)
    return rp.last_logged(jsonl.read_training_log(spark, path), ["run_id"], "train_runtime", ["step"])


_SQL_REPORT = f"""{SQL_INJECTED},
flat AS (SELECT 'documents' AS dataset, 'all' AS split, text FROM documents
  UNION ALL SELECT 'dirty', 'all', instruction FROM dirty)"""


@query(f"""WITH {_SQL_REPORT}
SELECT 'eda' AS section, dataset, split, 'n_rows' AS metric, count(*)::DOUBLE AS value FROM flat WHERE dataset = 'dirty' GROUP BY ALL
UNION ALL SELECT 'eda', dataset, split, 'has_tab', count(*) FILTER (WHERE contains(text, chr(9)))::DOUBLE FROM flat WHERE dataset = 'dirty' GROUP BY ALL
UNION ALL SELECT 'cleaning', dataset, split, 'n_rows', count(*)::DOUBLE FROM flat WHERE dataset = 'documents' GROUP BY ALL
UNION ALL SELECT 'cleaning', dataset, split, 'has_tab', count(*) FILTER (WHERE contains(text, chr(9)))::DOUBLE FROM flat WHERE dataset = 'documents' GROUP BY ALL""")
def report_sections_replaced(spark, d):
    """Write section eda, then cleaning, then eda anew: only eda changes."""
    path = scratch_path(spark, "report")
    names = ["n_rows", "has_tab"]

    def part(df, text, dataset):
        counters = {k: v for k, v in flat_counters(text, text, [text]).items() if k in names}
        wide = audit(df, counters).select(
            F.lit(dataset).alias("dataset"), F.lit("all").alias("split"),
            *[F.col(n).cast("double").alias(n) for n in names],
        )
        return as_long(wide, names, ["dataset", "split"])

    plain = part(documents(spark, d), "text", "documents")
    rn.write_report(plain, path, "eda")
    rn.write_report(plain, path, "cleaning")
    rn.write_report(part(dirty(spark, d), "instruction", "dirty"), path, "eda")
    return rn.read_report(spark, path)


@query("""SELECT 'eda' AS section, to_json(map(list(k ORDER BY k), list(v ORDER BY k)))::VARCHAR AS document FROM (
  SELECT lang || '/all' AS k, to_json({'max_chars': max(length(text))::DOUBLE, 'n_rows': count(*)::DOUBLE})::VARCHAR AS v
  FROM documents GROUP BY lang)""")
def report_as_json_document(spark, d):
    report = (
        documents(spark, d)
        .groupBy(F.col("lang").alias("dataset"))
        .agg(F.count("*").cast("double").alias("n_rows"), F.max(F.char_length("text")).cast("double").alias("max_chars"))
        .unpivot("dataset", ["n_rows", "max_chars"], "metric", "value")
    )
    return rn.report_as_json(
        report.withColumn("split", F.lit("all")).withColumn("section", F.lit("eda"))
    )

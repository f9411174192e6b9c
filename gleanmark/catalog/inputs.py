"""Corpora the queries run on, as Spark tables and as SQL common table expressions.

Every one derives from the given tables in full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanmark.operators.inject import DEFECT_FRACTIONS, inject_defects
from gleanmark.sources.tables import read_table

HEX = "0123456789abcdef"

# Caps that suit these documents, which are longer than customer messages.
TEXT_CAP = 10_000
RESPONSE_CAP = 50_000

# The label lists of the two prediction corpora.
EVENT_LABELS = ["click", "error", "purchase", "signup", "view"]
ORDER_LABELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

# Unicode whitespace, spelled out for an engine whose \\s is ASCII.
WHITESPACE = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
SQL_WS = f"[{WHITESPACE}]"


def sql_collapse(c: str) -> str:
    return f"trim(regexp_replace({c}, '{SQL_WS}+', ' ', 'g'))"


def sql_words(c: str) -> str:
    return f"len(regexp_extract_all({c}, '[^{WHITESPACE}]+'))"


def sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def digit(tag: str, row_id: str | Column, position: int = 1) -> Column:
    """A hash digit 0..15 of a row."""
    rid = F.col(row_id) if isinstance(row_id, str) else row_id
    h = F.md5(F.concat(F.lit(f"{tag}:"), rid.cast("string")))
    return F.instr(F.lit(HEX), F.substring(h, position, 1)) - 1


def sql_digit(tag: str, row_id: str, position: int = 1) -> str:
    return f"(strpos('{HEX}', substr(md5('{tag}:' || {row_id}), {position}, 1)) - 1)"


def documents(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "documents")


# --- documents with a random split -----------------------------------------------


def split_documents(spark: SparkSession, d: str) -> DataFrame:
    """``doc_id, text, lang, source, split`` where copies may fall into any split."""
    n = digit("part", "doc_id")
    split = F.when(n < 10, "train").when(n < 13, "val").otherwise("test")
    return documents(spark, d).select("doc_id", "text", "lang", "source", split.alias("split"))


SQL_SPLIT_DOCUMENTS = f"""split_documents AS (
  SELECT doc_id, text, lang, source,
         CASE WHEN {sql_digit('part', 'doc_id')} < 10 THEN 'train'
              WHEN {sql_digit('part', 'doc_id')} < 13 THEN 'val' ELSE 'test' END AS split
  FROM documents)"""


# --- a hierarchical corpus, clean and with injected defects ------------------------


def pristine(spark: SparkSession, d: str) -> DataFrame:
    return documents(spark, d).select(
        F.col("doc_id").alias("row_id"),
        F.col("text").alias("instruction"),
        F.upper("lang").alias("category"),
        F.col("source").alias("intent"),
        F.concat(F.lit("It's "), "text").alias("response"),
    )


def injected(spark: SparkSession, d: str) -> DataFrame:
    return inject_defects(
        pristine(spark, d), "row_id", "instruction", "response", "category", "intent"
    )


def dirty(spark: SparkSession, d: str) -> DataFrame:
    return injected(spark, d).select("row_id", "instruction", "category", "intent", "response")


def _sql_hit(defect: str, share: float) -> str:
    return (
        f"row_number() OVER (ORDER BY md5('42:{defect}:' || row_id)) <= "
        f"(SELECT round_even({share}::DOUBLE * count(*), 0)::BIGINT FROM documents) AS hit_{defect}"
    )


SQL_INJECTED = f"""pristine AS (
  SELECT doc_id AS row_id, text AS instruction, upper(lang) AS category, source AS intent,
         'It''s ' || text AS response
  FROM documents),
picked AS (
  SELECT *, {', '.join(_sql_hit(k, v) for k, v in DEFECT_FRACTIONS.items())} FROM pristine),
spaced AS (
  SELECT * REPLACE (
    CASE WHEN NOT hit_null_label THEN intent END AS intent,
    CASE WHEN hit_whitespace THEN '  ' || regexp_replace(instruction, '^([^ ]*) ', '\\1   ') || chr(9)
         ELSE instruction END AS instruction,
    CASE WHEN NOT hit_case THEN category
         WHEN substr(md5('42:coin:' || row_id), 1, 1) < '8' THEN lower(category)
         ELSE upper(category[1]) || lower(category[2:]) END AS category,
    CASE WHEN hit_mojibake THEN 'Ã©' || replace(response, '''', 'â€™') ELSE response END AS response)
  FROM picked),
damaged AS (
  SELECT * REPLACE (CASE WHEN hit_outlier THEN repeat(instruction || ' ', 10) ELSE instruction END AS instruction)
  FROM spaced),
injected AS (
  SELECT * REPLACE (row_id * 2 + appended::INT AS row_id)
  FROM (SELECT *, unnest(CASE WHEN hit_duplicate THEN [false, true] ELSE [false] END) AS appended FROM damaged)),
dirty AS (SELECT row_id, instruction, category, intent, response FROM injected)"""

# Nothing here is changed by Unicode normalisation, so repair and collapsing suffice.
SQL_REPAIRED = (
    "replace(replace(replace(replace(replace({c}, 'â€™', ''''), 'â€œ', '\"'), "
    "'â€' || chr(157), '\"'), 'Ã©', ''), 'ï»¿', '')"
)

SQL_TAGGED = f"""{SQL_INJECTED},
normalised AS (
  SELECT row_id, instruction AS raw, intent, upper(category) AS category,
         {sql_collapse('instruction')} AS instruction,
         {SQL_REPAIRED.format(c=sql_collapse('response'))} AS response
  FROM dirty),
step1 AS (
  SELECT *, CASE WHEN intent IS NULL THEN 'drop_null_label' END AS s1,
         row_number() OVER (PARTITION BY intent IS NULL, raw, intent ORDER BY row_id) AS raw_place
  FROM normalised),
step2 AS (
  SELECT *, CASE WHEN s1 IS NOT NULL THEN s1
                 WHEN raw_place > 1 THEN 'dedup_text_label'
                 WHEN NOT (length(instruction) <= {TEXT_CAP} AND length(response) <= {RESPONSE_CAP})
                 THEN 'drop_length_outliers' END AS s2
  FROM step1),
tagged AS (
  SELECT row_id, instruction, category, intent, response,
         CASE WHEN s2 IS NOT NULL THEN s2
              WHEN row_number() OVER (PARTITION BY s2, instruction, intent ORDER BY row_id) > 1
              THEN 'dedup_after_normalising' END AS failed_step
  FROM step2),
cleaned AS (SELECT * EXCLUDE (failed_step) FROM tagged WHERE failed_step IS NULL)"""


# --- predictions over events and orders -----------------------------------------------

MODELS = {"forest": 14, "linear": 12, "rules": 9}


def predictions(spark: SparkSession, d: str) -> DataFrame:
    """``dataset, model, split, row_id, text, true_label, predicted_label``.

    A model repeats the gold label of a share of the rows and otherwise names a
    label drawn by hash.
    """
    events = read_table(spark, d, "events").select(
        F.lit("events").alias("dataset"),
        F.col("event_id").alias("row_id"),
        F.col("props").alias("text"),
        F.col("event_type").alias("true_label"),
        F.array(*[F.lit(x) for x in EVENT_LABELS]).alias("_labels"),
    )
    orders = spark.read.parquet(f"{d}/orders.parquet").select(
        F.lit("orders").alias("dataset"),
        F.col("o_orderkey").alias("row_id"),
        F.col("o_orderstatus").alias("text"),
        F.col("o_orderpriority").alias("true_label"),
        F.array(*[F.lit(x) for x in ORDER_LABELS]).alias("_labels"),
    )
    models = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.lit(k).alias("k")) for m, k in MODELS.items()]))
    rid = F.concat_ws("/", "model", "row_id")
    drawn = F.element_at("_labels", (digit("draw", rid) % 5 + 1).cast("int"))
    return (
        events.unionByName(orders)
        .withColumn("_m", models)
        .select("*", "_m.model", "_m.k")
        .select(
            "dataset",
            "model",
            F.when(digit("half", "row_id") < 8, "val").otherwise("test").alias("split"),
            "row_id",
            "text",
            "true_label",
            F.when(digit("hit", rid) < F.col("k"), F.col("true_label")).otherwise(drawn).alias("predicted_label"),
        )
    )


SQL_PREDICTIONS = f"""gold AS (
  SELECT 'events' AS dataset, event_id AS row_id, props AS text, event_type AS true_label,
         {sql_list(EVENT_LABELS)} AS labels FROM events
  UNION ALL
  SELECT 'orders', o_orderkey, o_orderstatus, o_orderpriority, {sql_list(ORDER_LABELS)} FROM orders),
models(model, k) AS (VALUES {', '.join(f"('{m}', {k})" for m, k in MODELS.items())}),
predictions AS (
  SELECT dataset, model,
         CASE WHEN {sql_digit('half', 'row_id')} < 8 THEN 'val' ELSE 'test' END AS split,
         row_id, text, true_label,
         CASE WHEN {sql_digit('hit', "(model || '/' || row_id)")} < k THEN true_label
              ELSE labels[{sql_digit('draw', "(model || '/' || row_id)")} % 5 + 1] END AS predicted_label
  FROM gold, models)"""


def event_predictions(spark: SparkSession, d: str, model: str = "linear") -> DataFrame:
    return predictions(spark, d).where((F.col("dataset") == "events") & (F.col("model") == model))


SQL_EVENT_PREDICTIONS = SQL_PREDICTIONS + """,
event_predictions AS (SELECT * FROM predictions WHERE dataset = 'events' AND model = 'linear')"""


def label_table(spark: SparkSession, labels: list[str]) -> DataFrame:
    return spark.createDataFrame([(x,) for x in labels], "label string")


def sql_metrics(source: str, by: str, labels: str, prefix: str = "") -> str:
    """CTEs ``{prefix}cls`` (per class) and ``{prefix}avg`` (overall).

    ``source`` has ``by, true_label, predicted_label``; ``labels`` has ``by, label``.
    """
    p = prefix
    return f"""{p}entries AS (
  SELECT {by}, true_label AS label, (true_label = predicted_label)::INT AS tp, 1 AS support, 0 AS predicted
  FROM {source}
  UNION ALL SELECT {by}, predicted_label, 0, 0, 1 FROM {source}),
{p}cells AS (
  SELECT {by}, label, sum(tp) AS tp, sum(support) AS support, sum(predicted) AS predicted
  FROM {p}entries GROUP BY ALL),
{p}exact AS (
  SELECT {by}, label, coalesce(support, 0)::BIGINT AS support,
         CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END::DOUBLE AS precision,
         CASE WHEN support > 0 THEN tp / support ELSE 0 END::DOUBLE AS recall,
         CASE WHEN predicted + support > 0 THEN 2.0 * tp / (predicted + support) ELSE 0 END::DOUBLE AS f1
  FROM {labels} LEFT JOIN {p}cells USING ({by}, label)),
{p}cls AS (
  SELECT {by}, label, round(precision, 4) AS precision, round(recall, 4) AS recall,
         round(f1, 4) AS f1, support FROM {p}exact),
{p}avg AS (
  SELECT {by}, n_rows, accuracy, macro_f1, macro_precision, macro_recall, weighted_f1
  FROM (SELECT {by}, count(*) AS n_rows, round(avg((true_label = predicted_label)::INT), 4) AS accuracy
        FROM {source} GROUP BY ALL)
  JOIN (SELECT {by}, round(avg(f1), 4) AS macro_f1, round(avg(precision), 4) AS macro_precision,
               round(avg(recall), 4) AS macro_recall,
               round(coalesce(sum(f1 * support) / nullif(sum(support), 0), 0), 4) AS weighted_f1
        FROM {p}exact GROUP BY ALL) USING ({by}))"""


# --- raw answers ---------------------------------------------------------------------


def answers(spark: SparkSession, d: str) -> DataFrame:
    """``row_id, text, gold, pred_raw``: one-line answers in many shapes, one per event."""
    g = F.col("event_type")
    n = digit("raw", "event_id")
    other = F.element_at(
        F.array(*[F.lit(x) for x in EVENT_LABELS]), (digit("draw", "event_id") % 5 + 1).cast("int")
    )
    raw = (
        F.when(n < 4, F.concat(F.lit("Intent: "), g))
        .when(n < 7, g)
        .when(n == 7, F.concat(F.lit("intent ="), F.upper(g)))
        .when(n == 8, F.concat(g, F.lit("x")))
        .when(n == 9, F.concat(F.lit("Intent: "), g, F.lit("s")))
        .when(n == 10, F.concat(F.lit("  "), g, F.lit(" is my answer.")))
        .when(n == 11, F.lit(""))
        .when(n == 12, F.lit("Intent: zzzz"))
        .when(n == 13, F.lit("???"))
        .when(n == 14, F.concat(F.lit("Intent: "), other))
        .otherwise(F.concat(F.lit("The answer: "), g))
    )
    return read_table(spark, d, "events").select(
        F.col("event_id").alias("row_id"),
        F.col("props").alias("text"),
        F.concat(F.lit("Intent: "), g).alias("gold"),
        raw.alias("pred_raw"),
    )


# What each shape must parse to, known from how it was built.
SQL_PARSED = f"""parsed AS (
  SELECT event_id AS row_id, props AS text, event_type AS true_intent, n,
         CASE WHEN n IN (11, 12, 13, 15) THEN NULL
              WHEN n = 14 THEN {sql_list(EVENT_LABELS)}[{sql_digit('draw', 'event_id')} % 5 + 1]
              ELSE event_type END AS pred_intent,
         CASE WHEN n IN (0, 1, 2, 3, 7, 14) THEN 'regex'
              WHEN n IN (4, 5, 6, 10) THEN 'bare'
              WHEN n IN (8, 9) THEN 'fuzzy' ELSE 'none' END AS parse_path,
         n IN (11, 12, 13, 15) AS parse_error
  FROM (SELECT *, {sql_digit('raw', 'event_id')} AS n FROM events))"""

CATEGORY_OF = {"click": "BROWSE", "view": "BROWSE", "error": "FAULT", "purchase": "SALE", "signup": "SALE"}
CATEGORIES = ["BROWSE", "FAULT", "SALE"]


def category_of(label: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, v in CATEGORY_OF.items():
        out = F.when(label == k, v).otherwise(out)
    return out


def sql_category_of(label: str) -> str:
    return "CASE " + label + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CATEGORY_OF.items()) + " END"


def two_line_answers(spark: SparkSession, d: str) -> DataFrame:
    """``row_id, true_label, true_category, raw``: two-line answers, some damaged."""
    g = F.col("event_type")
    c = category_of(g)
    n = digit("pair", "event_id")
    raw = (
        F.when(n < 9, F.concat(F.lit("Category: "), c, F.lit("\nIntent: "), g))
        .when(n < 11, F.concat(F.lit("category= "), c, F.lit("S\nintent= "), g, F.lit("_x")))
        .when(n == 11, F.concat(F.lit("Intent: "), g))
        .when(n == 12, F.concat(F.lit("Category: "), c, F.lit("\nIntent: qqqq")))
        .when(n == 13, F.concat(F.lit("Category: "), c))
        .otherwise(F.lit("no idea"))
    )
    return read_table(spark, d, "events").select(
        F.col("event_id").alias("row_id"), g.alias("true_label"), c.alias("true_category"), raw.alias("raw")
    )


SQL_TWO_LINE = f"""two_line AS (
  SELECT event_id AS row_id, event_type AS true_label, {sql_category_of('event_type')} AS true_category,
         CASE WHEN n IN (11, 14, 15) THEN NULL ELSE {sql_category_of('event_type')} END AS pred_category,
         CASE WHEN n IN (13, 14, 15) THEN NULL WHEN n = 12 THEN 'qqqq' ELSE event_type END AS pred_intent,
         n >= 11 AS parse_error
  FROM (SELECT *, {sql_digit('pair', 'event_id')} AS n FROM events))"""

"""Audits, cleaning, de-duplication, filters and expectations."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanmark.catalog.inputs import (
    documents,
    RESPONSE_CAP,
    SQL_EVENT_PREDICTIONS,
    SQL_INJECTED,
    SQL_TAGGED,
    SQL_WS,
    TEXT_CAP,
    dirty,
    event_predictions,
    sql_collapse,
)
from gleanmark.catalog.registry import query
from gleanmark.functions import text as tx
from gleanmark.operators import audit as au
from gleanmark.operators import profile as pf
from gleanmark.operators.dedup import keep_first
from gleanmark.operators.evaluate import error_rows
from gleanmark.operators.expectations import expectations
from gleanmark.plans import cleaning as cl
from gleanmark.session import stage
from gleanmark.sources.tables import read_table

_FLAT_SQL = """
  count(*) AS n_rows, count(*) FILTER (WHERE text IS NULL) AS null_text,
  count(*) FILTER (WHERE label IS NULL) AS null_label,
  count(*) FILTER (WHERE NOT regexp_matches(coalesce(text, ''), '[^{ws}]')) AS blank_text,
  count(*) - count(DISTINCT (row_id, text, label)) AS duplicate_rows,
  count(*) - count(DISTINCT (text, label)) AS duplicate_text_label,
  count(*) - count(DISTINCT text) AS duplicate_text,
  count(*) FILTER (WHERE regexp_matches(text, '^[{ws}]|[{ws}]$')) AS edge_whitespace,
  count(*) FILTER (WHERE regexp_matches(text, '  +')) AS multi_space,
  count(*) FILTER (WHERE contains(text, chr(9))) AS has_tab,
  count(*) FILTER (WHERE contains(text, chr(10))) AS has_newline,
  count(*) FILTER (WHERE regexp_matches(text, '[^\\x00-\\x7F]')) AS non_ascii,
  count(*) FILTER (WHERE regexp_matches(text, 'Ã.|â€.|Â.|ï»¿')) AS mojibake,
  count(*) FILTER (WHERE length(text) < 10) AS very_short,
  count(*) FILTER (WHERE length(text) > 300) AS very_long""".format(ws=SQL_WS[1:-1])
_FLAT_NAMES = [
    "n_rows", "null_text", "null_label", "blank_text", "duplicate_rows", "duplicate_text_label",
    "duplicate_text", "edge_whitespace", "multi_space", "has_tab", "has_newline", "non_ascii",
    "mojibake", "very_short", "very_long",
]
_HIER_SQL = """
  count(*) AS n_rows, count(*) FILTER (WHERE intent IS NULL) AS null_intent,
  count(*) - count(DISTINCT (instruction, coalesce(intent, '~'))) AS duplicate_instruction_intent,
  count(*) - count(DISTINCT (instruction, coalesce(intent, '~'), category, response)) AS duplicate_rows,
  count(*) FILTER (WHERE regexp_matches(response, 'Ã.|â€.|Â.|ï»¿')) AS mojibake_response,
  count(*) FILTER (WHERE length(instruction) > {tc}) AS instruction_over_cap,
  count(*) FILTER (WHERE length(response) > {rc}) AS response_over_cap,
  count(*) FILTER (WHERE category <> upper(category)) AS category_not_upper,
  count(*) FILTER (WHERE regexp_matches(instruction, '^[{ws}]|[{ws}]$')) AS instruction_edge_whitespace,
  count(*) FILTER (WHERE regexp_matches(instruction, '  +')) AS instruction_multi_space,
  count(*) FILTER (WHERE contains(instruction, chr(9))) AS instruction_has_tab""".format(
    ws=SQL_WS[1:-1], tc=TEXT_CAP, rc=RESPONSE_CAP
)
_HIER_NAMES = [
    "n_rows", "null_intent", "duplicate_instruction_intent", "duplicate_rows", "mojibake_response",
    "instruction_over_cap", "response_over_cap", "category_not_upper",
    "instruction_edge_whitespace", "instruction_multi_space", "instruction_has_tab",
]


def _flat(spark, d):
    """Defective texts with their label, split by writing system of the category."""
    return dirty(spark, d).select(
        "row_id", F.col("instruction").alias("text"), F.col("intent").alias("label"),
        F.upper("category").alias("split"),
    )


_SQL_FLAT = f"""{SQL_INJECTED},
flat AS (SELECT row_id, instruction AS text, intent AS label, upper(category) AS split FROM dirty)"""


def _flat_counters():
    return au.flat_counters("text", "label", ["row_id", "text", "label"])


_HIER_AUDIT = (
    "instruction", "response", "category", "intent",
    ["instruction", "intent", "category", "response"], TEXT_CAP, RESPONSE_CAP,
)


def _hier_counters(measured=False):
    return au.hierarchical_counters(*_HIER_AUDIT, measured=measured)


def _tagged(spark, d):
    return cl.tag_hierarchical(dirty(spark, d), text_cap=TEXT_CAP, response_cap=RESPONSE_CAP)


# --- audits ----------------------------------------------------------------------


@query(f"WITH {_SQL_FLAT} SELECT split, {_FLAT_SQL} FROM flat GROUP BY split")
def corpus_audit(spark, d):
    return au.audit(_flat(spark, d), _flat_counters(), ["split"])


@query(f"WITH {SQL_INJECTED} SELECT {_HIER_SQL} FROM dirty")
def hierarchical_audit(spark, d):
    return au.audit(dirty(spark, d), _hier_counters())


@query(f"""WITH {SQL_TAGGED},
both_phases AS (
  SELECT 'all_before' AS side, {_HIER_SQL} FROM dirty UNION ALL SELECT 'all_after', {_HIER_SQL} FROM cleaned),
long AS (SELECT * FROM both_phases UNPIVOT (value FOR metric IN ({', '.join(_HIER_NAMES)})))
SELECT metric, max(value) FILTER (WHERE side = 'all_before')::BIGINT AS all_before,
       max(value) FILTER (WHERE side = 'all_after')::BIGINT AS all_after
FROM long GROUP BY metric""")
def audit_before_and_after_cleaning(spark, d):
    before = stage(dirty(spark, d), "dirty")
    facts = au.hierarchical_facts(*_HIER_AUDIT)
    after = cl.clean_hierarchical(before, text_cap=TEXT_CAP, response_cap=RESPONSE_CAP, facts=facts)
    counters = _hier_counters()
    reports = [
        au.audit(df, c).withColumn("split", F.lit("all"))
        for df, c in ((before, counters), (after, _hier_counters(measured=True)))
    ]
    return au.before_after(*reports, list(counters), "split")


@query(f"""WITH {SQL_TAGGED},
report AS (SELECT {_HIER_SQL} FROM cleaned)
SELECT metric, value::BIGINT AS value, value = 0 AS ok
FROM report UNPIVOT (value FOR metric IN ({', '.join(_HIER_NAMES[1:])}))""")
def audit_gate_after_cleaning(spark, d):
    facts = au.hierarchical_facts(*_HIER_AUDIT)
    cleaned = cl.clean_hierarchical(dirty(spark, d), text_cap=TEXT_CAP, response_cap=RESPONSE_CAP, facts=facts)
    return au.gate(au.audit(cleaned, _hier_counters(measured=True)), _HIER_NAMES[1:])


@query(f"""WITH {SQL_INJECTED},
wide AS (SELECT count(*) FILTER (WHERE instruction IS NULL) AS instruction,
  count(*) FILTER (WHERE category IS NULL) AS category, count(*) FILTER (WHERE intent IS NULL) AS intent,
  count(*) FILTER (WHERE response IS NULL) AS response, count(*) FILTER (WHERE row_id IS NULL) AS row_id,
  count(*) FILTER (WHERE intent IS NULL OR instruction IS NULL OR category IS NULL OR response IS NULL) AS "(any)"
  FROM dirty)
SELECT "column", nulls FROM wide UNPIVOT (nulls FOR "column" IN (row_id, instruction, category, intent, response, "(any)"))""")
def null_counts_per_column(spark, d):
    return au.null_counts(dirty(spark, d))


@query(f"""WITH {SQL_INJECTED},
texts AS (SELECT 'instruction' AS "column", instruction AS t FROM dirty UNION ALL SELECT 'response', response FROM dirty)
SELECT "column", count(*) FILTER (WHERE regexp_matches(t, '^{SQL_WS}')) AS leading,
  count(*) FILTER (WHERE regexp_matches(t, '{SQL_WS}$')) AS trailing,
  count(*) FILTER (WHERE regexp_matches(t, '  +')) AS multi_space,
  count(*) FILTER (WHERE contains(t, chr(9))) AS tab, count(*) FILTER (WHERE contains(t, chr(10))) AS newline
FROM texts GROUP BY 1""")
def whitespace_profile_per_column(spark, d):
    return au.whitespace_profile(dirty(spark, d), ["instruction", "response"])


@query(f"""WITH {SQL_INJECTED},
texts AS (SELECT 'instruction' AS "column", instruction AS t FROM dirty UNION ALL SELECT 'response', response FROM dirty)
SELECT "column", count(*) FILTER (WHERE {sql_collapse('t')} = '') AS blank,
  count(*) FILTER (WHERE regexp_matches(t, '[^\\x00-\\x7F]')) AS non_ascii,
  count(*) FILTER (WHERE regexp_matches(t, 'Ã.|â€.|Â.|ï»¿')) AS mojibake
FROM texts GROUP BY 1""")
def character_damage_per_column(spark, d):
    return au.character_damage(dirty(spark, d), ["instruction", "response"])


@query("""SELECT count(*) - count(DISTINCT (text, lang, source)) AS all_but_id,
  count(*) - count(DISTINCT (text, source)) AS pair, count(*) - count(DISTINCT text) AS text_only FROM documents""")
def duplicate_rows_beyond_first(spark, d):
    from gleanmark.operators.dedup import duplicates_beyond_first as dup

    return documents(spark, d).agg(
        dup("text", "lang", "source").alias("all_but_id"),
        dup("text", "source").alias("pair"),
        dup("text").alias("text_only"),
    )


@query("""SELECT name AS "column", type, (SELECT count(*) FROM documents) AS n_rows
FROM (VALUES ('doc_id', 'bigint'), ('text', 'string'), ('lang', 'string'), ('source', 'string'), ('n_chars', 'bigint')) t(name, type)""")
def shape_and_types(spark, d):
    return au.shape(documents(spark, d))


# --- cleaning ----------------------------------------------------------------------


@query(f"""WITH {SQL_TAGGED},
sides AS (SELECT 'crossed' AS corpus, intent, category FROM cleaned UNION ALL SELECT 'nested', category || '/' || intent, category FROM cleaned),
parents AS (SELECT corpus, intent, count(DISTINCT category) AS n FROM sides GROUP BY ALL)
SELECT corpus, count(*) AS n_labels, count(*) FILTER (WHERE n > 1) AS n_violations, min(intent) FILTER (WHERE n > 1) AS first_violation,
  count(*) FILTER (WHERE n > 1) = 0 AS ok FROM parents GROUP BY corpus""")
def hierarchy_gate_after_cleaning(spark, d):
    """The last step of cleaning, on a corpus whose labels cross categories and on one whose labels do not."""
    crossed = cl.clean_hierarchical(dirty(spark, d), text_cap=TEXT_CAP, response_cap=RESPONSE_CAP)
    crossed = stage(crossed.select("intent", "category"), "cleaned-labels")
    nested = crossed.withColumn("intent", F.concat_ws("/", "category", "intent"))
    gates = {"crossed": crossed, "nested": nested}
    out = None
    for name, rows in gates.items():
        part = cl.hierarchy_gate(rows).withColumn("corpus", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


@query(f"WITH {SQL_TAGGED} SELECT * FROM cleaned")
def hierarchical_cleaning(spark, d):
    return cl.clean_hierarchical(dirty(spark, d), text_cap=TEXT_CAP, response_cap=RESPONSE_CAP)


@query(f"""WITH {SQL_TAGGED},
steps(step_no, step) AS (VALUES (1, 'drop_null_label'), (2, 'dedup_text_label'),
  (3, 'drop_length_outliers'), (4, 'dedup_after_normalising')),
counted AS (SELECT step_no, step, (SELECT count(*) FROM tagged) AS n,
  (SELECT count(*) FROM tagged WHERE failed_step = step) AS dropped FROM steps),
totals AS (SELECT *, sum(dropped) OVER (ORDER BY step_no) AS upto FROM counted)
SELECT step_no, step, (n - upto + dropped)::BIGINT AS rows_before, (n - upto)::BIGINT AS rows_after, dropped FROM totals""")
def hierarchical_cleaning_log(spark, d):
    return cl.cleaning_log(_tagged(spark, d), cl.HIERARCHICAL_STEPS)


_SQL_PIECES = f"""pieces AS (
  SELECT doc_id * 1000000 + i AS row_id, s AS text, lang AS label,
         CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'test' ELSE 'train' END AS split
  FROM (SELECT doc_id, lang, unnest(string_split(text, '.')) AS s, generate_subscripts(string_split(text, '.'), 1) - 1 AS i
        FROM documents)),
flat_tagged AS (
  SELECT row_id, text, label, split, CASE WHEN text = '' THEN 'drop_empty_text'
    WHEN row_number() OVER (PARTITION BY split, text, label ORDER BY row_id) > 1 THEN 'dedup_text_label' END AS failed_step
  FROM (SELECT * REPLACE ({sql_collapse('text')} AS text) FROM pieces))"""


def _pieces(spark, d):
    """Sentences of all documents, many of them blank or repeated."""
    labelled = read_table(spark, d, "labels").select("doc_id", F.lit("test").alias("_s")).distinct()
    return (
        documents(spark, d)
        .join(labelled, "doc_id", "left")
        .select("doc_id", F.col("lang").alias("label"), F.coalesce("_s", F.lit("train")).alias("split"),
                F.posexplode(F.split("text", r"\.")).alias("i", "text"))
        .select((F.col("doc_id") * 1000000 + F.col("i")).alias("row_id"), "text", "label", "split")
    )


@query(f"""WITH {_SQL_PIECES}
SELECT row_id, text, label, split FROM flat_tagged WHERE failed_step IS NULL""")
def flat_cleaning(spark, d):
    return cl.clean_flat(_pieces(spark, d), split="split").select("row_id", "text", "label", "split")


@query(f"""WITH {_SQL_PIECES},
n AS (SELECT split, count(*) AS n, count(*) FILTER (WHERE failed_step = 'drop_empty_text') AS a,
  count(*) FILTER (WHERE failed_step = 'dedup_text_label') AS b FROM flat_tagged GROUP BY split)
SELECT split, 1 AS step_no, 'drop_empty_text' AS step, n AS rows_before, n - a AS rows_after, a AS dropped FROM n
UNION ALL SELECT split, 2, 'dedup_text_label', n - a, n - a - b, b FROM n""")
def flat_cleaning_log(spark, d):
    tagged = cl.tag_flat(_pieces(spark, d), split="split")
    return cl.cleaning_log(tagged, cl.FLAT_STEPS, ["split"])


@query("""SELECT doc_id, text, lang, source FROM (
  SELECT *, row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) AS place FROM documents) WHERE place = 1""")
def first_of_each_text(spark, d):
    return keep_first(
        documents(spark, d).select("doc_id", "text", "lang", "source"), ["text", "lang"], "doc_id"
    )


# --- filters -------------------------------------------------------------------------


@query(f"WITH {SQL_INJECTED} SELECT row_id, category, intent FROM dirty WHERE intent IS NOT NULL")
def rows_with_label(spark, d):
    return dirty(spark, d).na.drop(subset=["intent"]).select("row_id", "category", "intent")


@query(f"""WITH {_SQL_PIECES}
SELECT row_id, text FROM (SELECT row_id, {sql_collapse('text')} AS text FROM pieces) WHERE length(text) > 0""")
def rows_with_text(spark, d):
    return cl.normalise_columns(cl.drop_empty(_pieces(spark, d).select("row_id", "text"), "text"), ["text"])


@query(f"""WITH {SQL_INJECTED} SELECT row_id FROM dirty
WHERE length(instruction) <= {TEXT_CAP} AND length(response) <= {RESPONSE_CAP}""")
def rows_within_length_caps(spark, d):
    return dirty(spark, d).where(
        (F.char_length("instruction") <= TEXT_CAP) & (F.char_length("response") <= RESPONSE_CAP)
    ).select("row_id")


@query("""SELECT lang, count(*) FILTER (WHERE length(text) > 500) AS long_instruction,
  count(*) FILTER (WHERE length(text) > 2000) AS long_response, count(*) FILTER (WHERE length(text) < 5) AS short_instruction,
  count(*) FILTER (WHERE length(text) < 20) AS short_response, count(*) FILTER (WHERE length(text) > 300) AS very_long,
  count(*) FILTER (WHERE length(text) < 10) AS very_short FROM documents GROUP BY lang""")
def length_flags(spark, d):
    t = tx.as_text("text")
    return documents(spark, d).groupBy("lang").agg(
        F.count_if(tx.exceeds(t, 500)).alias("long_instruction"),
        F.count_if(tx.exceeds(t, 2000)).alias("long_response"),
        F.count_if(tx.shorter_than(t, 5)).alias("short_instruction"),
        F.count_if(tx.shorter_than(t, 20)).alias("short_response"),
        F.count_if(tx.exceeds(t, au.LONG_CHARS)).alias("very_long"),
        F.count_if(tx.shorter_than(t, au.SHORT_CHARS)).alias("very_short"),
    )


@query("SELECT doc_id, length(text)::INT AS n FROM documents WHERE length(text) > 300")
def long_texts(spark, d):
    return (
        documents(spark, d).withColumn("n", F.char_length("text")).where("n > 300").select("doc_id", "n")
    )


@query("""(SELECT 'newline' AS reason, doc_id, text FROM documents WHERE contains(text, chr(10)) ORDER BY doc_id LIMIT 3)
UNION ALL (SELECT 'non_ascii', doc_id, text FROM documents WHERE regexp_matches(text, '[^\\x00-\\x7F]') ORDER BY doc_id LIMIT 3)
UNION ALL (SELECT 'long', doc_id, text FROM documents WHERE length(text) > 300 ORDER BY doc_id LIMIT 3)""")
def first_rows_by_reason(spark, d):
    docs = documents(spark, d)
    reasons = {
        "newline": tx.has_newline("text"),
        "non_ascii": tx.has_non_ascii("text"),
        "long": tx.exceeds("text", au.LONG_CHARS),
    }
    out = None
    for reason, condition in reasons.items():
        part = pf.inspect(docs, condition, "doc_id", "text").withColumn("reason", F.lit(reason))
        out = part if out is None else out.unionByName(part)
    return out


@query(f"""WITH {SQL_EVENT_PREDICTIONS}
SELECT row_id, text, true_label, predicted_label, length(text)::INT AS text_length
FROM event_predictions WHERE true_label <> predicted_label""")
def misclassified_rows(spark, d):
    return error_rows(event_predictions(spark, d), "true_label", "predicted_label", "text").select(
        "row_id", "text", "true_label", "predicted_label", "text_length"
    )


# --- expectations ----------------------------------------------------------------------


@query("""SELECT name, observed, expected, observed = expected AS ok FROM (
  SELECT 'n_sources' AS name, count(DISTINCT source) AS observed, 20::BIGINT AS expected FROM documents
  UNION ALL SELECT 'n_languages', count(DISTINCT lang), 4 FROM documents
  UNION ALL SELECT 'n_null_text', count(*) FILTER (WHERE text IS NULL), 0 FROM documents
  UNION ALL SELECT 'n_duplicate_ids', count(*) - count(DISTINCT doc_id), 0 FROM documents
  UNION ALL SELECT 'n_short_texts', count(*) FILTER (WHERE length(text) < 10), 0 FROM documents)""")
def corpus_expectations(spark, d):
    return expectations(
        documents(spark, d),
        {
            "n_sources": (F.count_distinct("source"), 20),
            "n_languages": (F.count_distinct("lang"), 4),
            "n_null_text": (F.count_if(F.col("text").isNull()), 0),
            "n_duplicate_ids": (F.count("*") - F.count_distinct("doc_id"), 0),
            "n_short_texts": (F.count_if(tx.shorter_than("text", 10)), 0),
        },
    )


@query("""SELECT n_name AS label, count(DISTINCT r_name) AS n_parents, string_agg(DISTINCT r_name, ',') AS parents
FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def parents_of_nations(spark, d):
    nation, region = read_table(spark, d, "nation"), read_table(spark, d, "region")
    pairs = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("label"), "r_name"
    )
    return pf.parents_of(pairs, "label", "r_name")


@query("""SELECT source, count(DISTINCT lang) AS n_parents, string_agg(DISTINCT lang, ',' ORDER BY lang) AS parents
FROM documents GROUP BY 1 HAVING count(DISTINCT lang) > 1""")
def labels_with_several_parents(spark, d):
    return pf.hierarchy_violations(documents(spark, d), "source", "lang")

"""Label distributions, lengths and histograms."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanmark.catalog.inputs import documents, SQL_INJECTED, SQL_SPLIT_DOCUMENTS, SQL_WS, dirty, split_documents, sql_words
from gleanmark.catalog.registry import query
from gleanmark.operators import profile as pf
from gleanmark.plans.profiling import corpus_summary, profile, profile_cells, profile_facts
from gleanmark.sources.tables import read_table

LANGS = ["de", "en", "es", "fr"]


def _events(spark, d):
    return read_table(spark, d, "events")


_SQL_LENGTHS = f"""lengths AS (
  SELECT lang, 'chars' AS measure, length(text)::BIGINT AS length FROM documents
  UNION ALL SELECT lang, 'words', {sql_words('text')} FROM documents)"""
_SQL_STATS = """count(*) AS count, round(avg(length), 4) AS mean, round(stddev_samp(length), 4) AS std,
  min(length) AS min, round(quantile_cont(length, 0.5), 4) AS p50, round(quantile_cont(length, 0.9), 4) AS p90,
  round(quantile_cont(length, 0.95), 4) AS p95, round(quantile_cont(length, 0.99), 4) AS p99, max(length) AS max"""


@query("SELECT source, count(*) AS n FROM documents GROUP BY 1 ORDER BY 2 DESC, 1")
def class_counts(spark, d):
    return pf.class_counts(documents(spark, d), "source").orderBy(F.desc("n"), "source")


@query("""SELECT event_type, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS fraction
FROM events GROUP BY 1""")
def class_fractions(spark, d):
    return pf.class_fractions(_events(spark, d), "event_type")


@query("""SELECT count(*) AS n_classes, min(n) AS min_n, max(n) AS max_n, round(max(n) / greatest(min(n), 1), 2) AS ratio
FROM (SELECT count(*) AS n FROM documents GROUP BY lang)""")
def class_imbalance(spark, d):
    return pf.imbalance(documents(spark, d), "lang")


@query("""SELECT count(*) AS n_classes, round(avg(n), 4) AS mean, round(stddev_samp(n), 4) AS std,
  round(quantile_cont(n, 0.5), 4) AS median, min(n) AS min, max(n) AS max
FROM (SELECT count(*) AS n FROM documents GROUP BY lang || source)""")
def class_count_statistics(spark, d):
    docs = documents(spark, d).select(F.concat("lang", "source").alias("label"))
    return pf.class_count_stats(docs, "label")


@query("""SELECT count(*) AS n_classes, count(*) FILTER (WHERE n < 9) AS n_too_small, min(n) AS min_n,
  round(min(n) * 0.12::DOUBLE, 2) AS expected_of_rarest, count(*) FILTER (WHERE n < 9) = 0 AS feasible
FROM (SELECT count(*) AS n FROM documents GROUP BY lang || source)""")
def stratified_split_feasibility(spark, d):
    docs = documents(spark, d).select(F.concat("lang", "source").alias("label"))
    return pf.split_feasibility(docs, "label")


@query("SELECT lang || source AS label, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) < 9")
def classes_too_small_to_split(spark, d):
    docs = documents(spark, d).select(F.concat("lang", "source").alias("label"))
    return pf.classes_below(docs, "label", pf.MIN_ROWS_FOR_SPLIT)


@query("""SELECT source, count(*) FILTER (WHERE lang = 'de') AS de, count(*) FILTER (WHERE lang = 'en') AS en,
  count(*) FILTER (WHERE lang = 'es') AS es, count(*) FILTER (WHERE lang = 'fr') AS fr,
  count(*) FILTER (WHERE lang IS NULL OR lang NOT IN ('de', 'en', 'es', 'fr')) AS other FROM documents GROUP BY 1""")
def source_by_language(spark, d):
    return pf.crosstab(documents(spark, d), "source", "lang", LANGS)


@query(f"WITH {_SQL_LENGTHS} SELECT measure, {_SQL_STATS} FROM lengths GROUP BY measure")
def length_profile(spark, d):
    return pf.length_profile(documents(spark, d), pf.text_lengths("text"))


@query(f"WITH {_SQL_LENGTHS} SELECT lang, measure, {_SQL_STATS} FROM lengths GROUP BY lang, measure")
def length_profile_by_language(spark, d):
    return pf.length_profile(documents(spark, d), pf.text_lengths("text"), ["lang"])


@query(f"""WITH {_SQL_LENGTHS}, s AS (SELECT {_SQL_STATS} FROM lengths WHERE measure = 'words')
SELECT 'words' AS measure, round(p95 * 1.3::DOUBLE, 1) AS tokens_p95, round(p99 * 1.3::DOUBLE, 1) AS tokens_p99,
  round(max * 1.3::DOUBLE, 1) AS tokens_max FROM s""")
def token_budget(spark, d):
    return pf.token_budget(pf.length_profile(documents(spark, d), pf.text_lengths("text")))


@query(f"""WITH {_SQL_LENGTHS},
bounds AS (SELECT measure, min(length) AS low, max(length) AS high FROM lengths GROUP BY 1),
binned AS (SELECT lang, measure, least((length - low) * 60 // (high - low) + 1, 60) AS bin, low, high FROM lengths JOIN bounds USING (measure))
SELECT lang, measure, bin::BIGINT AS bin, count(*) AS n,
  round(count(*) / sum(count(*)) OVER (PARTITION BY lang, measure) / ((high - low) / 60), 8) AS density
FROM binned GROUP BY lang, measure, bin, low, high""")
def length_histogram(spark, d):
    return pf.fixed_bin_histogram(documents(spark, d), pf.text_lengths("text"), 60, ["lang"])


@query("SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def most_frequent_classes(spark, d):
    return pf.top_classes(read_table(spark, d, "part"), "p_brand", 10)


@query("SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY 2, 1 LIMIT 10")
def least_frequent_classes(spark, d):
    return pf.top_classes(read_table(spark, d, "part"), "p_brand", 10, smallest=True)


# Rounded before it is cut: an interpolated 7915 may be held as 7914.999….
def _sql_side(table: str, text: str, label: str, name: str) -> str:
    lengths = f"(SELECT length({text}) AS c, {sql_words(text)} AS w FROM {table})"
    parts = [
        f"SELECT 'n_rows' AS metric, count(*)::DOUBLE AS {name} FROM {table}",
        f"SELECT 'n_classes', count(DISTINCT {label}) FROM {table}",
        f"SELECT 'imbalance_ratio', round(max(n) / greatest(min(n), 1), 2) FROM (SELECT count(*) AS n FROM {table} GROUP BY {label})",
    ]
    for c, m in (("c", "char"), ("w", "word")):
        parts += [f"SELECT '{m}_{p}', floor(round(quantile_cont({c}, {q}), 4)) FROM {lengths}" for p, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99))]
        parts.append(f"SELECT '{m}_max', max({c}) FROM {lengths}")
    return " UNION ALL ".join(parts)


@query(f"""SELECT metric, documents, conversations
FROM ({_sql_side('documents', 'text', 'source', 'documents')})
JOIN ({_sql_side('conversations', 'text', 'role', 'conversations')}) USING (metric)""")
def two_corpora_side_by_side(spark, d):
    return pf.contrast(
        {
            "documents": (documents(spark, d), "text", "source"),
            "conversations": (read_table(spark, d, "conversations"), "text", "role"),
        }
    )


@query(f"""WITH {SQL_SPLIT_DOCUMENTS}, {_SQL_LENGTHS},
stats AS (SELECT measure, {_SQL_STATS} FROM lengths GROUP BY measure),
wide AS (SELECT measure, count::DOUBLE AS count, mean, std, p50, p90, p95, p99, max::DOUBLE AS max FROM stats),
classes AS (SELECT count(*)::DOUBLE AS n_classes, round(avg(n), 4) AS mean, round(stddev_samp(n), 4) AS std,
  round(quantile_cont(n, 0.5), 4)::DOUBLE AS median, min(n)::DOUBLE AS min, max(n)::DOUBLE AS max FROM (SELECT count(*) AS n FROM documents GROUP BY lang)),
sizes AS (SELECT split, count(*)::DOUBLE AS n, round(count(*) / (SELECT count(*) FROM documents), 4) AS fraction FROM split_documents GROUP BY 1)
SELECT measure || '.' || name AS metric, value FROM wide UNPIVOT (value FOR name IN (count, mean, std, p50, p90, p95, p99, max))
UNION ALL SELECT 'classes.' || name, value FROM classes UNPIVOT (value FOR name IN (n_classes, mean, std, median, min, max))
UNION ALL SELECT 'split.' || split || '.' || name, value FROM sizes UNPIVOT (value FOR name IN (n, fraction))""")
def summary_of_a_split_corpus(spark, d):
    return corpus_summary(split_documents(spark, d), "text", "lang")


@query(f"""WITH wide AS (SELECT count(*) FILTER (WHERE text IS NULL) AS text, count(*) FILTER (WHERE role IS NULL) AS role,
  count(*) FILTER (WHERE conv_id IS NULL) AS conv_id, count(*) FILTER (WHERE turn IS NULL) AS turn,
  count(*) FILTER (WHERE text IS NULL OR role IS NULL OR conv_id IS NULL OR turn IS NULL) AS "(any)",
  count(*) AS n_rows, count(DISTINCT role) AS n_classes, count(*) - count(DISTINCT text) AS duplicate_text FROM conversations)
SELECT "column" AS fact, v AS value FROM wide UNPIVOT (v FOR "column" IN (text, role, conv_id, turn, "(any)", n_rows, n_classes, duplicate_text))""")
def profile_of_conversations(spark, d):
    p = profile(read_table(spark, d, "conversations"), "text", "role")
    return (
        p.nulls.select(F.col("column").alias("fact"), F.col("nulls").alias("value"))
        .unionByName(
            p.audit.where("metric in ('n_rows', 'duplicate_text')").select(F.col("metric").alias("fact"), "value")
        )
        .unionByName(p.imbalance.select(F.lit("n_classes").alias("fact"), F.col("n_classes").alias("value")))
    )


_SQL_FACTS = f"""{SQL_INJECTED},
c AS (SELECT row_id, instruction AS text, intent AS label, category AS parent FROM dirty),
t AS (SELECT *, coalesce(text, '') AS x FROM c),
labels AS (SELECT label, count(*) AS n FROM c WHERE label IS NOT NULL GROUP BY 1),
classes AS (SELECT label, parent, count(*) AS n FROM c WHERE label IS NOT NULL GROUP BY 1, 2),
tag AS (SELECT coalesce(parent, '') AS tags, count(*) AS n FROM c GROUP BY 1),
lengths AS (SELECT 'chars' AS measure, length(x)::BIGINT AS length FROM t UNION ALL SELECT 'words', {sql_words('x')} FROM t),
stats AS (SELECT measure, {_SQL_STATS} FROM lengths GROUP BY measure),
wide AS (SELECT measure, count::DOUBLE AS count, mean, std, min::DOUBLE AS min, p50, p90, p95, p99, max::DOUBLE AS max FROM stats),
bounds AS (SELECT measure, min(length) AS low, max(length) AS high FROM lengths GROUP BY 1),
binned AS (
  SELECT measure, CASE WHEN high = low THEN 1 ELSE least((length - low) * 60 // (high - low) + 1, 60) END::BIGINT AS bin, count(*) AS n
  FROM lengths JOIN bounds USING (measure) GROUP BY 1, 2),
flags AS (
  SELECT unnest(map_entries(MAP {{
    'blank_text': NOT regexp_matches(x, '[^{SQL_WS[1:-1]}]'), 'edge_whitespace': regexp_matches(x, '^{SQL_WS}') OR regexp_matches(x, '{SQL_WS}$'),
    'leading': regexp_matches(x, '^{SQL_WS}'), 'trailing': regexp_matches(x, '{SQL_WS}$'), 'multi_space': contains(x, '  '),
    'has_tab': contains(x, chr(9)), 'has_newline': contains(x, chr(10)), 'non_ascii': strlen(x) <> length(x),
    'mojibake': regexp_matches(x, 'Ã.|â€.|Â.|ï»¿'), 'very_short': length(x) < 10, 'very_long': length(x) > 300}})) AS e
  FROM t),
nulls AS (
  SELECT unnest(map_entries(MAP {{
    'row_id': row_id IS NULL, 'text': text IS NULL, 'label': label IS NULL, 'parent': parent IS NULL,
    '(any)': row_id IS NULL OR text IS NULL OR label IS NULL OR parent IS NULL}})) AS e
  FROM c)
SELECT 'n_rows' AS fact, count(*)::DOUBLE AS value FROM c
UNION ALL SELECT 'duplicate_rows', (SELECT count(*) FROM c) - (SELECT count(*) FROM (SELECT DISTINCT * FROM c))
UNION ALL SELECT 'duplicate_text_label', (SELECT count(*) FROM c) - (SELECT count(*) FROM (SELECT DISTINCT text, label FROM c))
UNION ALL SELECT 'duplicate_text', (SELECT count(*) FROM c) - (SELECT count(*) FROM (SELECT DISTINCT text FROM c))
UNION ALL SELECT 'null.' || e.key, count(*) FILTER (WHERE e.value) FROM nulls GROUP BY 1
UNION ALL SELECT 'flag.' || e.key, count(*) FILTER (WHERE e.value) FROM flags GROUP BY 1
UNION ALL SELECT 'classes.' || name, value FROM (
  SELECT count(*)::DOUBLE AS n_classes, round(avg(n), 4) AS mean, round(stddev_samp(n), 4) AS std, round(quantile_cont(n, 0.5), 4)::DOUBLE AS median,
    min(n)::DOUBLE AS min, max(n)::DOUBLE AS max, round(max(n) / greatest(min(n), 1), 2) AS ratio, (count(*) FILTER (WHERE n < 9))::DOUBLE AS n_too_small,
    round(min(n) * 0.12::DOUBLE, 2) AS expected_of_rarest FROM labels)
  UNPIVOT (value FOR name IN (n_classes, mean, std, median, min, max, ratio, n_too_small, expected_of_rarest))
UNION ALL SELECT measure || '.' || name, value FROM wide UNPIVOT (value FOR name IN (count, mean, std, min, p50, p90, p95, p99, max))
UNION ALL SELECT 'words.tokens_' || name, round(value * 1.3::DOUBLE, 1) FROM wide UNPIVOT (value FOR name IN (p95, p99, max)) WHERE measure = 'words'
UNION ALL SELECT 'tags.n_distinct', count(*) FROM tag
UNION ALL SELECT 'tags.n_empty', coalesce(sum(n) FILTER (WHERE tags = ''), 0) FROM tag
UNION ALL SELECT 'tags.' || tags, n FROM tag
UNION ALL SELECT 'letter.' || letter, sum(n) FROM (SELECT unnest(string_split(tags, '')) AS letter, n FROM tag) WHERE trim(letter) <> '' GROUP BY 1
UNION ALL SELECT 'label.' || label, n FROM labels
UNION ALL SELECT 'label.' || label || '.fraction', round(n / sum(n) OVER (), 6) FROM labels
UNION ALL SELECT 'class.' || label || '|' || parent, n FROM classes
UNION ALL SELECT 'parents.' || label, count(parent) FROM classes GROUP BY 1
UNION ALL SELECT measure || '.bin.' || bin, n FROM binned
UNION ALL SELECT measure || '.bin.' || bin || '.fraction', round(n / sum(n) OVER (PARTITION BY measure), 6) FROM binned"""


@query(f"WITH {_SQL_FACTS}")
def all_facts_of_a_corpus(spark, d):
    """Nulls, audit, repeats, classes, parents, lengths, bins, tokens, tags and letters of a corpus with defects."""
    corpus = dirty(spark, d).select(
        "row_id", F.col("instruction").alias("text"), F.col("intent").alias("label"), F.col("category").alias("parent")
    )
    return profile_facts(profile_cells(corpus, "text", "label", "parent", tags="parent"))

"""Scalar text and label functions over whole columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanmark.catalog.inputs import (
    documents,
    SQL_INJECTED,
    SQL_REPAIRED,
    SQL_WS,
    digit,
    dirty,
    injected,
    sql_collapse,
    sql_digit,
    sql_words,
)
from gleanmark.catalog.registry import query
from gleanmark.functions import labels as lb
from gleanmark.functions import text as tx
from gleanmark.sources.tables import read_table


@query(f"""WITH {SQL_INJECTED}
SELECT row_id, {sql_collapse('instruction')} AS text FROM dirty""")
def collapsed_whitespace(spark, d):
    return dirty(spark, d).select("row_id", tx.collapse_whitespace("instruction").alias("text"))


# Compatibility characters are put in, and normalising must bring the text back.
@query("SELECT doc_id, text FROM documents")
def nfkc_restores_text(spark, d):
    disguised = F.col("text")
    for plain, compatible in [("fi", "ﬁ"), ("fl", "ﬂ"), ("é", "é"), ("A", "Ａ"), ("2", "２"), ("ü", "ü")]:
        disguised = F.replace(disguised, F.lit(plain), F.lit(compatible))
    return documents(spark, d).select("doc_id", tx.nfkc(disguised).alias("text"))


@query(f"""WITH {SQL_INJECTED}
SELECT row_id, {SQL_REPAIRED.format(c='response')} AS response FROM dirty""")
def repaired_mojibake(spark, d):
    return dirty(spark, d).select("row_id", tx.repair_mojibake("response").alias("response"))


@query(f"""WITH {SQL_INJECTED}
SELECT row_id, upper(category) AS upper_label, lower(category) AS lower_label,
       upper(category[1]) || lower(category[2:]) AS title_label FROM dirty""")
def label_case(spark, d):
    return dirty(spark, d).select(
        "row_id",
        F.upper("category").alias("upper_label"),
        F.lower("category").alias("lower_label"),
        tx.title_label("category").alias("title_label"),
    )


@query(f"""WITH {SQL_INJECTED}
SELECT row_id, regexp_matches(instruction, '^{SQL_WS}') AS leading,
       regexp_matches(instruction, '{SQL_WS}$') AS trailing,
       regexp_matches(instruction, '  +') AS multi_space, contains(instruction, chr(9)) AS tab,
       contains(instruction, chr(10)) AS newline
FROM dirty""")
def whitespace_flags(spark, d):
    return dirty(spark, d).select(
        "row_id",
        tx.has_leading_whitespace("instruction").alias("leading"),
        tx.has_trailing_whitespace("instruction").alias("trailing"),
        tx.has_multi_space("instruction").alias("multi_space"),
        tx.has_tab("instruction").alias("tab"),
        tx.has_newline("instruction").alias("newline"),
    )


@query(f"""SELECT doc_id, length(text)::INT AS chars, {sql_words('text')}::INT AS words FROM documents""")
def text_measures(spark, d):
    return documents(spark, d).select(
        "doc_id", F.char_length("text").alias("chars"), tx.word_count("text").alias("words")
    )


@query("""SELECT doc_id, contains(text, 'the') AS has_literal,
       regexp_matches(text, '[^\\x00-\\x7F]') AS non_ascii, regexp_matches(text, '[0-9]{4}') AS has_number
FROM documents""")
def text_predicates(spark, d):
    return documents(spark, d).select(
        "doc_id",
        F.col("text").contains("the").alias("has_literal"),
        tx.has_non_ascii("text").alias("non_ascii"),
        F.col("text").rlike("[0-9]{4}").alias("has_number"),
    )


@query(f"""WITH {SQL_INJECTED}
SELECT coalesce(intent, '') AS intent, count(*) AS n, count(*) FILTER (WHERE coalesce(intent, '') = '') AS n_empty
FROM dirty GROUP BY 1""")
def null_as_empty_text(spark, d):
    t = tx.as_text("intent")
    return (
        dirty(spark, d).groupBy(t.alias("intent")).agg(F.count("*").alias("n"), F.count_if(t == "").alias("n_empty"))
    )


@query("""SELECT p_partkey, array_to_string(list_sort(list_distinct(string_split(lower(replace(p_name, ' ', '_')), '_'))), ',') AS words
FROM part""")
def label_words(spark, d):
    name = F.translate("p_name", " ", "_")
    return read_table(spark, d, "part").select(
        "p_partkey", F.array_join(F.array_sort(lb.label_tokens(name)), ",").alias("words")
    )


@query("""WITH names AS (
  SELECT p_partkey, string_split(p_name, ' ') AS a, string_split(lower(p_type) || ' ' || split_part(p_name, ' ', 2), ' ') AS b
  FROM part)
SELECT p_partkey, round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 4) AS similarity
FROM names""")
def name_similarity(spark, d):
    a = lb.label_tokens(F.translate("p_name", " ", "_"))
    b = lb.label_tokens(F.concat(F.lower("p_type"), F.lit("_"), F.split_part("p_name", F.lit(" "), F.lit(2))))
    return read_table(spark, d, "part").select("p_partkey", lb.round4(lb.jaccard(a, b)).alias("similarity"))


@query("SELECT o_orderkey, round(o_totalprice / 7, 4) AS value FROM orders")
def rounded_to_four_digits(spark, d):
    return spark.read.parquet(f"{d}/orders.parquet").select(
        "o_orderkey", lb.round4(F.col("o_totalprice") / 7).alias("value")
    )


@query(f"""SELECT event_id, CASE WHEN {sql_digit('gap', 'event_id')} < 3 THEN 'UNKNOWN' ELSE event_type END AS true_label,
       CASE WHEN {sql_digit('gap', 'event_id', 2)} < 3 THEN 'PARSE_ERROR' ELSE event_type END AS predicted_label
FROM events""")
def sentinels_for_missing_labels(spark, d):
    def sometimes(position):
        return F.when(digit("gap", "event_id", position) >= 3, F.col("event_type"))

    return read_table(spark, d, "events").select(
        "event_id",
        lb.or_unknown(sometimes(1)).alias("true_label"),
        lb.or_parse_error(sometimes(2)).alias("predicted_label"),
    )


@query("""WITH names AS (
  SELECT replace(p_name, ' ', '_') AS name FROM part
  UNION SELECT c_mktsegment FROM customer UNION SELECT lower(c_mktsegment) || '?' FROM customer
  UNION SELECT p_brand FROM part)
SELECT name FROM names WHERE name <> lower(name) OR NOT regexp_matches(replace(replace(name, '_', ''), '?', ''), '^[a-z_?]+$')""")
def irregular_label_names(spark, d):
    from gleanmark.operators.labelspace import irregular_labels

    part, customer = read_table(spark, d, "part"), read_table(spark, d, "customer")
    names = (
        part.select(F.translate("p_name", " ", "_").alias("name"))
        .unionByName(customer.select(F.col("c_mktsegment").alias("name")))
        .unionByName(customer.select(F.concat(F.lower("c_mktsegment"), F.lit("?")).alias("name")))
        .unionByName(part.select(F.col("p_brand").alias("name")))
    )
    return irregular_labels(names, "name")


@query(f"""WITH {SQL_INJECTED}
SELECT defect, n::BIGINT AS n FROM (
  SELECT count(*) FILTER (WHERE hit_null_label) AS null_label, count(*) FILTER (WHERE hit_whitespace) AS whitespace,
         count(*) FILTER (WHERE hit_case) AS "case", count(*) FILTER (WHERE hit_mojibake) AS mojibake,
         count(*) FILTER (WHERE hit_outlier) AS outlier, count(*) FILTER (WHERE hit_duplicate) AS duplicate
  FROM picked) UNPIVOT (n FOR defect IN (null_label, whitespace, "case", mojibake, outlier, duplicate))""")
def injection_counts(spark, d):
    from gleanmark.operators.inject import injection_report

    return injection_report(injected(spark, d))


@query(f"""WITH {SQL_INJECTED} SELECT * FROM injected""")
def injected_rows(spark, d):
    return injected(spark, d)


@query("""SELECT tag AS letter, count(*) AS n FROM (
  SELECT unnest(string_split(l_returnflag || ' ' || l_linestatus, '')) AS tag FROM lineitem)
WHERE trim(tag) <> '' GROUP BY 1""")
def tag_letter_counts(spark, d):
    from gleanmark.operators.profile import tag_letters

    tagged = spark.read.parquet(f"{d}/lineitem.parquet").select(
        F.concat_ws(" ", "l_returnflag", "l_linestatus").alias("flags")
    )
    return tag_letters(tagged, "flags")


@query("""SELECT tags, count(*) AS n FROM (
  SELECT l_returnflag || l_linestatus || CASE WHEN l_discount > 0.05 THEN 'Q' ELSE '' END AS tags FROM lineitem)
GROUP BY 1 ORDER BY n DESC, tags LIMIT 20""")
def frequent_tags(spark, d):
    from gleanmark.operators.profile import tag_values

    tags = F.concat("l_returnflag", "l_linestatus", F.when(F.col("l_discount") > 0.05, "Q").otherwise(""))
    return tag_values(spark.read.parquet(f"{d}/lineitem.parquet").select(tags.alias("flags")), "flags")


@query("""SELECT count(*) FILTER (WHERE tags = '') AS n_empty, count(DISTINCT tags) AS n_distinct FROM (
  SELECT CASE WHEN l_discount > 0.05 THEN l_returnflag ELSE '' END AS tags FROM lineitem)""")
def empty_tag_strings(spark, d):
    from gleanmark.operators.profile import empty_tags

    tags = F.when(F.col("l_discount") > 0.05, F.col("l_returnflag"))
    return empty_tags(spark.read.parquet(f"{d}/lineitem.parquet").select(tags.alias("flags")), "flags")

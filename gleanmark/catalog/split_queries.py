"""Stratified splits, their checks, leakage, and label vocabularies."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanmark.catalog.inputs import documents, SQL_SPLIT_DOCUMENTS, split_documents, sql_collapse
from gleanmark.catalog.registry import query
from gleanmark.functions.keys import content_key
from gleanmark.operators import containment as ct
from gleanmark.operators import labelspace as ls
from gleanmark.operators import leakage as lk
from gleanmark.operators import profile as pf
from gleanmark.operators import split as sp
from gleanmark.operators.dedup import keep_first
from gleanmark.operators.report import content_fingerprint
from gleanmark.plans import splitting as pl
from gleanmark.plans.cleaning import normalise_columns
from gleanmark.session import stage
from gleanmark.sources.tables import read_table, union_splits

SPLITS = ["train", "val", "test"]


def _sql_keep(source: str, n: str, fraction: float, out: str, left: str, name: str) -> str:
    """One round of largest-remainder quotas."""
    return f"""{name} AS (
  SELECT * EXCLUDE (t, k, w, r), w + CASE WHEN row_number() OVER (ORDER BY r DESC, grp) <= k - sum(w) OVER () THEN 1 ELSE 0 END AS {out},
         {n} - {out} AS {left}
  FROM (SELECT *, (k * {n}::HUGEINT) // t AS w, (k * {n}::HUGEINT) % t AS r
        FROM (SELECT *, sum({n}) OVER () AS t, sum({n}) OVER () - ceil({fraction}::DOUBLE * sum({n}) OVER ())::HUGEINT AS k FROM {source})))"""


def sql_three_way(source: str, label: str, row_id: str, out: str) -> str:
    """``source`` plus ``split``: 75% train, then 40/60 of the rest to val and test."""
    return f"""{out}_n AS (SELECT {label} AS grp, count(*) AS n FROM {source} GROUP BY 1),
{_sql_keep(f'{out}_n', 'n', 0.25, 'keep0', 'left0', f'{out}_q0')},
{_sql_keep(f'{out}_q0', 'left0', 0.60, 'keep1', 'left1', f'{out}_q1')},
{out} AS (
  SELECT s.* EXCLUDE (place), CASE WHEN place <= left1 THEN 'test' WHEN place <= left0 THEN 'val' ELSE 'train' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY md5('42:' || {row_id})) AS place FROM {source}) s
  JOIN {out}_q1 q ON s.{label} = q.grp)"""


def sql_two_way(source: str, label: str, row_id: str, out: str) -> str:
    return f"""{out}_n AS (SELECT {label} AS grp, count(*) AS n FROM {source} GROUP BY 1),
{_sql_keep(f'{out}_n', 'n', 0.12, 'keep0', 'left0', f'{out}_q0')},
{out} AS (
  SELECT s.* EXCLUDE (place), CASE WHEN place <= left0 THEN 'val' ELSE 'train' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY md5('42:' || {row_id})) AS place FROM {source}) s
  JOIN {out}_q0 q ON s.{label} = q.grp)"""


_SQL_CLEAN = f"""clean AS (
  SELECT doc_id, text, lang, source FROM (
    SELECT *, row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) AS place
    FROM (SELECT doc_id, {sql_collapse('text')} AS text, lang, source FROM documents)) WHERE place = 1)"""


def _clean(spark, d):
    docs = documents(spark, d).select("doc_id", "text", "lang", "source")
    cleaned = normalise_columns(docs, ["text"]).withColumn("_content", content_key("text", "lang"))
    cleaned = stage(cleaned, "normalised")
    return keep_first(cleaned, ["text", "lang"], "doc_id", hashed="_content").drop("_content")


# --- splits -----------------------------------------------------------------------


@query(f"""WITH {_SQL_CLEAN}, {sql_three_way('clean', 'source', 'doc_id', 'parts')}
SELECT source, split, count(*) AS n FROM parts GROUP BY ALL""")
def clean_split_sizes(spark, d):
    """Normalise, keep first copies, split exactly by source, and count."""
    parts = sp.stratified_split(_clean(spark, d), "source", "doc_id", pl.THREE_WAY)
    return sp.class_balance(parts, "source")


@query(f"""WITH {sql_three_way('documents', 'source', 'doc_id', 'parts')}
SELECT doc_id, source, split FROM parts""")
def three_way_stratified_split(spark, d):
    return sp.stratified_split(
        documents(spark, d).select("doc_id", "source"), "source", "doc_id", pl.THREE_WAY
    )


@query(f"""WITH train AS (SELECT * FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
{sql_two_way('train', 'lang', 'doc_id', 'parts')}
SELECT doc_id, lang, split FROM parts
UNION ALL SELECT doc_id, lang, 'test' FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)""")
def split_with_pinned_test(spark, d):
    docs = documents(spark, d).select("doc_id", "lang")
    pinned = read_table(spark, d, "labels").select("doc_id")
    return pl.split_with_pinned_test(
        docs.join(pinned, "doc_id", "left_anti"), docs.join(pinned, "doc_id", "left_semi"), "lang", "doc_id"
    )


@query(f"""WITH {sql_three_way('events', 'event_type', 'event_id', 'parts')}
SELECT split, event_type, count(*) AS n FROM parts GROUP BY ALL""")
def class_balance_of_events(spark, d):
    events = read_table(spark, d, "events").select("event_id", "event_type")
    return sp.class_balance(sp.stratified_split(events, "event_type", "event_id", pl.THREE_WAY), "event_type")


@query(f"""WITH {SQL_SPLIT_DOCUMENTS}
SELECT split, count(*) AS n, round(count(*) / (SELECT count(*) FROM documents), 4) AS fraction
FROM split_documents GROUP BY split""")
def split_sizes_and_fractions(spark, d):
    return sp.split_sizes(split_documents(spark, d))


@query(f"""WITH {_SQL_CLEAN}, {sql_three_way('clean', 'source', 'doc_id', 'parts')},
overall AS (SELECT source, count(*) / (SELECT count(*) FROM parts) AS f FROM parts GROUP BY 1),
grid AS (SELECT split, o.source, o.f FROM overall o, (SELECT DISTINCT split FROM parts)),
own AS (SELECT split, source, count(*) / (SELECT count(*) FROM parts q WHERE q.split = p.split) AS f FROM parts p GROUP BY 1, 2),
drift AS (SELECT split, max(abs(coalesce(own.f, 0) - grid.f)) AS m FROM grid LEFT JOIN own USING (split, source) GROUP BY split),
pairs(a, b) AS (VALUES ('train', 'val'), ('train', 'test'), ('val', 'test'))
SELECT 'conservation' AS "check", 'all' AS subject, (SELECT count(*) FROM parts)::DOUBLE AS value,
       (SELECT count(*) FROM parts) = (SELECT count(*) FROM clean) AS ok
UNION ALL SELECT 'missing_classes', 'all', count(*) FILTER (WHERE own.f IS NULL), count(*) FILTER (WHERE own.f IS NULL) = 0
FROM grid LEFT JOIN own USING (split, source)
UNION ALL SELECT 'class_drift', split, round(m, 6), m < 0.02 FROM drift
UNION ALL SELECT 'overlap', a || '-' || b, n, n = 0 FROM (
  SELECT a, b, (SELECT count(*) FROM (SELECT text, source FROM parts WHERE split = a INTERSECT SELECT text, source FROM parts WHERE split = b))::DOUBLE AS n FROM pairs)""")
def split_and_check(spark, d):
    return pl.split_and_check(_clean(spark, d), "text", "source", "doc_id").checks


@query(f"""WITH {SQL_SPLIT_DOCUMENTS}
SELECT split, lang FROM (SELECT DISTINCT split FROM split_documents), (SELECT DISTINCT lang || source AS lang FROM documents)
EXCEPT SELECT split, lang || source FROM split_documents""")
def classes_missing_from_a_split(spark, d):
    docs = split_documents(spark, d).withColumn("lang", F.concat("lang", "source"))
    return sp.missing_classes(docs, "lang", "split", SPLITS)


@query(f"""WITH {SQL_SPLIT_DOCUMENTS},
own AS (SELECT split, source, count(*) AS n FROM split_documents GROUP BY 1, 2),
grid AS (SELECT split, source FROM (SELECT DISTINCT split FROM own), (SELECT DISTINCT source FROM own)),
shares AS (
  SELECT split, source, coalesce(n, 0) / sum(coalesce(n, 0)) OVER (PARTITION BY split)
         - sum(coalesce(n, 0)) OVER (PARTITION BY source) / sum(coalesce(n, 0)) OVER () AS change
  FROM grid LEFT JOIN own USING (split, source))
SELECT split, round(max(abs(change)), 6) AS max_change, max(abs(change)) < 0.02 AS ok FROM shares GROUP BY split""")
def class_drift_of_random_split(spark, d):
    return sp.class_drift(split_documents(spark, d), "source", "split", SPLITS)


@query(f"""WITH {SQL_SPLIT_DOCUMENTS}
SELECT count(*) AS n_input, (SELECT count(*) FROM split_documents) AS n_split,
  (SELECT count(split) FROM split_documents) AS n_assigned, count(*) = (SELECT count(split) FROM split_documents) AS ok FROM documents""")
def split_conservation(spark, d):
    return sp.conservation(documents(spark, d), split_documents(spark, d))


@query(f"""WITH {SQL_SPLIT_DOCUMENTS}
SELECT * EXCLUDE (place) FROM (
  SELECT doc_id, lang, split, row_number() OVER (PARTITION BY split ORDER BY doc_id) AS place FROM split_documents)
WHERE place <= 50""")
def first_rows_of_each_split(spark, d):
    return pf.first_per_split(split_documents(spark, d).select("doc_id", "lang", "split"), "split", "doc_id", 50)


@query("SELECT doc_id, lang FROM documents ORDER BY md5('7:' || doc_id), doc_id LIMIT 25")
def seeded_sample(spark, d):
    return ls.sample_rows(documents(spark, d).select("doc_id", "lang"), "doc_id", 25, seed=7)


# --- leakage ------------------------------------------------------------------------


@query(f"""WITH {SQL_SPLIT_DOCUMENTS}, pairs(a, b) AS (VALUES ('train', 'val'), ('train', 'test'), ('val', 'test'))
SELECT a || '-' || b AS pair, (SELECT count(*) FROM (
  SELECT text, lang FROM split_documents WHERE split = a INTERSECT SELECT text, lang FROM split_documents WHERE split = b)) AS n_shared
FROM pairs""")
def split_overlap(spark, d):
    return lk.overlap_counts(split_documents(spark, d), ["text", "lang"], "split", SPLITS)


@query(f"""WITH {SQL_SPLIT_DOCUMENTS}
SELECT text FROM split_documents WHERE split = 'train' INTERSECT SELECT text FROM split_documents WHERE split = 'test'""")
def texts_shared_by_train_and_test(spark, d):
    docs = split_documents(spark, d)
    return lk.shared_texts(docs.where("split = 'train'"), docs.where("split = 'test'"), "text")


_SQL_LEAKS = f"""{SQL_SPLIT_DOCUMENTS},
flags AS (SELECT text, lang, bool_or(split = 'val') AS v, bool_or(split = 'test') AS t FROM split_documents GROUP BY 1, 2),
tagged AS (
  SELECT doc_id, text, lang, source, split,
         CASE WHEN split = 'train' AND v THEN 'val' WHEN split IN ('train', 'val') AND t THEN 'test' END AS leaks_into
  FROM split_documents JOIN flags USING (text, lang))"""


@query(f"WITH {_SQL_LEAKS} SELECT doc_id, text, lang, source, split FROM tagged WHERE leaks_into IS NULL")
def leakage_removed(spark, d):
    return lk.drop_leakage(split_documents(spark, d), ["text", "lang"], "split")


@query(f"""WITH {_SQL_LEAKS},
n AS (SELECT count(*) FILTER (WHERE split = 'train') AS train, count(*) FILTER (WHERE split = 'val') AS val,
  count(*) FILTER (WHERE split = 'train' AND leaks_into = 'val') AS tv,
  count(*) FILTER (WHERE split = 'train' AND leaks_into = 'test') AS tt,
  count(*) FILTER (WHERE split = 'val' AND leaks_into = 'test') AS vt FROM tagged)
SELECT 'train' AS split, 'drop_leakage_vs_val' AS step, train AS rows_before, train - tv AS rows_after, tv AS dropped FROM n
UNION ALL SELECT 'train', 'drop_leakage_vs_test', train - tv, train - tv - tt, tt FROM n
UNION ALL SELECT 'val', 'drop_leakage_vs_test', val, val - vt, vt FROM n""")
def leakage_log(spark, d):
    return pl.leakage_log(lk.tag_leakage(split_documents(spark, d), ["text", "lang"], "split"))


@query(f"""WITH {_SQL_LEAKS}, kept AS (SELECT * FROM tagged WHERE leaks_into IS NULL),
pairs(a, b) AS (VALUES ('train', 'val'), ('train', 'test'), ('val', 'test'))
SELECT a || '-' || b AS pair, (SELECT count(*) FROM (
  SELECT text, lang FROM kept WHERE split = a INTERSECT SELECT text, lang FROM kept WHERE split = b)) AS n_shared FROM pairs""")
def overlap_after_leakage_removal(spark, d):
    return pl.remove_leakage(split_documents(spark, d), ["text", "lang"]).overlap_after


@query(f"""WITH {SQL_SPLIT_DOCUMENTS},
held AS (SELECT text, lang, bool_or(split = 'train') AS a, bool_or(split = 'val') AS b, bool_or(split = 'test') AS c
  FROM split_documents GROUP BY 1, 2)
SELECT text, lang, array_to_string(list_filter([CASE WHEN a THEN 'train' END, CASE WHEN b THEN 'val' END, CASE WHEN c THEN 'test' END],
  lambda x: x IS NOT NULL), ',') AS splits
FROM held WHERE a::INT + b::INT + c::INT > 1""")
def leaked_rows(spark, d):
    return lk.leak_rows(split_documents(spark, d), "text", "lang", "split", SPLITS)


_SQL_SETTLED = f"""{SQL_SPLIT_DOCUMENTS},
placed AS (
  SELECT *, row_number() OVER (PARTITION BY text, lang, split ORDER BY doc_id) AS place,
    bool_or(split = 'val') OVER (PARTITION BY text, lang) AS v, bool_or(split = 'test') OVER (PARTITION BY text, lang) AS t
  FROM split_documents),
settled AS (
  SELECT *, CASE WHEN place > 1 THEN 'dedup_keys' WHEN split = 'train' AND v THEN 'drop_leakage_vs_val'
    WHEN split IN ('train', 'val') AND t THEN 'drop_leakage_vs_test' END AS step
  FROM placed)"""


@query(f"WITH {_SQL_SETTLED} SELECT doc_id, lang, source, split FROM settled WHERE step IS NULL")
def copies_settled_across_splits(spark, d):
    """First rows within splits and no leakage between them, from one table of keys."""
    return pl.settle_copies(split_documents(spark, d), ["text", "lang"], "doc_id").rows.drop("text")


@query(f"""WITH {_SQL_SETTLED},
steps(split, step, k) AS (VALUES ('train', 'dedup_keys', 0), ('val', 'dedup_keys', 0), ('test', 'dedup_keys', 0),
  ('train', 'drop_leakage_vs_val', 1), ('train', 'drop_leakage_vs_test', 2), ('val', 'drop_leakage_vs_test', 1)),
counted AS (
  SELECT s.split, s.step, k, count(*) FILTER (WHERE d.split = s.split AND d.step IS NOT DISTINCT FROM s.step) AS dropped,
    count(*) FILTER (WHERE d.split = s.split) AS n FROM steps s CROSS JOIN settled d GROUP BY ALL)
SELECT split, step, (n - coalesce(sum(dropped) OVER before, 0))::BIGINT AS rows_before,
  (n - coalesce(sum(dropped) OVER before, 0) - dropped)::BIGINT AS rows_after, dropped
FROM counted WINDOW before AS (PARTITION BY split ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def log_of_copies_settled(spark, d):
    return pl.settle_copies(split_documents(spark, d), ["text", "lang"], "doc_id").log


@query(f"""WITH {SQL_SPLIT_DOCUMENTS}, pairs(a, b) AS (VALUES ('train', 'val'), ('train', 'test'), ('val', 'test'))
SELECT phase, a || '-' || b AS pair, CASE WHEN phase = 'after' THEN 0 ELSE (SELECT count(*) FROM (
  SELECT text, lang FROM split_documents WHERE split = a INTERSECT SELECT text, lang FROM split_documents WHERE split = b)) END AS n_shared
FROM pairs, (VALUES ('before'), ('after')) AS p(phase)""")
def overlap_before_and_after_settling(spark, d):
    done = pl.settle_copies(split_documents(spark, d), ["text", "lang"], "doc_id")
    before = done.overlap_before.withColumn("phase", F.lit("before"))
    return before.unionByName(done.overlap_after.withColumn("phase", F.lit("after")))


_SQL_PINNED = f"""corpus AS (
  SELECT 'd' || doc_id AS id, {sql_collapse('text')} AS text FROM documents
  UNION ALL SELECT 'b' || item_id, {sql_collapse('text')} FROM benchmark),
pinned AS (SELECT DISTINCT {sql_collapse('text')} AS text FROM benchmark)"""


@query(f"""WITH {_SQL_PINNED}
SELECT id, text FROM corpus WHERE text NOT IN (SELECT text FROM pinned)""")
def training_rows_outside_benchmark(spark, d):
    """Documents and benchmark items as training rows, the benchmark pinned as the test set."""
    items = read_table(spark, d, "benchmark")
    docs = documents(spark, d).select(F.concat(F.lit("d"), "doc_id").alias("id"), "text")
    train = docs.unionByName(items.select(F.concat(F.lit("b"), "item_id").alias("id"), "text"))
    both = union_splits({"train": train, "test": items.select(F.concat(F.lit("t"), "item_id").alias("id"), "text")})
    clean = normalise_columns(both, ["text"])
    return lk.drop_leakage(clean, ["text"], "split", ("test", "train")).where("split = 'train'").drop("split")


@query(f"""WITH {_SQL_PINNED}
SELECT (SELECT count(*) FROM documents) AS n_documents, (SELECT count(*) FROM pinned) AS n_pinned,
  (SELECT count(*) FROM documents WHERE {sql_collapse('text')} IN (SELECT text FROM pinned)) AS n_contaminated""")
def benchmark_contamination(spark, d):
    both = union_splits(
        {
            "train": documents(spark, d).select("text"),
            "test": read_table(spark, d, "benchmark").select("text").distinct(),
        }
    )
    tagged = lk.tag_leakage(normalise_columns(both, ["text"]), ["text"], "split", ("test", "train"))
    return tagged.agg(
        F.count_if(F.col("split") == "train").alias("n_documents"),
        F.count_if(F.col("split") == "test").alias("n_pinned"),
        F.count_if(F.col("leaks_into") == "test").alias("n_contaminated"),
    )


@query(f"""WITH d AS (SELECT doc_id, list_filter(string_split(lower({sql_collapse('text')}), ' '), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(string_split(lower({sql_collapse('text')}), ' '), lambda x: x <> '') AS w FROM benchmark),
dg AS (SELECT doc_id, p, array_to_string(w[p + 1:p + 5], ' ') AS g FROM (SELECT doc_id, w, unnest(range(len(w) - 4)) AS p FROM d)),
bg AS (SELECT item_id, n, q, array_to_string(w[q + 1:q + 5], ' ') AS g FROM (SELECT item_id, w, len(w) AS n, unnest(range(len(w) - 4)) AS q FROM b)),
met AS (SELECT doc_id, item_id, n, p, p - q AS shift FROM dg JOIN bg USING (g)),
runs AS (
  SELECT doc_id, item_id, n, min(p) AS start, count(*) + 4 AS run
  FROM (SELECT *, p - row_number() OVER (PARTITION BY doc_id, item_id, shift ORDER BY p) AS island FROM met)
  GROUP BY doc_id, item_id, n, shift, island),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY run DESC, start) AS place FROM runs WHERE 10 * run >= 8 * n)
SELECT doc_id, item_id, start::INT AS start, run::INT AS n_words, round(run / n, 4) AS share FROM best WHERE place = 1""")
def benchmark_items_in_documents(spark, d):
    """Every benchmark item of which a document holds four fifths or more in one piece."""
    docs, items = documents(spark, d).select("doc_id", "text"), read_table(spark, d, "benchmark")
    return ct.contained_items(docs, items, "doc_id", "item_id")


@query("""SELECT count(*) AS n_rows, lang,
  sum(('0x' || substr(h, 1, 8))::BIGINT)::BIGINT || '-' || sum(('0x' || substr(h, 9, 8))::BIGINT)::BIGINT || '-' ||
  sum(('0x' || substr(h, 17, 8))::BIGINT)::BIGINT || '-' || sum(('0x' || substr(h, 25, 8))::BIGINT)::BIGINT AS fingerprint
FROM (SELECT lang, sha256(length(doc_id::VARCHAR) || ':' || doc_id || '|' || length(n_chars::VARCHAR) || ':' || n_chars || '|' ||
  length(source) || ':' || source || '|' || length(text) || ':' || text) AS h FROM documents) GROUP BY lang""")
def content_fingerprints(spark, d):
    return content_fingerprint(documents(spark, d), ["lang"])


# --- label vocabularies -----------------------------------------------------------------


@query("""SELECT c_custkey, n_name AS resolved_label FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def resolved_integer_labels(spark, d):
    dictionary = read_table(spark, d, "nation").select(
        F.col("n_nationkey").alias("label"), F.col("n_name").alias("label_name")
    )
    rows = read_table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("label"))
    return ls.resolve_label(rows, dictionary).select("c_custkey", "resolved_label")


@query("""SELECT s_suppkey, n_name AS label_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""")
def dictionary_lookup(spark, d):
    dictionary = read_table(spark, d, "nation").select(
        F.col("n_nationkey").alias("label"), F.col("n_name").alias("label_name")
    )
    return ls.with_label_name(read_table(spark, d, "supplier"), dictionary, "s_nationkey").select(
        "s_suppkey", "label_name"
    )


@query("""SELECT p_partkey, label_id::INT AS label_id, p_brand AS decoded FROM part JOIN (
  SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS label_id FROM (SELECT DISTINCT p_brand FROM part)) USING (p_brand)""")
def label_space_round_trip(spark, d):
    part = read_table(spark, d, "part").select("p_partkey", "p_brand")
    space = ls.label_space(part, "p_brand")
    encoded = ls.encode(part, space, "p_brand").drop("p_brand")
    return encoded.join(space.withColumnRenamed("label", "decoded"), "label_id").select(
        "p_partkey", "label_id", "decoded"
    )


@query("""SELECT p_partkey, label_index::INT AS label_index FROM part JOIN (
  SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS label_index FROM (SELECT DISTINCT p_brand FROM part)) USING (p_brand)""")
def label_ids_by_indexer(spark, d):
    from gleanmark.operators.model import label_indexer

    part = read_table(spark, d, "part").select("p_partkey", "p_brand")
    indexed = label_indexer("p_brand").fit(part).transform(part)
    return indexed.select("p_partkey", F.col("label_index").cast("int").alias("label_index"))


_SQL_SIDES = f"""{SQL_SPLIT_DOCUMENTS},
a AS (SELECT DISTINCT lang || source AS label FROM split_documents WHERE split = 'train'),
b AS (SELECT DISTINCT lang || source AS label FROM split_documents WHERE split = 'val'),
c AS (SELECT DISTINCT lang || source AS label FROM split_documents WHERE split = 'test')"""


def _sides(spark, d):
    docs = split_documents(spark, d).select("split", F.concat("lang", "source").alias("label"))
    return [docs.where(F.col("split") == s).select("label") for s in SPLITS]


@query(f"WITH {_SQL_SIDES} SELECT label FROM a UNION SELECT label FROM b UNION SELECT label FROM c ORDER BY 1")
def labels_in_any_split(spark, d):
    return ls.union_of_labels(_sides(spark, d), "label")


@query(f"WITH {_SQL_SIDES} SELECT label FROM a INTERSECT SELECT label FROM b")
def labels_in_both_splits(spark, d):
    a, b, _ = _sides(spark, d)
    return ls.common_labels(a, b, "label")


@query(f"WITH {_SQL_SIDES} SELECT label FROM a EXCEPT SELECT label FROM c")
def labels_only_in_train(spark, d):
    a, _, c = _sides(spark, d)
    return ls.only_in_first(a, c, "label")


@query(f"""WITH {_SQL_SIDES}
SELECT (SELECT count(*) FROM (SELECT label FROM a EXCEPT SELECT label FROM c)) AS only_first,
  (SELECT count(*) FROM (SELECT label FROM c EXCEPT SELECT label FROM a)) AS only_second,
  NOT EXISTS (SELECT label FROM a EXCEPT SELECT label FROM c) AND NOT EXISTS (SELECT label FROM c EXCEPT SELECT label FROM a) AS equal""")
def vocabularies_equal(spark, d):
    a, _, c = _sides(spark, d)
    return ls.same_labels(a, c, "label")


@query("""WITH names AS (SELECT DISTINCT replace(p_name, ' ', '_') || '_' || lower(p_type) AS name FROM part),
words AS (SELECT name, list_distinct(string_split(name, '_')) AS w FROM names)
SELECT a.name AS a, b.name AS b,
  round(len(list_intersect(a.w, b.w)) / len(list_distinct(list_concat(a.w, b.w))), 4) AS jaccard
FROM words a JOIN words b ON a.name < b.name AND len(list_intersect(a.w, b.w)) > 0
ORDER BY len(list_intersect(a.w, b.w)) / len(list_distinct(list_concat(a.w, b.w))) DESC, a, b LIMIT 10""")
def similar_label_names(spark, d):
    names = read_table(spark, d, "part").select(
        F.concat_ws("_", F.translate("p_name", " ", "_"), F.lower("p_type")).alias("name")
    )
    return ls.similar_labels(names, "name", 10)


@query(f"""SELECT doc_id, text, lang, source, split FROM (WITH {SQL_SPLIT_DOCUMENTS} SELECT * FROM split_documents)""")
def all_splits_as_one_table(spark, d):
    docs = split_documents(spark, d)
    return union_splits({s: docs.where(F.col("split") == s).drop("split") for s in SPLITS})

"""The registered queries of the training-data operators, with DuckDB SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanmark.llm import (
    alignment,
    bpe,
    html_text,
    minhash,
    mixing,
    quality,
    resampling,
    sharding,
    token_counts,
    training_order,
    url_filter,
    vector_dedup,
    vector_search,
)
from gleanmark.llm.common import read


def op1_quality_classifier(spark, d):
    """Quality of every document; SQL cannot express the fit."""
    docs = read(spark, d, "documents").select("doc_id", "text")
    return quality.scored_documents(docs, read(spark, d, "labels").select("doc_id", "quality"))


def op2_url_filters(spark, d):
    pages = read(spark, d, "pages").select("page_id", "url")
    return url_filter.judged(pages, url_filter.rule_table(spark)).drop("url")


def op3_html_extraction(spark, d):
    """Main text of every page; tested against marked articles."""
    return html_text.page_texts(read(spark, d, "pages").select("page_id", "url", "html"))


def op4_bpe(spark, d):
    """Ids and decoded text of every document as digests; tested against the library."""
    return bpe.encoded_documents(read(spark, d, "documents").select("doc_id", "text"))


def op5_mixing(spark, d):
    mixed = mixing.mix(read(spark, d, "documents").select("doc_id", "source", "text"))
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken")


def op6_token_counts(spark, d):
    """Token counts of every document; tested against the library."""
    return token_counts.token_counts(read(spark, d, "documents").select("doc_id", "text"))


def op7_training_order(spark, d):
    """Every record of the shards, its tokens as a digest; tested by an exact round trip."""
    records = training_order.training_order(read(spark, d, "documents").select("doc_id", "text"))
    return records.withColumn("tokens_sha256", F.sha2("tokens", 256)).drop("tokens")


def op8_embedding_near_dedup(spark, d):
    return vector_dedup.near_duplicate_vectors(read(spark, d, "embeddings").select("vec_id", "label", "embedding"))


def op9_nearest_neighbours(spark, d):
    """Neighbours of every twentieth vector; recall is tested against brute force."""
    vectors = read(spark, d, "embeddings").select("vec_id", "embedding")
    return vector_search.nearest(vectors, F.col("vec_id") % 20 == 0)


def op10_minhash_near_dedup(spark, d):
    return minhash.near_duplicates(read(spark, d, "documents").select("doc_id", "text"))


def op11_sharding(spark, d):
    """Place of every document in the shuffled shards."""
    placed = sharding.sharded(read(spark, d, "documents"))
    return placed.select(
        "row.doc_id",
        sharding.size_of(F.col("row.text")).alias("size"),
        sharding.checksum(F.col("row.text")).alias("text_crc32"),
        F.lit(sharding.LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op12_importance_resampling(spark, d):
    docs, target = read(spark, d, "documents").select("doc_id", "text"), read(spark, d, "benchmark").select("text")
    return resampling.resample(docs, target)


def op13_tokenizer_alignment(spark, d):
    """Links of two tokenizers per document; tested against a plain alignment."""
    return alignment.align(read(spark, d, "documents").select("doc_id", "text"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_classifier, op2_url_filters, op3_html_extraction, op4_bpe, op5_mixing, op6_token_counts,
        op7_training_order, op8_embedding_near_dedup, op9_nearest_neighbours, op10_minhash_near_dedup,
        op11_sharding, op12_importance_resampling, op13_tokenizer_alignment,
    )
}

_ASCII = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_REACH = """reach AS (
  SELECT a AS node, b FROM both_ways UNION SELECT r.node, w.b FROM reach r JOIN both_ways w ON w.a = r.b),
components AS (SELECT node, least(node, min(b)) AS component FROM reach GROUP BY node)"""

# CRC-32 of the UTF-8 bytes of a text, from its reflected polynomial.
_CRC_TABLE = """crc_table AS (
  SELECT list(r ORDER BY i) AS crc_list FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS r
    FROM range(256) t(i)))"""


def _sql_crc(text: str) -> str:
    data = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    step = "lambda c, v: xor(c >> 8, crc_list[xor(c, v) % 256 + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, {data}), {step}), 4294967295)::BIGINT"


def _sql_hash60(name: str) -> str:
    return f"('0x' || substr(md5({name}), 1, 15))::BIGINT"


_RULES = ", ".join(f"('{verdict}', '{rule}')" for verdict, rule in url_filter.RULES)

SQL = {
    "op2_url_filters": rf"""WITH rules AS (
  SELECT verdict, rule, split_part(rule, '/', 1) AS h, substr(rule, length(split_part(rule, '/', 1)) + 1) AS p
  FROM (VALUES {_RULES}) AS t(verdict, rule)),
rest AS (SELECT page_id, url, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
hosts AS (SELECT *, regexp_extract(r, '^[^/?#]*') AS raw FROM rest),
paths AS (SELECT page_id, translate(raw, {_ASCII}) AS host, regexp_extract(substr(r, length(raw) + 1), '^[^?#]*') AS path, row_number() OVER () AS n FROM hosts),
best AS (
  SELECT n, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM paths JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, '{url_filter.UNLISTED}') AS verdict FROM paths LEFT JOIN best USING (n)""",
    "op5_mixing": rf"""WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    list_extract({list(mixing.WEIGHTS)}, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)}) AS w
  FROM sized GROUP BY source),
levels AS (
  SELECT *, 2 * source_size AS cap, (2 * source_size)::DOUBLE / w AS turn,
    ({mixing.SHARE}::DOUBLE * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER before, 0)::DOUBLE)
      / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
  FROM sources WINDOW before AS (ORDER BY (2 * source_size)::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
final AS (SELECT level FROM levels WHERE w * level <= cap ORDER BY turn, source NULLS LAST LIMIT 1),
targets AS (
  SELECT source, source_size, least(cap::DOUBLE, coalesce(w * (SELECT level FROM final), cap::DOUBLE)) AS target FROM levels),
budget AS (SELECT floor(sum(target) + 1e-6) AS b FROM targets),
placed AS (
  SELECT s.*, t.source_size, t.target, row_number() OVER () AS n,
    sum(size) OVER (PARTITION BY s.source ORDER BY key, s.doc_id NULLS LAST, size ROWS UNBOUNDED PRECEDING)::BIGINT AS cum
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
copies AS (
  SELECT *, (cum + e * source_size)::DOUBLE / target AS time FROM placed, (VALUES (0), (1)) AS v(e)
  WHERE size > 0 AND cum - size + e * source_size < target),
queue AS (
  SELECT n, size, sum(size) OVER (ORDER BY time NULLS LAST, key, doc_id NULLS LAST, source NULLS LAST, e, cum ROWS UNBOUNDED PRECEDING) AS upto
  FROM copies),
taken AS (SELECT n, sum(size)::BIGINT AS taken FROM queue, budget WHERE upto <= b GROUP BY n)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM placed LEFT JOIN taken USING (n)""",
    "op8_embedding_near_dedup": f"""WITH RECURSIVE good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
both_ways AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= {vector_dedup.COSINE}),
links AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a),
{_REACH}
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(component, vec_id) AS component_id, coalesce(component, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN links ON a = vec_id LEFT JOIN components ON node = vec_id""",
    "op10_minhash_near_dedup": rf"""WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_ASCII}), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
both_ways AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= {minhash.PERCENT} * (x.n + y.n - k)),
{_REACH}
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component, doc_id) AS component_id, coalesce(component, doc_id) = doc_id AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN components ON node = doc_id""",
    "op11_sharding": f"""WITH RECURSIVE {_CRC_TABLE},
sized AS (
  SELECT doc_id, text, coalesce(strlen(text), 0)::BIGINT + 1 AS size, {_sql_crc("coalesce(text, '')")} AS text_crc32,
    {_sql_hash60(f"'{sharding.SEED}:' || coalesce('=' || doc_id, '-') || ':' || coalesce('=' || text, '-')")} AS h
  FROM documents, crc_table),
numbered AS (SELECT *, row_number() OVER (PARTITION BY h) - 1 AS copy, count(*) OVER () AS n, sum(size) OVER () AS total FROM sized),
hashed AS (SELECT * REPLACE (CASE WHEN copy > 0 THEN {_sql_hash60("h || ':' || copy")} ELSE h END AS h), greatest(1, ceil(total / {sharding.BUCKET_BYTES}.0))::BIGINT AS buckets FROM numbered),
dealt AS (SELECT *, ((h >> 30) * buckets) >> 30 AS bucket FROM hashed),
held AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY h) - 1 AS place FROM dealt),
steps(bucket, i, ord) AS (
  SELECT bucket, count(*) - 1, range(count(*)) FROM held GROUP BY bucket
  UNION ALL
  SELECT bucket, i - 1, list_transform(ord, lambda x, p: CASE WHEN p = i + 1 THEN ord[j + 1] WHEN p = j + 1 THEN ord[i + 1] ELSE x END)
  FROM (SELECT *, {_sql_hash60(f"'{sharding.SEED}:' || bucket || ':' || i")} % (i + 1) AS j FROM steps WHERE i > 0)),
shuffled AS (SELECT bucket, unnest(ord) AS place, unnest(range(len(ord))) AS spot FROM steps WHERE i = 0),
placed AS (SELECT *, row_number() OVER (ORDER BY bucket, spot) - 1 AS pos FROM shuffled JOIN held USING (bucket, place)),
cut AS (SELECT *, n // {sharding.SHARDS} AS each, (n % {sharding.SHARDS}) * (n // {sharding.SHARDS} + 1) AS odd FROM placed)
SELECT doc_id, size, text_crc32, '{sharding.LAW}' AS law,
  (CASE WHEN pos < odd THEN pos // (each + 1) ELSE n % {sharding.SHARDS} + (pos - odd) // greatest(each, 1) END)::INT AS shard,
  (CASE WHEN pos < odd THEN pos % (each + 1) ELSE (pos - odd) % greatest(each, 1) END)::BIGINT AS slot, NULL::INT AS grown_shard
FROM cut""",
    "op12_importance_resampling": rf"""WITH {_CRC_TABLE},
texts AS (SELECT 'd' AS kind, doc_id, row_number() OVER () AS n, text FROM documents UNION ALL SELECT 'b', NULL, row_number() OVER (), text FROM benchmark),
words AS (SELECT kind, doc_id, n, regexp_extract_all(translate(coalesce(text, ''), {_ASCII}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
runs AS (
  SELECT kind, n, unnest(w) AS run FROM words
  UNION ALL SELECT kind, n, unnest(list_transform(list_zip(w[:-2], w[2:]), lambda p: p[1] || ' ' || p[2])) FROM words WHERE len(w) > 1),
counted AS (SELECT kind, n, run, count(*) AS times FROM runs GROUP BY ALL),
buckets AS (SELECT run, {_sql_crc("run")} % {resampling.BUCKETS} AS bucket FROM (SELECT DISTINCT run FROM counted), crc_table),
placed AS (SELECT kind, n, bucket, sum(times) AS times FROM counted JOIN buckets USING (run) GROUP BY ALL),
sums AS (SELECT coalesce(sum(times) FILTER (WHERE kind = 'd'), 0) AS s, coalesce(sum(times) FILTER (WHERE kind = 'b'), 0) AS t FROM placed),
per_bucket AS (
  SELECT bucket, coalesce(sum(times) FILTER (WHERE kind = 'd'), 0)::DOUBLE AS s, coalesce(sum(times) FILTER (WHERE kind = 'b'), 0)::DOUBLE AS t
  FROM placed GROUP BY 1),
gains AS (
  SELECT bucket, floor(1000 * ln(((p.t + 1) * (a.s::DOUBLE + {resampling.BUCKETS})) / ((p.s + 1) * (a.t::DOUBLE + {resampling.BUCKETS}))))::BIGINT AS gain
  FROM per_bucket p, sums a),
weights AS (
  SELECT n, sum(times)::BIGINT AS n_features, floor(sum(gain * times)::DOUBLE / sum(times))::BIGINT AS weight
  FROM placed JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY n),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) >= {resampling.LEAST_WORDS} AS able,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{resampling.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM words LEFT JOIN weights USING (n) WHERE kind = 'd'),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY able DESC, score DESC, doc_id NULLS LAST, n_features, weight) AS place,
    count(*) FILTER (WHERE able) OVER () AS n_able
  FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {resampling.PERCENT} * n_able // 100 THEN place END AS rank FROM ranked""",
}

"""URL filters: a blocked Bloom filter of listed keys before an exact hash join.

A rule lists a host and a path; it fits the host and its subdomains where the url's
path starts with the rule's.  A url can therefore be fitted only by keys made of a
suffix of its host and a prefix of its path, and only keys of a *shape* that some rule
has (labels of the host, characters of the path) are made.  Every key is looked up in a
Bloom filter whose bits for one key lie in one 512-bit block, that is one row of a
small table; keys that pass go on to an exact join with the rules, which removes the
false positives.  The longest rule decides.  All of it is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanmark.llm.common import power_of_two_at_least, stage

# The rules of the query.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)

# Verdict on a url that no rule fits.
UNLISTED = "allow"

WORDS = 8  # 64-bit words of a block, one bit of each for every key
BITS_PER_KEY = 16

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for urls without ``://``."""
    start = F.instr(url, "://") + 3
    rest = F.coalesce(F.when(F.instr(url, "://") > 0, F.substr(url, start)), F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.char_length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """(verdict, rule) rows; a rule is written host, then path."""
    return spark.createDataFrame(list(rules), "verdict string, rule string")


def listed(rules: DataFrame) -> DataFrame:
    """One row per rule with its canonical host and path; of two verdicts on one rule block wins."""
    host = F.translate(F.regexp_extract("rule", r"^[^/]*", 0), _UPPER, _LOWER)
    path = F.substr("rule", F.char_length(F.regexp_extract("rule", r"^[^/]*", 0)) + 1)
    known = rules.where("rule is not null and verdict is not null").select(
        F.concat(host, path).alias("key"), F.char_length(host).alias("host_length"),
        F.when(host == "", 0).otherwise(F.size(F.split(host, r"\."))).alias("labels"),
        F.char_length(path).alias("path_length"), "rule", "verdict",
    )
    return known.groupBy("key").agg(
        *[F.max(c).alias(c) for c in ("host_length", "labels", "path_length", "verdict")], F.min("rule").alias("rule")
    )


def _masks(key: Column) -> list[Column]:
    """The bit of each word of a block that stands for a key."""
    h = F.xxhash64(F.lit("bits"), key)
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(h, 7 * i), F.lit(64)).cast("int")) for i in range(WORDS)]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), key), F.lit(blocks))


def bloom_filter(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, w0 .. w7): the words of every block that holds a key."""
    placed = keys.select(_block(F.col("key"), blocks).alias("block"), *[m.alias(f"m{i}") for i, m in enumerate(_masks(F.col("key")))])
    return placed.groupBy("block").agg(*[F.bit_or(f"m{i}").alias(f"w{i}") for i in range(WORDS)])


def candidate_keys(urls: DataFrame, shapes: DataFrame) -> DataFrame:
    """(url, key): keys of the given shapes (labels, path_length) that could fit a url.

    Suffixes of a host meet the shapes of as many labels in a join, so the shapes are a
    table of whatever size, in no plan and never on the driver.
    """
    labels = F.split("host", r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.struct(n.alias("labels"), F.array_join(F.slice(labels, -n, n), ".").alias("suffix")))
    cut = urls.where("host <> ''").select("url", "path", F.inline(suffix))
    met = cut.join(shapes, "labels").where(F.char_length("path") >= F.col("path_length"))
    return met.select("url", F.concat("suffix", F.expr("substr(path, 1, path_length)")).alias("key"))


def judged(pages: DataFrame, rules: DataFrame, url: str = "url", unlisted: str = UNLISTED) -> DataFrame:
    """All columns of ``pages`` with host, path, rule and verdict.

    rule is null and the verdict ``unlisted`` where no rule fits: for a null url, one
    without ``://`` or without host too.  Without rules all is unlisted.  The verdict
    depends on the url alone, so repeated rows are judged alike.  Columns of ``pages``
    named like a result are replaced.
    """
    results = {"host", "path", "rule", "verdict"}
    rules = stage(listed(rules), "rules")
    shapes = stage(rules.where("labels > 0").select("labels", "path_length").distinct(), "shapes")
    blocks = power_of_two_at_least(rules.count() * BITS_PER_KEY / (64 * WORDS))
    bloom = stage(bloom_filter(rules, blocks), "bloom")

    host, path = host_and_path(F.col(url))
    base = pages.select(F.struct(*[c for c in pages.columns if c.lower() not in results or c == url]).alias("row"), F.col(url).alias("url"), host.alias("host"), path.alias("path"))
    tried = candidate_keys(base, shapes)
    tried = tried.withColumns({"block": _block(F.col("key"), blocks), **{f"m{i}": m for i, m in enumerate(_masks(F.col("key")))}})
    passes = " and ".join(f"(w{i} & m{i}) = m{i}" for i in range(WORDS))
    possible = tried.join(bloom, "block").where(passes).select("url", "key")
    hits = possible.join(rules, "key")
    best = hits.groupBy("url").agg(
        F.max(F.struct(F.char_length("rule").alias("n"), "host_length", "verdict", "rule")).alias("best")
    )
    best = best.select(F.col("url").alias("hit_url"), F.col("best.rule").alias("rule"), F.col("best.verdict").alias("found"))
    return base.join(best, F.col("url") == F.col("hit_url"), "left").select(
        "row.*", "host", "path", "rule", F.coalesce("found", F.lit(unlisted)).alias("verdict")
    )

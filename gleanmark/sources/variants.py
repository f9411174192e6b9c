"""Documents of unknown shape: JSON kept as VARIANT, its keys found by aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanmark.functions.text import is_blank


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, doc``: one VARIANT per line of JSON.

    Blank lines are skipped; a line that is no JSON has a null document (``check_json_lines``
    of the JSON lines names it).  No schema is stated or guessed.
    """
    lines = spark.read.text(path).where(~is_blank("value"))
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return lines.select(name.alias("file"), F.try_parse_json("value").alias("doc"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``file, doc``: one VARIANT per file, whatever its shape."""
    whole = spark.read.text(path, wholetext=True)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return whole.select(name.alias("file"), F.try_parse_json("value").alias("doc"))


def parsed(df: DataFrame, text: str, out: str = "doc") -> DataFrame:
    """Add a VARIANT of a JSON column; null where it is none."""
    return df.withColumn(out, F.try_parse_json(F.col(text)))


def schema_found(df: DataFrame, doc: str = "doc") -> DataFrame:
    """One row: the schema that holds all documents, merged by an aggregate."""
    return df.agg(F.schema_of_variant_agg(F.col(doc)).alias("schema"))


def keys_found(df: DataFrame, doc: str = "doc") -> DataFrame:
    """``key, type, n``: every key at the top of a document, by the type of its value."""
    entries = df.select(F.col(doc).alias("_doc")).lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_doc").outer()))
    return (
        entries.where("key is not null")
        .groupBy("key", F.schema_of_variant(F.col("value")).alias("type"))
        .agg(F.count("*").alias("n"))
    )


def extracted(df: DataFrame, columns: dict[str, tuple[str, str]], doc: str = "doc") -> DataFrame:
    """``df`` without its documents, with typed columns: name to ``(path, type)``, such as ``("$.a.b", "double")``.

    A path that a document lacks, or a value that is not of the type, gives null.
    """
    found = [F.try_variant_get(F.col(doc), path, kind).alias(name) for name, (path, kind) in columns.items()]
    return df.select(*[c for c in df.columns if c != doc], *found)

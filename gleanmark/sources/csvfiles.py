"""CSV error and comparison tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Texts hold quotes and line breaks: quotes double, and a field may span lines.
_OPTIONS = {"header": True, "quote": '"', "escape": '"', "multiLine": True, "encoding": "UTF-8"}
# An empty string and a missing value stay apart, and no text is trimmed.
_EXACT = {
    "emptyValue": '""',
    "nullValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(
        header=True, quote='"', escape='"', quoteAll=False, **_EXACT
    ).csv(path)


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).options(
        **_OPTIONS, emptyValue="", nullValue=None, mode="FAILFAST",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)

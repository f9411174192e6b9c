"""Run documents and keyed report sections."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanmark.schemas import RUN

_MANIFEST = "section string, version string"


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """One row per nested run document, with the file it came from."""
    return (
        spark.read.schema(RUN)
        .json(path, multiLine=True, mode="FAILFAST")
        .withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1))
    )


def write_report(report: DataFrame, path: str, section: str) -> None:
    """Replace one section of a long-form report and leave the others as they are.

    ``report`` is ``dataset, split, metric, value``.  The new version is written beside
    the old one, and only when it is complete a row of the manifest names it.  A job that
    fails before that leaves the old version in place; what it wrote is never read.
    """
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    report.write.parquet(f"{path}/data/section={section}/version={version}")
    entry = report.sparkSession.createDataFrame([(section, version)], _MANIFEST)
    entry.coalesce(1).write.mode("append").parquet(f"{path}/manifest")


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """``dataset, split, metric, value, section`` of the last complete version of each section."""
    last = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest").groupBy("section").agg(F.max("version").alias("version"))
    kinds = "dataset string, split string, metric string, value double, section string, version string"
    versions = spark.read.schema(kinds).parquet(f"{path}/data")
    # One row per section, so folders of other versions are pruned when the job runs.
    return versions.join(F.broadcast(last), ["section", "version"]).select("dataset", "split", "metric", "value", "section")


def report_as_json(report: DataFrame) -> DataFrame:
    """``section, document``: each section as one nested JSON document.

    A report holds a few values per split and metric, so a section is small.
    """
    per_split = report.groupBy("section", "dataset", "split").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "value")))).alias("values")
    )
    per_section = per_split.groupBy("section").agg(
        F.map_from_entries(
            F.array_sort(
                F.collect_list(F.struct(F.concat_ws("/", "dataset", "split").alias("k"), F.to_json("values")))
            )
        ).alias("doc")
    )
    return per_section.select("section", F.to_json("doc").alias("document"))

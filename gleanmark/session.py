"""Session helpers: tuned sessions, the shared scratch folder, bounded look-ups."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession

# The most distinct labels that may be brought to the driver or shipped to
# every task.  A label vocabulary is a dimension; beyond this it is refused.
MAX_VOCABULARY = 100_000


def local_session(cores: int | str = "*", app: str = "gleanmark", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def scratch_root(spark: SparkSession) -> str:
    """The folder for intermediate tables, which all executors share.

    A cluster names it in ``spark.checkpoint.dir``; a session without it uses a folder
    in its warehouse, where the tables it saves lie too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (root or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch").rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the session's own part of the shared folder."""
    return f"{scratch_root(spark)}/gleanmark-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this session has staged; results that still read it are void."""
    folder = f"{scratch_root(spark)}/gleanmark-{spark.sparkContext.applicationId}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with a table that outlives lost executors, keeps the
    columnar layout, and lets later scans prune columns.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lookup(df: DataFrame, name: str) -> DataFrame:
    """Stage the small side of a join before the join is planned.

    The planner then knows its true size: below the broadcast threshold the big
    side is not shuffled at all, above it both sides are, and a hot key is split
    by adaptive execution.  An unstaged aggregate has no known size, and the big
    side would be shuffled before the size is seen.
    """
    return stage(df, name)


def vocabulary(df: DataFrame, column: str | Column, bound: int = MAX_VOCABULARY) -> list[str]:
    """Sorted distinct non-null values of a label column, refused above ``bound``."""
    picked = df.select(df[column] if isinstance(column, str) else column)
    name = picked.columns[0]
    rows = picked.where(picked[name].isNotNull()).distinct().limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"more than {bound} distinct values in a label vocabulary")
    return sorted(str(r[0]) for r in rows)

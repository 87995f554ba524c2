"""Session settings for local runs, and the shared folder for cut points."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
# Off unless set: tables read by the queries are dealt out to so many parts (see `spread`).
READ_SETTING = "spark.prosemill.readParts"


def local_session(cores: int = 8, app_name: str = "prosemill") -> SparkSession:
    """A session for tests and benchmarks. A cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config(READ_SETTING, str(cores))
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the session names it."""
    named = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise ValueError(f"Set {CHECKPOINT_SETTING} to a folder that all executors share.")
    return named


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage and lets every later step read only the columns it needs,
    also after the loss of an executor.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/prosemill/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

"""Tables between the steps of an operator, in the folder the session names."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def new_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; all executors and the driver see it."""
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError(f"Set {SETTING} to a folder that all executors share.")
    return f"{folder.rstrip('/')}/prosemill/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write a table to the shared folder and read it back: later steps start from the files,
    also after executors are lost, and read only the columns they need."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill.session import READ_SETTING


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal the table out by key if the session asks for it, otherwise leave it as it is.

    Small files on one machine may come in one piece; a session for tests or benchmarks then
    names a number of parts. It is off by default, and the size of a table plays no part.
    """
    parts = df.sparkSession.conf.get(READ_SETTING, None)
    return df.repartition(int(parts), F.col(key)) if parts else df

"""Turn a one-row aggregate into a table of measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def measure_table(one_row: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """Rows (measure, value) in the given order from a frame with one row."""
    entries = F.array(
        *[
            F.struct(F.lit(name).alias("measure"), value.cast("double").alias("value"))
            for name, value in measures.items()
        ]
    )
    return one_row.select(F.inline(entries))

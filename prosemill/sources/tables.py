"""Parquet tables between the steps, the JSON report, split and feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosemill import schema as S

_PARTS = ["setting", "representation", "split"]


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write Parquet and read it back, so that later steps start from the file."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """A one-row nested table as JSON."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_features(features: DataFrame, path: str) -> None:
    """Sparse rows in a folder per setting, representation and split."""
    features.write.mode("overwrite").partitionBy(*_PARTS).parquet(path)


def read_features(
    spark: SparkSession, path: str, setting: str, representation: str
) -> dict[str, DataFrame]:
    """Feature rows of train, val and test by ascending id; other folders are not read."""
    chosen = spark.read.parquet(path).where(
        (F.col("setting") == setting) & (F.col("representation") == representation)
    )
    return _by_split(chosen)


def read_split_tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The split table as three tables by ascending id."""
    return _by_split(spark.read.parquet(path))


def _by_split(df: DataFrame) -> dict[str, DataFrame]:
    return {
        name: df.where(F.col("split") == name).orderBy(S.ARTICLE_ID) for name in S.SPLITS
    }


def write_vocabulary(vocabulary: DataFrame, path: str) -> DataFrame:
    """The vocabulary table; the position of a term is its column."""
    return write_table(vocabulary, path)


def write_vocabulary_json(vocabulary: DataFrame, path: str) -> None:
    """One JSON row per setting and representation with the terms in column order.

    A vocabulary has no more terms than its cap, which bounds the array.
    """
    in_order = F.sort_array(F.collect_list(F.struct("term_idx", "term")))
    lists = vocabulary.groupBy("setting", "representation").agg(in_order["term"].alias("terms"))
    lists.coalesce(1).write.mode("overwrite").json(path)

"""The supplied tables seen as titled, labelled articles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosemill import schema as S
from prosemill.functions.text import filled, strip
from prosemill.sources import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, one_line_body: str | None = "") -> DataFrame:
    """Row id, title (first line) and text (the rest, or as given if there is none) of every document."""
    line_end = F.instr("text", F.lit("\n"))
    body = F.when(line_end > 0, F.substr("text", line_end + 1)).otherwise(F.lit(one_line_body))
    texts = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return texts.select(
        F.col("doc_id").alias(S.ROW_ID),
        strip(filled(F.substring_index("text", "\n", 1))).alias(S.TITLE),
        strip(body if one_line_body is None else filled(body)).alias(S.TEXT),
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias(S.ROW_ID), F.col("quality").alias(S.LABEL)
    )


def labelled(df: DataFrame, sf_dir: str, how: str = "inner") -> DataFrame:
    """Attach the label by row id.

    Callers first reduce the documents to what they need (lengths, keys, flags),
    so that a large label table is joined with narrow rows and not with texts.
    """
    return df.join(labels(df.sparkSession, sf_dir), S.ROW_ID, how)

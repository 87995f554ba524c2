"""Most frequent words per field and label."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prosemill import schema as S
from prosemill.functions.text import is_blank, profile_words, run_lengths, run_starts


def english_stop_words() -> list[str]:
    return sorted(StopWordsRemover.loadDefaultStopWords("english"))


def counted_in_row(df: DataFrame, column: str) -> DataFrame:
    """Replace an array of terms by `array<struct<term, tf>>`.

    A document is one row, so its repeats are counted by sorting its own array
    and measuring the runs: no shuffle, and no table of (document, term) pairs.
    """
    others = [name for name in df.columns if name != column]
    ordered = df.select(*others, F.sort_array(column).alias("_ordered"))
    started = ordered.select("*", run_starts(F.col("_ordered")).alias("_starts"))
    return started.select(*others, run_lengths(F.col("_ordered"), F.col("_starts")).alias(column))


def unpacked(df: DataFrame, column: str, *keys: str) -> DataFrame:
    """Rows (keys, term, tf) of documents with at least one term.

    The outer form is on purpose: for the inner one the optimizer adds a filter on
    the size of the array and pushes it down, where the array is built once more
    for every element looked at.
    """
    return df.select(*keys, F.inline_outer(column)).where(F.col("term").isNotNull())


def document_words(df: DataFrame, stop_words: list[str] | None = None) -> DataFrame:
    """Rows (row id, field, words) with the counted words of every non-blank field."""
    stop_words = english_stop_words() if stop_words is None else stop_words
    fields = F.array(
        *[
            F.struct(
                F.lit(field).alias("field"),
                is_blank(F.col(column)).alias("_blank"),
                profile_words(F.col(column), stop_words).alias("words"),
            )
            for field, column in (("title", S.TITLE), ("body", S.TEXT))
        ]
    )
    others = [name for name in df.columns if name not in (S.TITLE, S.TEXT)]
    rows = df.select(*others, F.inline(fields)).where("not _blank").drop("_blank")
    return counted_in_row(rows, "words")


def top_words(
    words: DataFrame, *, top: int = 20, min_df: int = 10, max_features: int = 5000
) -> DataFrame:
    """The most frequent words of each field and label that enough documents use.

    `words` has (label, field, words). Ties are broken by the word.
    """
    counts = (
        unpacked(words.where(F.col(S.LABEL).isNotNull()), "words", "field", S.LABEL)
        .groupBy("field", S.LABEL, "term")
        .agg(F.sum("tf").alias("count"), F.count(F.lit(1)).alias("document_count"))
        .where(F.col("document_count") >= min_df)
    )
    best_first = Window.partitionBy("field", S.LABEL).orderBy(F.desc("count"), "term")
    return (
        counts.withColumn("position", F.row_number().over(best_first))
        .where(F.col("position") <= min(top, max_features))
        .select("field", S.LABEL, "position", F.col("term").alias("word"), "count")
        .orderBy("field", S.LABEL, "position")
    )

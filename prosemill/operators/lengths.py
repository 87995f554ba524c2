"""Length and word-count statistics from one histogram."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prosemill import schema as S
from prosemill.functions.text import filled, round_half_even, word_count

LENGTHS = ["title_length", "text_length", "title_word_count", "text_word_count"]
WORD_COUNTS = ["title_word_count", "text_word_count"]


def with_lengths(df: DataFrame) -> DataFrame:
    """Replace title and text by their lengths and word counts."""
    others = [name for name in df.columns if name not in (S.TITLE, S.TEXT)]
    return df.select(
        *others,
        F.length(filled(F.col(S.TITLE))).alias("title_length"),
        F.length(filled(F.col(S.TEXT))).alias("text_length"),
        word_count(F.col(S.TITLE)).alias("title_word_count"),
        word_count(F.col(S.TEXT)).alias("text_word_count"),
    )


def first_copy_lengths(df: DataFrame) -> DataFrame:
    """Label and lengths of the first copy of every article.

    All values are of fixed width and follow the smallest row id through one
    aggregate, so neither texts nor a second pass are needed.
    """
    values = [S.LABEL, *LENGTHS]
    firsts = [F.min_by(name, S.ROW_ID).alias(name) for name in values]
    return df.groupBy(S.CONTENT_KEY).agg(*firsts).select(*values)


def histogram(df: DataFrame, measures: list[str], *, by: list[str] | None = None) -> DataFrame:
    """Rows per measure, group and value.

    Exact quantiles of a long column in one task would gather the column there;
    of a histogram they gather one row per distinct length.
    """
    by = by or []
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("measure"), F.col(name).cast("long").alias("value"))
            for name in measures
        ]
    )
    return (
        df.select(*by, F.inline(pairs))
        .groupBy("measure", *by, "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def quantile(share: float) -> Column:
    """Exact quantile with linear interpolation over a histogram."""
    return F.percentile("value", F.lit(share), F.col("rows"))


def mean() -> Column:
    return F.sum(F.col("value").cast("double") * F.col("rows")) / F.sum("rows")


def describe(hist: DataFrame, *, by: list[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles of every measure."""
    groups = ["measure", *(by or [])]
    over = Window.partitionBy(*groups)
    centre = F.sum(F.col("value").cast("double") * F.col("rows")).over(over) / F.sum("rows").over(
        over
    )
    spread = F.sum(F.pow(F.col("value") - F.col("_mean"), 2) * F.col("rows"))
    return (
        hist.withColumn("_mean", centre)
        .groupBy(*groups)
        .agg(
            F.sum("rows").alias("count"),
            F.first("_mean").alias("mean"),
            F.when(F.sum("rows") > 1, F.sqrt(spread / (F.sum("rows") - 1))).alias("std"),
            F.min("value").alias("min"),
            quantile(0.25).alias("q25"),
            quantile(0.5).alias("median"),
            quantile(0.75).alias("q75"),
            F.max("value").alias("max"),
        )
    )


def mean_by_label(hist: DataFrame) -> DataFrame:
    """Mean of every measure per label; rows without a label are left out."""
    labelled = hist.where(F.col(S.LABEL).isNotNull())
    return labelled.groupBy("measure", S.LABEL).agg(mean().alias("mean"))


def length_summary_by_label(hist: DataFrame) -> DataFrame:
    """Record count, mean and median word counts per label, two digits."""
    labelled = hist.where(F.col(S.LABEL).isNotNull())
    stats = labelled.groupBy(S.LABEL, "measure").agg(
        F.sum("rows").alias("_rows"), mean().alias("_mean"), quantile(0.5).alias("_median")
    )

    def of(measure: str, column: str) -> Column:
        return F.max(F.when(F.col("measure") == measure, F.col(column)))

    return (
        stats.groupBy(S.LABEL)
        .agg(
            F.max("_rows").alias("record_count"),
            round_half_even(of("title_word_count", "_mean"), 2).alias("mean_title_words"),
            round_half_even(of("title_word_count", "_median"), 2).alias("median_title_words"),
            round_half_even(of("text_word_count", "_mean"), 2).alias("mean_text_words"),
            round_half_even(of("text_word_count", "_median"), 2).alias("median_text_words"),
        )
        .orderBy(S.LABEL)
    )


def upper_limits(hist: DataFrame, share: float = 0.99) -> DataFrame:
    """The quantile of every measure over all groups."""
    return hist.groupBy("measure").agg(quantile(share).alias("upper_limit"))


def capped(df: DataFrame, measures: list[str], share: float = 0.99) -> DataFrame:
    """Add `<measure>_capped`: the value, or the quantile of its column if that is less.

    All quantiles come from one scalar subquery over the histogram: no join, and
    one more pass over the table whatever the number of measures.
    """
    limits = histogram(df, measures).agg(
        F.struct(
            *[
                F.percentile(
                    F.when(F.col("measure") == name, F.col("value")), F.lit(share), F.col("rows")
                ).alias(name)
                for name in measures
            ]
        ).alias("limits")
    )
    return df.withColumns(
        {
            f"{name}_capped": F.least(F.col(name).cast("double"), limits.scalar()[name])
            for name in measures
        }
    )


def boxplot_stats(hist: DataFrame, share: float = 0.99, reach: float = 1.5) -> DataFrame:
    """Quartiles and whiskers per measure and label of values capped at the quantile.

    A whisker ends at the last value within `reach` times the quartile distance.
    `hist` counts values by measure and label, so all steps work on a small table.
    """
    limits = upper_limits(hist, share)
    values = (
        hist.where(F.col(S.LABEL).isNotNull())
        .join(limits, "measure")
        .withColumn("value", F.least(F.col("value").cast("double"), F.col("upper_limit")))
    )
    keys = ["measure", S.LABEL]
    quartiles = values.groupBy(*keys).agg(
        F.first("upper_limit").alias("upper_limit"),
        quantile(0.25).alias("q25"),
        quantile(0.5).alias("median"),
        quantile(0.75).alias("q75"),
    )
    span = (F.col("q75") - F.col("q25")) * reach
    inside_low = F.col("value") >= F.col("q25") - span
    inside_high = F.col("value") <= F.col("q75") + span
    whiskers = (
        values.drop("upper_limit")
        .join(quartiles, keys)
        .groupBy(*keys)
        .agg(
            F.min(F.when(inside_low, F.col("value"))).alias("_low"),
            F.max(F.when(inside_high, F.col("value"))).alias("_high"),
        )
    )
    return quartiles.join(whiskers, keys).select(
        *keys,
        "upper_limit",
        F.least("_low", "q25").alias("whisker_low"),
        "q25",
        "median",
        "q75",
        F.greatest("_high", "q75").alias("whisker_high"),
    )

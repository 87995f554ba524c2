"""Class distribution, missing and blank values, the data-quality table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prosemill import schema as S
from prosemill.functions.text import filled, is_blank, strip
from prosemill.operators.measures import measure_table
from prosemill.operators.stage1 import content_key


def label_distribution(df: DataFrame, *, keep_null: bool = False) -> DataFrame:
    """Rows and share of each label, ordered by label."""
    rows = df.select(S.LABEL) if keep_null else df.select(S.LABEL).where(f"{S.LABEL} is not null")
    counts = rows.groupBy(S.LABEL).agg(F.count(F.lit(1)).alias("record_count"))
    total = F.sum("record_count").over(Window.partitionBy())
    return counts.withColumn("percentage", F.col("record_count") / total * 100).orderBy(S.LABEL)


def with_gaps(df: DataFrame) -> DataFrame:
    """Replace the texts by null and blank flags: all that the missing-value reports read."""
    others = [name for name in df.columns if name not in (S.TITLE, S.TEXT)]
    return df.select(
        *others,
        F.col(S.TITLE).isNull().alias("title_null"),
        F.col(S.TEXT).isNull().alias("text_null"),
        is_blank(F.col(S.TITLE)).alias("title_blank"),
        is_blank(F.col(S.TEXT)).alias("text_blank"),
    )


def missing_summary(gaps: DataFrame) -> DataFrame:
    """Null and blank counts of title, body and label, one pass."""
    title_null, text_null = F.col("title_null"), F.col("text_null")
    title_blank, text_blank = F.col("title_blank"), F.col("text_blank")
    one_row = gaps.agg(
        F.count_if(title_null).alias("a"),
        F.count_if(text_null).alias("b"),
        F.count_if(F.col(S.LABEL).isNull()).alias("c"),
        F.count_if(title_null | text_null).alias("d"),
        F.count_if(title_null & text_null).alias("e"),
        F.count_if(title_blank).alias("f"),
        F.count_if(text_blank).alias("g"),
        F.count_if(title_blank | text_blank).alias("h"),
        F.count_if(title_blank & text_blank).alias("i"),
    )
    # The names of the measures.
    return measure_table(
        one_row,
        {
            "Missing titles": F.col("a"),
            "Missing body texts": F.col("b"),
            "Missing labels": F.col("c"),
            "Rows missing title or body": F.col("d"),
            "Rows missing both title and body": F.col("e"),
            "Blank titles": F.col("f"),
            "Blank body texts": F.col("g"),
            "Rows with a blank title or blank body": F.col("h"),
            "Rows with both title and body blank": F.col("i"),
            "Body texts blank but not null": F.col("g") - F.col("b"),
        },
    )


def with_quality_columns(df: DataFrame) -> DataFrame:
    """Row id, label, content key and gap flags: the narrow input of the quality table.

    `df` needs stripped texts in the key only, so null and blank share a key.
    """
    stripped = (
        df.withColumn("_title", strip(filled(F.col(S.TITLE))))
        .withColumn("_text", strip(filled(F.col(S.TEXT))))
        .withColumn(S.CONTENT_KEY, content_key("_title", "_text"))
        .drop("_title", "_text")
    )
    return with_gaps(stripped)


def data_quality_summary(narrow: DataFrame, usable_columns: int = 3) -> DataFrame:
    """Eleven measures of the raw table.

    The flag sums ride on the aggregate that finds equal articles, so the texts
    are read once for missing values and duplicates together.
    """
    both = F.col("title_null") & F.col("text_null")
    either = F.col("title_null") | F.col("text_null")
    per_label = narrow.groupBy(S.CONTENT_KEY, S.LABEL).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(F.col("title_null")).alias("_title_null"),
        F.count_if(F.col("text_null")).alias("_text_null"),
        F.count_if(either).alias("_either"),
        F.count_if(both).alias("_both"),
        F.count_if(F.col("title_blank")).alias("_title_blank"),
        F.count_if(F.col("text_blank")).alias("_text_blank"),
    )
    sums = ["_rows", "_title_null", "_text_null", "_either", "_both", "_title_blank", "_text_blank"]
    per_article = per_label.groupBy(S.CONTENT_KEY).agg(
        *[F.sum(name).alias(name) for name in sums],
        F.sum(F.when(F.col(S.LABEL).isNull(), F.col("_rows")).otherwise(0)).alias("_label_null"),
        F.count(F.lit(1)).alias("_variants"),
    )
    totals = [*sums, "_label_null", "_variants"]
    one_row = per_article.agg(
        F.count(F.lit(1)).alias("_articles"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in totals],
    )
    # The names of the measures.
    return measure_table(
        one_row,
        {
            "Total records": F.col("_rows"),
            "Total usable columns": F.lit(usable_columns),
            "Missing titles": F.col("_title_null"),
            "Missing body texts": F.col("_text_null"),
            "Missing labels": F.col("_label_null"),
            "Rows missing title or body": F.col("_either"),
            "Rows missing both title and body": F.col("_both"),
            "Blank titles after stripping whitespace": F.col("_title_blank"),
            "Blank body texts after stripping whitespace": F.col("_text_blank"),
            "Duplicate title-text-label records": F.col("_rows") - F.col("_variants"),
            "Duplicate title-text articles ignoring label": F.col("_rows") - F.col("_articles"),
        },
    )

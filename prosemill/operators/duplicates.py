"""Groups of equal articles, conflicting labels, duplicate reports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill import schema as S
from prosemill.functions.text import round_half_even
from prosemill.operators.measures import measure_table
from prosemill.operators.stage1 import content_key


def article_groups(df: DataFrame, key: str | list[str] = S.CONTENT_KEY) -> DataFrame:
    """One row per distinct article: size, distinct labels, label variants, first row.

    Copies with the same label are combined first and labels second, so neither
    step needs a distinct aggregate and a hot article is folded before each
    shuffle. A missing label is a variant, but not a label.
    """
    keys = [key] if isinstance(key, str) else key
    per_label = df.groupBy(*keys, S.LABEL).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(S.ROW_ID).alias("_first")
    )
    return per_label.groupBy(*keys).agg(
        F.sum("_rows").alias("group_size"),
        F.count(S.LABEL).alias("number_of_labels"),
        F.count(F.lit(1)).alias("label_variants"),
        F.min("_first").alias("first_row_id"),
    )


def duplicate_groups(groups: DataFrame) -> DataFrame:
    return groups.where(F.col("group_size") > 1)


def label_conflicts(groups: DataFrame) -> DataFrame:
    """Articles that carry more than one label."""
    return groups.where(F.col("number_of_labels") > 1)


def require_no_conflicts(groups: DataFrame) -> DataFrame:
    """Stop the run if the same article carries two labels."""
    conflicts = label_conflicts(groups).count()
    if conflicts:
        raise ValueError(f"{conflicts} articles have copies under conflicting labels.")
    return groups


def duplicate_report(groups: DataFrame) -> DataFrame:
    """Six measures of duplication; all zero but the last if there is none."""
    repeated = F.col("group_size") > 1
    one_row = groups.agg(
        F.coalesce(F.sum("group_size"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("articles"),
        F.count_if(repeated).alias("groups"),
        F.coalesce(F.max(F.when(repeated, F.col("group_size"))), F.lit(0)).alias("largest"),
        F.count_if(repeated & (F.col("number_of_labels") > 1)).alias("conflicts"),
    )
    extra = F.col("rows") - F.col("articles")
    share = F.when(F.col("rows") > 0, extra / F.col("rows") * 100).otherwise(F.lit(0.0))
    # The names of the measures.
    return measure_table(
        one_row,
        {
            "Duplicate records beyond first copy": extra,
            "Duplicate percentage": round_half_even(share, 2),
            "Number of duplicate article groups": F.col("groups"),
            "Largest duplicate group size": F.col("largest"),
            "Duplicate groups with conflicting labels": F.col("conflicts"),
            "Unique articles after exact deduplication": F.col("articles"),
        },
    )


def repeated_rows(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Number of rows equal to an earlier row in the given columns, null equal to null."""
    key = content_key(*(df.columns if columns is None else columns)).alias(S.CONTENT_KEY)
    sizes = df.select(key).groupBy(S.CONTENT_KEY).agg(F.count(F.lit(1)).alias("_rows"))
    return sizes.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("duplicated_rows"),
    )


def repeated_rows_by_subset(df: DataFrame, subsets: dict[str, list[str]]) -> DataFrame:
    """The same for several sets of columns, named, in one pass over the table."""
    keys = F.array(
        *[F.struct(F.lit(name).alias("subset"), content_key(*columns).alias(S.CONTENT_KEY)) for name, columns in subsets.items()]
    )
    sizes = df.select(F.inline(keys)).groupBy("subset", S.CONTENT_KEY).agg(F.count(F.lit(1)).alias("_rows"))
    return sizes.groupBy("subset").agg(
        F.sum("_rows").alias("rows"), F.sum(F.col("_rows") - 1).alias("duplicated_rows")
    )


def repeated_ids(df: DataFrame, column: str = S.ARTICLE_ID) -> DataFrame:
    """Number of ids that occurred before; a missing id is a value like any other."""
    sizes = df.groupBy(column).agg(F.count(F.lit(1)).alias("_rows"))
    return sizes.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("duplicated_ids"),
    )

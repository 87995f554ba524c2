"""The cleaning step on a whole table, its samples and its report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosemill import schema as S
from prosemill.functions.cleaning import (
    LETTER_STEPS,
    MARKUP_STEPS,
    SOURCE_MARKERS,
    source_steps,
    steps,
)
from prosemill.functions.text import filled, joined, round_half_even, strip, word_count
from prosemill.operators.columns import (
    drop_generated_columns,
    drop_serial_columns,
    preferred_order,
    present_columns,
    reject_duplicate_names,
    require_columns,
)
from prosemill.operators.duplicates import repeated_ids


def with_raw_text(df: DataFrame) -> DataFrame:
    """Add title and body joined as they are, for the audit."""
    title, text = filled(F.col(S.TITLE)), filled(F.col(S.TEXT))
    return df.withColumn("raw_title_body", joined(strip(title), strip(text)))


def with_clean_texts(
    df: DataFrame,
    targets: dict[str, str],
    *,
    remove_markers: bool = True,
    markers: list[str] | None = None,
) -> DataFrame:
    """Add `<target>_with_markers` and `<target>` for each source column.

    What both forms share is worked out once.
    """
    markers = SOURCE_MARKERS if markers is None else markers
    kept = {target: f"{target}_with_markers" for target in targets.values()}
    df = df.withColumns({kept[target]: filled(F.col(c)) for c, target in targets.items()})
    df = steps(df, list(kept.values()), MARKUP_STEPS)
    if not remove_markers:
        df = steps(df, list(kept.values()), LETTER_STEPS)
        return df.withColumns({target: F.col(name) for target, name in kept.items()})
    df = df.withColumns({target: F.col(name) for target, name in kept.items()})
    df = steps(df, list(kept), source_steps(markers) + LETTER_STEPS)
    return steps(df, list(kept.values()), LETTER_STEPS)


def cleaned_articles(
    df: DataFrame, *, remove_markers: bool = True, markers: list[str] | None = None
) -> DataFrame:
    """All text columns of the cleaned table, with and without source markers."""
    require_columns(df)
    df = reject_duplicate_names(drop_generated_columns(drop_serial_columns(df)))
    df = df.withColumns({S.TITLE: filled(F.col(S.TITLE)), S.TEXT: filled(F.col(S.TEXT))})
    df = with_raw_text(df)
    df = with_clean_texts(
        df,
        {S.TITLE: "clean_title", S.TEXT: "clean_body"},
        remove_markers=remove_markers,
        markers=markers,
    )
    df = df.withColumns(
        {
            "clean_title_body_with_markers": joined(
                F.col("clean_title_with_markers"), F.col("clean_body_with_markers")
            ),
            "clean_title_body": joined(F.col("clean_title"), F.col("clean_body")),
        }
    )
    df = df.withColumns(
        {
            "clean_title_word_count": word_count(F.col("clean_title")),
            "clean_body_word_count": word_count(F.col("clean_body")),
            "clean_combined_word_count": word_count(F.col("clean_title_body")),
        }
    )
    return reject_duplicate_names(preferred_order(df))


def before_after_samples(cleaned: DataFrame, rows: int = 20) -> DataFrame:
    """The first rows by id, with texts before and after cleaning."""
    first_by = S.ARTICLE_ID if S.ARTICLE_ID in cleaned.columns else S.ROW_ID
    return present_columns(cleaned.orderBy(first_by).limit(rows), S.SAMPLE_COLUMNS)


def quality_report(
    original: DataFrame,
    cleaned: DataFrame,
    *,
    remove_markers: bool = True,
    markers: list[str] | None = None,
) -> DataFrame:
    """One nested row that summarizes a cleaning run.

    Counts are summed per label and the few label rows added up, so the table is
    read once; only the article ids are shuffled, to find repeated ones.
    """
    markers = SOURCE_MARKERS if markers is None else markers
    per_label = cleaned.groupBy(S.LABEL).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("clean_title") == "").alias("titles"),
        F.count_if(F.col("clean_body") == "").alias("bodies"),
        F.count_if(F.col("clean_title_body") == "").alias("both"),
        F.sum("clean_title_word_count").alias("title_words"),
        F.sum("clean_body_word_count").alias("body_words"),
    )
    by_label = F.sort_array(F.collect_list(F.struct(S.LABEL, "rows")))
    label_counts = F.map_from_entries(
        F.transform(
            by_label,
            lambda e: F.struct(F.coalesce(e[S.LABEL].cast("string"), F.lit("null")), e["rows"]),
        )
    )
    totals = per_label.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("output_rows"),
        label_counts.alias("label_counts"),
        *[
            F.coalesce(F.sum(name), F.lit(0)).alias(name)
            for name in ("titles", "bodies", "both", "title_words", "body_words")
        ],
    )
    class_names = [item for pair in S.CLASS_NAMES.items() for item in (str(pair[0]), pair[1])]
    report = totals.select(
        original.agg(F.count(F.lit(1)).alias("rows")).scalar().alias("input_rows"),
        "output_rows",
        F.create_map(*[F.lit(item) for item in class_names]).alias("label_mapping"),
        "label_counts",
        F.col("titles").alias("blank_clean_titles"),
        F.col("bodies").alias("blank_clean_bodies"),
        F.col("both").alias("blank_clean_combined"),
        _mean("title_words").alias("mean_clean_title_words"),
        _mean("body_words").alias("mean_clean_body_words"),
        F.lit(remove_markers).alias("source_markers_removed"),
        F.array(*[F.lit(m) for m in markers]).alias("configured_markers"),
        F.lit(False).alias("stopwords_removed"),
        F.lit(False).alias("stemming_applied"),
        F.lit(False).alias("lemmatization_applied"),
    )
    if S.ARTICLE_ID in cleaned.columns:
        repeated = repeated_ids(cleaned).select("duplicated_ids").scalar()
        report = report.withColumn("duplicate_article_ids", repeated)
    return report


def _mean(words: str) -> Column:
    return round_half_even(F.col(words) / F.col("output_rows"), 3)

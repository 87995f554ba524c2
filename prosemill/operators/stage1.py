"""Stage-1 rows, exact duplicates and dense article ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosemill import schema as S
from prosemill.functions.text import filled, strip
from prosemill.operators.ranking import ranked_by_id

# Fixed value: reason given for removed copies.
REMOVAL_REASON = "exact_duplicate_title_text"


def class_name(label: Column) -> Column:
    name = F.lit(None).cast("string")
    for value, text in S.CLASS_NAMES.items():
        name = F.when(label == value, text).otherwise(name)
    return name


def stage1_flags(stripped: DataFrame) -> DataFrame:
    """Add what is missing of the stripped title and text."""
    title_missing = F.col(S.TITLE) == ""
    text_missing = F.col(S.TEXT) == ""
    return stripped.select(
        "*",
        title_missing.alias("title_missing"),
        text_missing.alias("text_missing"),
        (~(title_missing | text_missing)).alias("complete_case"),
    )


def stage1_rows(raw: DataFrame, *more: str) -> DataFrame:
    """Strip title and text and flag what is missing; further columns stay. No row moves."""
    stripped = raw.select(
        S.ROW_ID,
        strip(filled(F.col(S.TITLE))).alias(S.TITLE),
        strip(filled(F.col(S.TEXT))).alias(S.TEXT),
        S.LABEL,
        class_name(F.col(S.LABEL)).alias("class_name"),
        *more,
    )
    return stage1_flags(stripped)


def content_key(*columns: str) -> Column:
    """A 32-byte stand-in for the values of some columns.

    Every value is written with its length in front, and null apart from the
    empty text, so no two different rows give the same input to the hash. Long
    texts then stay where they are while keys are shuffled.
    """
    parts = []
    for name in columns:
        value = F.col(name).cast("string")
        coded = F.concat(F.length(value).cast("string"), F.lit(":"), value)
        parts.append(F.coalesce(coded, F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def first_copies(keyed: DataFrame, key: str = S.CONTENT_KEY, *, order: str = S.ROW_ID, one_label: bool = False) -> DataFrame:
    """Row id and order of the first copy of every article, one narrow aggregate.

    The first copy is the one with the smallest row id, wherever it stands in the file, or the
    smallest `order`: give the read position (see `columns.with_read_position`) for the first one in
    the file. With `one_label` an article whose copies have different labels stops the query.
    Copies are combined before the shuffle, so an article that fills a third of
    the table sends one row per task.
    """
    first = F.min(S.ROW_ID) if order == S.ROW_ID else F.min_by(S.ROW_ID, order)
    found = keyed.groupBy(key).agg(
        first.alias(S.ROW_ID), F.min(order).alias("_order"),
        *([F.min(S.LABEL).alias("_low"), F.max(S.LABEL).alias("_high")] if one_label else []),
    )
    if one_label:
        message = F.format_string(
            "An article has copies under conflicting labels %s and %s, the first of them in row %s.",
            F.col("_low").cast("string"), F.col("_high").cast("string"), F.col(S.ROW_ID).cast("string"),
        )
        conflict = F.col("_low") != F.col("_high")
        found = found.where(F.when(conflict, F.raise_error(message).cast("boolean")).otherwise(True))
    return found.select(S.ROW_ID, "_order")


def numbered_articles(
    stage1: DataFrame, *, keyed: DataFrame | None = None, order: str = S.ROW_ID, one_label: bool = False
) -> DataFrame:
    """Stage-1 rows with `article_id`: dense from 0 for first copies, null for later ones.

    Ids are worked out on row ids alone; the texts are joined once, on the unique
    row id, so no key is hot. `keyed` may give row ids, content keys (and the order and the labels,
    if asked for) from a narrower source.
    """
    if keyed is None:
        more = {order, *([S.LABEL] if one_label else [])} - {S.ROW_ID}
        keyed = stage1.select(S.ROW_ID, *more, content_key(S.TITLE, S.TEXT).alias(S.CONTENT_KEY))
    firsts = first_copies(keyed, order=order, one_label=one_label)
    ids = ranked_by_id(firsts, "_order", S.ARTICLE_ID).select(S.ROW_ID, S.ARTICLE_ID)
    return stage1.join(ids, S.ROW_ID, "left").select(S.ARTICLE_ID, *[c for c in stage1.columns if c != order or order == S.ROW_ID])


def master_rows(numbered: DataFrame) -> DataFrame:
    return numbered.where(F.col(S.ARTICLE_ID).isNotNull())


def complete_cases(numbered: DataFrame) -> DataFrame:
    return master_rows(numbered).where("complete_case")


def incomplete_cases(numbered: DataFrame) -> DataFrame:
    return master_rows(numbered).where("not complete_case")


def removed_copies(numbered: DataFrame) -> DataFrame:
    return (
        numbered.where(F.col(S.ARTICLE_ID).isNull())
        .drop(S.ARTICLE_ID)
        .withColumn("removal_reason", F.lit(REMOVAL_REASON))
    )


def stage_measures() -> dict[str, Column]:
    """Rows of each stage, as aggregates over numbered articles."""
    kept = F.col(S.ARTICLE_ID).isNotNull()
    complete = F.col("complete_case")
    return {
        "original": F.count(F.lit(1)),
        "duplicates": F.count_if(~kept),
        "master": F.count_if(kept),
        "complete": F.count_if(kept & complete),
        "incomplete": F.count_if(kept & ~complete),
    }


def stage_counts(numbered: DataFrame, expected: dict[str, int] | None = None) -> DataFrame:
    """Rows of each stage against expected values, from one pass.

    Columns: stage, actual, expected, status ('OK', 'CHECK', or null without an
    expected value).
    """
    counts = numbered.agg(*[value.alias(name) for name, value in stage_measures().items()])
    return checked_counts(counts, expected)


def checked_counts(counts: DataFrame, expected: dict[str, int] | None = None) -> DataFrame:
    """The same from one row that holds the counts already."""
    expected = expected or {}
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("stage"),
                F.col(name).alias("actual"),
                F.lit(expected.get(name)).cast("long").alias("expected"),
            )
            for name in stage_measures()
        ]
    )
    return counts.select(F.inline(entries)).withColumn(
        "status",
        F.when(F.col("actual") == F.col("expected"), "OK").when(
            F.col("expected").isNotNull(), "CHECK"
        ),
    )

"""Quality, length, duplicate, word and marker profile of a raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill import schema as S
from prosemill.functions.text import filled, preview, strip
from prosemill.operators import columns as C
from prosemill.operators import duplicates as D
from prosemill.operators import lengths as L
from prosemill.operators import markers as M
from prosemill.operators import quality as Q
from prosemill.operators import words as Wo
from prosemill.operators.sampling import label_samples
from prosemill.operators.stage1 import content_key
from prosemill.session import written
from prosemill.sources.csv import write_summary_csv


def narrowed(raw: DataFrame, markers: list[str]) -> DataFrame:
    """What the profile needs of a row besides its words, from one pass over the texts.

    Character lengths are those of the texts as they are; words, keys and markers
    are those of the stripped texts.
    """
    title, text = strip(filled(F.col(S.TITLE))), strip(filled(F.col(S.TEXT)))
    rows = raw.withColumns({"_title": title, "_text": text})
    if "row_key" not in raw.columns:
        rows = rows.withColumn("row_key", content_key(*raw.columns))
    rows = rows.withColumn(S.CONTENT_KEY, content_key("_title", "_text"))
    rows = rows.withColumn("_lowered", F.lower(F.concat("_title", F.lit(" "), "_text")))
    rows = M.with_found_markers(rows, "_lowered", markers, "found").drop("_title", "_text")
    gaps = {
        "title_null": F.col(S.TITLE).isNull(),
        "text_null": F.col(S.TEXT).isNull(),
        "title_blank": title == "",
        "text_blank": text == "",
    }
    return L.with_lengths(rows.withColumns(gaps))


def run(
    raw: DataFrame,
    *,
    markers: list[str] | None = None,
    stop_words: list[str] | None = None,
) -> dict[str, DataFrame]:
    """All summary tables by name; every one of them is small.

    The texts are read twice: for the narrow rows and for the words.
    """
    markers = M.PROFILE_MARKERS if markers is None else markers
    named = C.require_columns(C.normalized_names(raw))
    as_read = named.columns
    numbered = C.with_row_ids(named)
    # equal rows are equal in all columns as they were read; a generated row id is not one of them
    unread = [S.ROW_ID if name == "unnamed: 0" and S.ROW_ID not in as_read else name for name in as_read]
    raw = C.with_nullable_labels(numbered.withColumn("row_key", content_key(*unread)))
    raw = raw.select(S.ROW_ID, S.TITLE, S.TEXT, S.LABEL, "row_key")
    narrow = written(narrowed(raw, markers), "profile")
    groups = D.article_groups(narrow)
    overall = L.histogram(narrow, L.LENGTHS)
    hist = written(L.histogram(narrow, L.LENGTHS, by=[S.LABEL]), "lengths")
    word_hist = hist.where(F.col("measure").isin(L.WORD_COUNTS))
    marker_counts = M.marker_counts_by_label(M.marker_hits(narrow, {"profile": "found"}, markers))
    return {
        "label_distribution": Q.label_distribution(narrow),
        "missing_values": Q.missing_summary(narrow),
        "data_quality_summary": Q.data_quality_summary(narrow),
        "full_row_duplicates": D.repeated_rows(narrow, ["row_key"]),
        "length_description": L.describe(overall),
        "mean_length_by_label": L.mean_by_label(hist),
        "length_summary_by_label": L.length_summary_by_label(word_hist),
        "word_count_boxes": L.boxplot_stats(word_hist),
        "duplicate_analysis": D.duplicate_report(groups),
        "top_words": Wo.top_words(Wo.document_words(raw, stop_words)),
        "source_marker_counts_by_label": marker_counts,
        "source_marker_percentage_comparison": M.marker_gap(marker_counts),
    }


def write(tables: dict[str, DataFrame], out_dir: str) -> None:
    for name, table in tables.items():
        write_summary_csv(table, f"{out_dir}/{name}")


def examples(raw: DataFrame, per_class: int = 5) -> DataFrame:
    """A few seeded articles of each label with the start of their body."""
    raw = C.with_row_ids(C.normalized_names(raw))
    chosen = label_samples(raw.select(S.ROW_ID, S.LABEL), per_class)
    texts = raw.select(S.ROW_ID, S.TITLE, S.TEXT)
    return chosen.join(texts, S.ROW_ID).select(
        S.LABEL,
        strip(filled(F.col(S.TITLE))).alias(S.TITLE),
        preview(strip(filled(F.col(S.TEXT)))).alias("body_preview"),
    )

"""How often source markers occur in each class."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosemill import schema as S
from prosemill.functions.matching import found_markers
from prosemill.functions.text import round_half_even
from prosemill.operators.stage1 import class_name

# Source names looked for in the profile.
PROFILE_MARKERS = [
    "reuters",
    "associated press",
    "cnn",
    "fox news",
    "breitbart",
    "new york times",
    "nytimes",
    "washington post",
    "huffington post",
    "bbc",
    "the guardian",
    "daily mail",
]


def with_found_markers(df: DataFrame, column: str, markers: list[str], name: str) -> DataFrame:
    """Replace a text by the array of its markers; no row moves, and a text is searched once.

    The array has no more entries than the marker list.
    """
    found = found_markers(df, column, markers, "_found")
    return found.select(*[c for c in df.columns if c != column], F.col("_found").alias(name))


def marker_hits(
    found: DataFrame,
    columns: dict[str, str],
    markers: list[str],
    labels: Iterable[int] | None = None,
) -> DataFrame:
    """Rows (stage, marker, label, hits, class_rows), also for markers never found.

    `columns` names the array of found markers of every stage. One aggregate over
    the table with a sum per stage and marker: grouped by the labels that occur,
    or, with `labels`, with a sum for each of these, present or not.
    """
    cases = [(stage, marker, name) for stage, name in columns.items() for marker in markers]
    hit = [F.array_contains(name, marker) for _, marker, name in cases]
    if labels is None:
        labelled = found.where(F.col(S.LABEL).isNotNull())
        counts = labelled.groupBy(S.LABEL).agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.count_if(h).alias(f"_{i}") for i, h in enumerate(hit)],
        )
        entries = [
            _entry(stage, marker, F.col(S.LABEL), f"_{i}", "_rows")
            for i, (stage, marker, _) in enumerate(cases)
        ]
        return counts.select(F.inline(F.array(*entries)))
    sums, entries = [], []
    for label in labels:
        in_class = F.col(S.LABEL) == label
        sums.append(F.count_if(in_class).alias(f"_rows_{label}"))
        for i, (stage, marker, _) in enumerate(cases):
            sums.append(F.count_if(in_class & hit[i]).alias(f"_{label}_{i}"))
            value = F.lit(label).cast("int")
            entries.append(_entry(stage, marker, value, f"_{label}_{i}", f"_rows_{label}"))
    return found.agg(*sums).select(F.inline(F.array(*entries)))


def _entry(stage: str, marker: str, label: Column, hits: str, class_rows: str) -> Column:
    return F.struct(
        F.lit(stage).alias("stage"),
        F.lit(marker).alias("marker"),
        label.alias(S.LABEL),
        F.col(hits).alias("hits"),
        F.col(class_rows).alias("class_rows"),
    )


def marker_counts_by_label(hits: DataFrame) -> DataFrame:
    """Documents with each marker per label and their share, three digits."""
    share = F.col("hits") / F.col("class_rows") * 100
    return hits.select(
        "marker",
        S.LABEL,
        F.col("hits").alias("document_count"),
        round_half_even(share, 3).alias("document_percentage"),
    )


def marker_gap(counts: DataFrame, labels: tuple[int, int] = S.LABELS) -> DataFrame:
    """Shares of both classes side by side, largest gap of the rounded shares first."""
    first, second = (f"label_{value}_percentage" for value in labels)
    wide = (
        counts.groupBy("marker")
        .pivot(S.LABEL, list(labels))
        .agg(F.first("document_percentage"))
        .toDF("marker", first, second)
    )
    gap = F.abs(F.col(second) - F.col(first)).alias("absolute_gap")
    return wide.select("*", gap).orderBy(F.desc("absolute_gap"), "marker")


def marker_audit(hits: DataFrame) -> DataFrame:
    """Marker shares of every stage, four digits, 0 for an empty class."""
    share = F.when(F.col("class_rows") > 0, F.col("hits") / F.col("class_rows") * 100)
    return hits.select(
        "stage",
        "marker",
        S.LABEL,
        class_name(F.col(S.LABEL)).alias("class_name"),
        F.col("hits").alias("articles_with_marker"),
        F.col("class_rows").alias("class_articles"),
        round_half_even(F.coalesce(share, F.lit(0.0)), 4).alias("percentage"),
    )

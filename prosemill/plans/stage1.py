"""Raw articles to the four handoff tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from prosemill import schema as S
from prosemill.operators import columns as C
from prosemill.operators import stage1 as St
from prosemill.session import written
from prosemill.sources.csv import write_gzip_csv


@dataclass(frozen=True)
class Stage1:
    """The four tables, read from one written folder, and the count check."""

    master: DataFrame
    complete_cases: DataFrame
    incomplete_cases: DataFrame
    removed: DataFrame
    counts: DataFrame


def prepared(raw: DataFrame, *, file_order: bool = False) -> DataFrame:
    """Names, required columns, row ids and integer labels of a raw table, and the place of each
    row in the files if it is asked for."""
    named = C.require_columns(C.normalized_names(raw))
    more = []
    if file_order:
        named, more = C.with_read_position(named), [S.READ_POSITION]
    rows = C.with_row_ids(named).select(*S.RAW_SCHEMA.names, *more)
    return C.with_integer_labels(rows)


def run(
    raw: DataFrame,
    out_dir: str,
    *,
    expected: dict[str, int] | None = None,
    gzip_csv: bool = False,
    file_order: bool = False,
) -> Stage1:
    """Check, deduplicate, number, separate and write.

    The stripped rows are written once with their content key; ids then read keys and labels
    only. The numbered rows, behind the one shuffle of texts, are written once as well, in folders
    from which each table reads its own. Conflicting labels are found by the aggregate that finds
    the first copies, and stages are counted by the write. With `file_order` the first copy is the
    first in the files, and articles are numbered in that order; the table must come from files.
    """
    order = S.READ_POSITION if file_order else S.ROW_ID
    rows = St.stage1_rows(prepared(raw, file_order=file_order), *([order] if file_order else []))
    keyed = written(rows.withColumn(S.CONTENT_KEY, St.content_key(S.TITLE, S.TEXT)), "stage1")
    keyed = C.require_unique(C.require_label_domain(keyed), S.ROW_ID)
    narrow = keyed.select(S.ROW_ID, S.LABEL, S.CONTENT_KEY, *([order] if file_order else []))
    numbered = St.numbered_articles(keyed.drop(S.CONTENT_KEY), keyed=narrow, order=order, one_label=True)
    seen = Observation()
    measures = [value.alias(name) for name, value in St.stage_measures().items()]
    numbered = _written_by_part(numbered.observe(seen, *measures), f"{out_dir}/articles")
    counts = raw.sparkSession.createDataFrame(
        [[seen.get[name] for name in St.stage_measures()]], ", ".join(f"{name} long" for name in St.stage_measures())
    )
    rows_of = F.col("part")
    tables = {
        "master": numbered.where(rows_of != "removed").drop("part"),
        "complete_cases": numbered.where(rows_of == "complete").drop("part"),
        "incomplete_cases": numbered.where(rows_of == "incomplete").drop("part"),
        "removed": St.removed_copies(numbered.where(rows_of == "removed").drop("part")),
    }
    if gzip_csv:
        for name, df in tables.items():
            write_gzip_csv(df, f"{out_dir}/csv/{name}")
    return Stage1(**tables, counts=St.checked_counts(counts, expected))


def _written_by_part(numbered: DataFrame, path: str) -> DataFrame:
    """One write for all four tables: a folder each for complete, incomplete and removed rows."""
    part = F.when(F.col(S.ARTICLE_ID).isNull(), "removed").when(
        F.col("complete_case"), "complete"
    )
    parted = numbered.withColumn("part", part.otherwise("incomplete"))
    parted.write.mode("overwrite").partitionBy("part").parquet(path)
    return numbered.sparkSession.read.schema(parted.schema).parquet(path)


def label_counts(stage: Stage1) -> DataFrame:
    """Rows per label of master and complete cases."""
    flagged = stage.master.groupBy(S.LABEL).agg(
        F.count(F.lit(1)).alias("master"), F.count_if(F.col("complete_case")).alias("complete")
    )
    return flagged.orderBy(S.LABEL)

"""Complete cases to cleaned texts, marker audit, samples and report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from prosemill import schema as S
from prosemill.functions.cleaning import SOURCE_MARKERS
from prosemill.operators import cleaning as Cl
from prosemill.operators import markers as M
from prosemill.sources.csv import write_gzip_csv, write_spreadsheet_csv
from prosemill.sources.tables import write_report, write_table


@dataclass(frozen=True)
class Cleaned:
    """The written table and its checks."""

    articles: DataFrame
    marker_audit: DataFrame
    samples: DataFrame
    report: DataFrame


def audit(cleaned: DataFrame, markers: list[str]) -> DataFrame:
    """Marker shares before and after cleaning; both texts are searched in one pass."""
    narrow = cleaned.select(S.LABEL, "raw_title_body", "clean_title_body")
    narrow = M.with_found_markers(narrow, "raw_title_body", markers, "before")
    narrow = M.with_found_markers(narrow, "clean_title_body", markers, "after")
    columns = {"before_preprocessing": "before", "after_preprocessing": "after"}
    return M.marker_audit(M.marker_hits(narrow, columns, markers, S.LABELS))


def run(
    articles: DataFrame,
    out_dir: str,
    *,
    remove_markers: bool = True,
    markers: list[str] | None = None,
    csv: bool = False,
) -> Cleaned:
    """Clean once, write, and take audit, samples and report from the written table."""
    markers = SOURCE_MARKERS if markers is None else markers
    cleaned = Cl.cleaned_articles(articles, remove_markers=remove_markers, markers=markers)
    table = write_table(cleaned, f"{out_dir}/articles")
    found = audit(table, markers)
    samples = Cl.before_after_samples(table)
    report = Cl.quality_report(articles, table, remove_markers=remove_markers, markers=markers)
    write_spreadsheet_csv(found.coalesce(1), f"{out_dir}/source_marker_audit")
    write_spreadsheet_csv(samples.coalesce(1), f"{out_dir}/before_after_samples")
    write_report(report, f"{out_dir}/preprocessing_quality_report")
    if csv:
        write_spreadsheet_csv(table, f"{out_dir}/csv/articles")
        write_gzip_csv(table, f"{out_dir}/csv_gz/articles")
    return Cleaned(table, found, samples, report)

"""Headed CSV with quoted multi-line text, plain or gzip."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Cells that the usual Python reader takes for missing.
NA_VALUES = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
_QUOTING = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}
_VERBATIM = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
_BYTE_ORDER_MARK = "\ufeff"


_RECORD, _SURPLUS, _FILE = "_record", "_surplus", "_file"
_END_MARK = "\x01end\x01"
# Headers of several files are read by so many small jobs at a time.
HEADERS_AT_ONCE = 8


def read_csv(
    spark: SparkSession, path: str | list[str], *, na_values: Iterable[str] | None = NA_VALUES
) -> DataFrame:
    """Read all columns as text; gzip is recognized by its suffix.

    Nothing is inferred: a pass over the data to guess types is saved, and types
    are cast where they are needed. Cells in `na_values` become null (None for no
    such cells). An index column without a name becomes `unnamed: <position>`.

    Nothing is lost without a sign: a record with more cells than the header, or one cut short by a
    quote that is never closed, stops the query (see `read_csv_apart`), and so does a file with another header than the first one (see
    `read_csv_by_header`). A record with fewer cells has nulls in the others.
    """
    rows = _records(spark, path, _header(spark, path))
    message = F.concat(F.lit("A record has more cells than its header, or an open quote, in "), F.col(_FILE), F.lit(": "), F.substring(_RECORD, 1, 200))
    stopped = F.when(F.col(_SURPLUS), F.raise_error(message).cast("boolean")).otherwise(True)
    return _cells(rows.where(stopped), na_values)


def read_csv_apart(
    spark: SparkSession, path: str | list[str], *, na_values: Iterable[str] | None = NA_VALUES
) -> tuple[DataFrame, DataFrame]:
    """The records that fit their header, and apart from them (file, record) those that stop `read_csv`."""
    rows = _records(spark, path, _header(spark, path))
    rejected = rows.where(F.col(_SURPLUS)).select(F.col(_FILE).alias("file"), F.col(_RECORD).alias("record"))
    return _cells(rows.where(~F.col(_SURPLUS)), na_values), rejected


def read_csv_by_header(
    spark: SparkSession, path: str | list[str], *, na_values: Iterable[str] | None = NA_VALUES
) -> DataFrame:
    """Files with different headers as one table, by the names of their columns.

    Files are grouped by their header and the groups put together by name, in the order in which
    names first occur; a column that a file does not have is null. The first record of every file is
    read for it by a small job, so this is for a number of files that a driver can list.
    """
    files = sorted(row[0] for row in spark.read.format("binaryFile").load(path).select("path").collect())
    groups: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        for file, header in zip(files, pool.map(lambda f: _header(spark, f), files), strict=True):
            if header:
                groups.setdefault(tuple(header), []).append(file)
    if not groups:
        raise ValueError(f"No file with a header: {path}")
    return reduce(
        lambda one, other: one.unionByName(other, allowMissingColumns=True),
        [read_csv(spark, group, na_values=na_values) for group in groups.values()],
    )


def _header(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The cells of a first record, as they are; blank ones are empty."""
    options = {**_QUOTING, **_VERBATIM, "header": False}
    first = spark.read.options(multiLine=True, **options).csv(path).first()
    names = [cell or "" for cell in first] if first else []
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise ValueError(f"Duplicate column names in a header: {repeated}")
    return names


def _records(spark: SparkSession, path: str | list[str], header: list[str]) -> DataFrame:
    """Cells under `_0`, `_1` and so on, the file, and whether a record has more cells than the header.

    The reader gives the text of every record whose number of cells is not that of the header; only
    those are taken apart again, to tell records with more cells from those with fewer. A file
    whose header is not the given one stops the query where it is read.
    """
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*header, _RECORD]])
    options = {**_QUOTING, **_VERBATIM, "enforceSchema": False, "columnNameOfCorruptRecord": _RECORD}
    df = spark.read.schema(schema).options(multiLine=True, **options).csv(path)
    names = [f"_{i}" for i in range(len(header))]
    df = df.select("*", F.col("_metadata.file_path")).toDF(*names, _RECORD, _FILE)
    # an end mark as a further cell shows among the first cells if, and only if, there are no others;
    # it does not show either behind a quote that is never closed
    cells = ", ".join(f"c{i} string" for i in range(len(header) + 1))
    quoting = {name: _QUOTING[name] for name in ("quote", "escape")}
    marked = F.concat(F.regexp_replace(_RECORD, "[\r\n]+$", ""), F.lit("," + _END_MARK))
    again = F.from_csv(marked, F.lit(cells), quoting)
    ends = [F.coalesce(again[f"c{i}"] == _END_MARK, F.lit(False)) for i in range(len(header) + 1)]
    # always true: the reader refuses to give the records' texts without any of their cells
    with_a_cell = F.coalesce(F.length("_0"), F.lit(0)) >= 0
    df = df.withColumn(_SURPLUS, F.col(_RECORD).isNotNull() & with_a_cell & ~reduce(lambda x, y: x | y, ends))
    return df.withMetadata(_SURPLUS, {"header": header})


def _cells(rows: DataFrame, na_values: Iterable[str] | None) -> DataFrame:
    header = rows.schema[_SURPLUS].metadata["header"]
    missing = None if na_values is None else list(na_values)
    cells = []
    for i, name in enumerate(header):
        cell = F.col(f"_{i}")
        cell = cell if missing is None else F.when(~cell.isin(missing), cell)
        cells.append(cell.alias(_column_name(name, i)))
    return rows.select(*cells)


def _column_name(name: str, position: int) -> str:
    name = name.removeprefix(_BYTE_ORDER_MARK)
    return name or f"unnamed: {position}"


def _writer(df: DataFrame, **options):
    options = {**_QUOTING, **_VERBATIM, "emptyValue": "", "nullValue": "", **options}
    return df.write.mode("overwrite").options(**options)


def write_gzip_csv(df: DataFrame, path: str) -> None:
    """Gzip CSV parts, UTF-8, one header per part, null and blank both empty."""
    _writer(df, compression="gzip").csv(path)


def write_spreadsheet_csv(df: DataFrame, path: str) -> None:
    """CSV parts that start with a byte order mark, for spreadsheet programs.

    Every part starts with its header, so the mark is put before the first name.
    """
    first, *others = df.columns
    _writer(df.toDF(_BYTE_ORDER_MARK + first, *others)).csv(path)


def write_summary_csv(df: DataFrame, path: str) -> None:
    """One CSV file, for results that are small by nature and already in order."""
    _writer(df.coalesce(1)).csv(path)

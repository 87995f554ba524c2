"""Schema checks and column-level operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill import schema as S


def normalized_names(df: DataFrame) -> DataFrame:
    """Trim and lower all column names."""
    return df.toDF(*[name.strip().lower() for name in df.columns])


def require_columns(df: DataFrame, required: Iterable[str] = S.REQUIRED_COLUMNS) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"These columns are needed and not there: {missing}")
    return df


def reject_duplicate_names(df: DataFrame) -> DataFrame:
    repeated = sorted({name for name in df.columns if df.columns.count(name) > 1})
    if repeated:
        raise ValueError(f"Duplicate column names: {repeated}")
    return df


def drop_serial_columns(df: DataFrame) -> DataFrame:
    """Drop columns left over from an index, in any letter case."""
    return df.drop(*[name for name in df.columns if name.lower().startswith("unnamed:")])


def drop_generated_columns(df: DataFrame) -> DataFrame:
    """Drop what an earlier cleaning run left behind."""
    return df.drop(*S.GENERATED_COLUMNS)


def preferred_order(df: DataFrame, order: Iterable[str] = tuple(S.CLEANED_COLUMNS)) -> DataFrame:
    """Known columns in their fixed order, the others behind them."""
    known = [name for name in order if name in df.columns]
    return df.select(*known, *[name for name in df.columns if name not in known])


def present_columns(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Select those of the wanted columns that exist."""
    return df.select(*[name for name in wanted if name in df.columns])


def with_row_ids(df: DataFrame, serial: str = "unnamed: 0") -> DataFrame:
    """Use the serial column as row id, or number the rows in read order."""
    if S.ROW_ID in df.columns:
        return df.withColumn(S.ROW_ID, F.col(S.ROW_ID).cast("long"))
    if serial in df.columns:
        renamed = df.withColumnRenamed(serial, S.ROW_ID)
        return renamed.withColumn(S.ROW_ID, F.col(S.ROW_ID).cast("long"))
    return numbered_in_read_order(df)


def numbered_in_read_order(df: DataFrame, name: str = S.ROW_ID) -> DataFrame:
    """0..n-1 in file order, then position in the file.

    Rows of one input split are read one after the other, so their position is a
    difference of increasing ids. Splits are added up within their file, and files
    among themselves, so a window sees one row for each file; the offsets join back
    by split. The frame must come straight from files.
    """
    tagged = df.select(
        "*",
        F.monotonically_increasing_id().alias("_position"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )
    splits = tagged.groupBy("_file", "_block").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_position").alias("_first")
    )
    files = splits.groupBy("_file").agg(F.sum("_rows").alias("_file_rows"))
    before = files.select("_file", F.expr("sum(_file_rows) over (order by _file) - _file_rows").alias("_before"))
    inside = F.expr("sum(_rows) over (partition by _file order by _block) - _rows")
    offsets = splits.withColumn("_inside", inside).join(before, "_file").select(
        "_file", "_block", "_first", (F.col("_inside") + F.col("_before")).alias("_offset")
    )
    row_id = F.col("_offset") + F.col("_position") - F.col("_first")
    return tagged.join(offsets, ["_file", "_block"]).select(row_id.alias(name), *df.columns)


def with_read_position(df: DataFrame) -> DataFrame:
    """Add where a row stands: 0..n-1 over the files in order. The frame must come from files."""
    return numbered_in_read_order(df, S.READ_POSITION)


def first_rows(df: DataFrame, rows: int = 5, *, order: str = S.ROW_ID) -> DataFrame:
    """The first rows of a table by its row id; each task keeps no more than that many."""
    return df.orderBy(order).limit(rows)


def with_integer_labels(df: DataFrame) -> DataFrame:
    """Cast the label to int; a missing or non-numeric label stops the run."""
    number = F.expr(f"try_cast(trim(cast({S.LABEL} as string)) as double)")
    checked = F.when(number.isNull(), F.raise_error(F.lit("Label is missing or not numeric.")))
    return df.withColumn(S.LABEL, checked.otherwise(number).cast("int"))


def with_nullable_labels(df: DataFrame) -> DataFrame:
    """Cast the label to int, also if it is written as 1.0; a missing one stays missing, and a
    text that is no number stops the run."""
    text = F.trim(F.col(S.LABEL).cast("string"))
    number = text.try_cast("double")
    broken = (text != "") & number.isNull()
    checked = F.when(broken, F.raise_error(F.concat(F.lit("A label is no number: "), text)))
    return df.withColumn(S.LABEL, checked.otherwise(number).cast("int"))


def label_domain(df: DataFrame) -> DataFrame:
    """Distinct labels in order."""
    return df.select(S.LABEL).distinct().orderBy(S.LABEL)


def require_label_domain(df: DataFrame, labels: Iterable[int] = S.LABELS) -> DataFrame:
    """Stop if a label outside the domain occurs. Reads the label column only."""
    unexpected = (
        df.select(S.LABEL).where(~F.col(S.LABEL).isin(*labels)).distinct().orderBy(S.LABEL)
    )
    found = [row[0] for row in unexpected.limit(21).collect()]
    if found:
        count = unexpected.count() if len(found) > 20 else len(found)
        raise ValueError(f"{count} labels are outside the domain, the first are: {found[:20]}")
    return df


def require_unique(df: DataFrame, column: str) -> DataFrame:
    """Stop if a value occurs twice or is missing. Shuffles this column only."""
    repeated = df.groupBy(column).count().where((F.col("count") > 1) | F.col(column).isNull())
    if not repeated.isEmpty():
        raise ValueError(f"Column {column} is not a unique key.")
    return df


def column_overview(df: DataFrame) -> DataFrame:
    """Position, name, type and filled or missing values of every column, one pass."""
    names = [name for name, _ in df.dtypes]
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(F.col(name)).alias(f"_{i}") for i, name in enumerate(names)],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(name).alias("column_name"),
                F.lit(kind).alias("data_type"),
                F.col(f"_{i}").alias("filled"),
                (F.col("rows") - F.col(f"_{i}")).alias("missing"),
            )
            for i, (name, kind) in enumerate(df.dtypes)
        ]
    )
    return counts.select(F.inline(entries))

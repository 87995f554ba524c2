"""Exact dense ranks without a window over the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ID_BITS = 20
HASH_BITS = 16


def ranked_by_id(ids: DataFrame, id_col: str, name: str, *, bits: int = ID_BITS) -> DataFrame:
    """Add the dense rank from 0 of a unique long id.

    A bucket is a run of 2^bits neighbouring ids, so it can hold no more than
    2^bits rows whatever the data look like. Buckets are added up within ranges
    of 2^bits buckets, ranges within wide ranges of 2^bits ranges, and those among
    themselves, of which a long id has 2^(64 - 3 bits) at most: every window below
    is bounded by the width of an id, not by the number of rows.
    """
    bucketed = ids.withColumn("_bucket", F.shiftright(F.col(id_col), bits))
    buckets = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    ranged = buckets.withColumn("_range", F.shiftright(F.col("_bucket"), bits))
    ranges = ranged.groupBy("_range").agg(F.sum("_rows").alias("_range_rows"))
    widened = ranges.withColumn("_wide", F.shiftright(F.col("_range"), bits))
    wides = widened.groupBy("_wide").agg(F.sum("_range_rows").alias("_wide_rows"))
    before_wide = wides.withColumn(
        "_before_wide", F.sum("_wide_rows").over(Window.orderBy("_wide")) - F.col("_wide_rows")
    ).select("_wide", "_before_wide")
    in_wide = Window.partitionBy("_wide").orderBy("_range")
    before_range = (
        widened.withColumn("_inside", F.sum("_range_rows").over(in_wide) - F.col("_range_rows"))
        .join(before_wide, "_wide")
        .select("_range", (F.col("_inside") + F.col("_before_wide")).alias("_before_range"))
    )
    in_range = Window.partitionBy("_range").orderBy("_bucket")
    offsets = (
        ranged.withColumn("_before", F.sum("_rows").over(in_range) - F.col("_rows"))
        .join(before_range, "_range")
        .select("_bucket", (F.col("_before") + F.col("_before_range")).alias("_offset"))
    )
    in_bucket = Window.partitionBy("_bucket").orderBy(id_col)
    return (
        bucketed.withColumn("_position", F.row_number().over(in_bucket))
        .join(offsets, "_bucket")
        .select(*ids.columns, (F.col("_offset") + F.col("_position") - 1).alias(name))
    )


def with_random_order(df: DataFrame, id_col: str, seed: int) -> DataFrame:
    """Add a reproducible random order and its bucket, both from id and seed alone."""
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    hex_digits = HASH_BITS // 4
    return df.withColumn("_order", order).withColumn(
        "_bucket", F.conv(F.substring("_order", 1, hex_digits), 16, 10).cast("int")
    )


def bucket_sizes(ordered: DataFrame, stratum: str) -> DataFrame:
    """Rows of every bucket of every stratum."""
    return ordered.groupBy(stratum, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))


def ranked_up_to(
    ordered: DataFrame, takes: DataFrame, stratum: str, name: str, id_col: str, sizes: DataFrame | None = None
) -> DataFrame:
    """Rank rows in random order within the stratum; keep ranks below the stratum's `take`.

    `takes` has a row for each stratum that is wanted; its other columns come along. Buckets
    are counted first (give `sizes` if they are known), and those behind the limit are dropped by the join on bucket. No task
    sees more than one bucket at a time.
    """
    sizes = bucket_sizes(ordered, stratum) if sizes is None else sizes
    running = Window.partitionBy(stratum).orderBy("_bucket")
    offsets = (
        sizes.withColumn("_offset", F.sum("_rows").over(running) - F.col("_rows"))
        .join(takes, stratum)
        .where(F.col("_offset") < F.col("take"))
        .drop("_rows")
    )
    in_bucket = Window.partitionBy(stratum, "_bucket").orderBy("_order", id_col)
    return (
        ordered.join(offsets, [stratum, "_bucket"])
        .withColumn("_position", F.row_number().over(in_bucket))
        .withColumn(name, F.col("_offset") + F.col("_position") - 1)
        .where(F.col(name) < F.col("take"))
        .drop("_position", "_offset", "_bucket", "_order", "take")
    )

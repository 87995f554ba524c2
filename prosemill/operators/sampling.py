"""Balanced samples and stratified splits with exact sizes and a seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prosemill import schema as S
from prosemill.operators.ranking import bucket_sizes, ranked_up_to, with_random_order

# Seeds of the sample and split step and of the inspected examples.
SPLIT_SEED = 123
EXAMPLE_SEED = 503
# Part of the rows kept back, and part of those that goes to test.
HOLDOUT_SHARE = 0.2
TEST_SHARE = 0.5
# Error messages show so many values, and say how many there are.
SHOWN = 20


def class_sizes(df: DataFrame) -> DataFrame:
    """Rows (label, rows) of every label, without rows that have none."""
    labelled = df.select(S.LABEL).where(F.col(S.LABEL).isNotNull())
    return labelled.groupBy(S.LABEL).agg(F.count(F.lit(1)).alias("rows"))


def sample_sizes(sizes: DataFrame, per_class: int | None) -> DataFrame:
    """`per_class` rows for each label, or all rows if any class is smaller."""
    if per_class is None:
        return sizes
    smallest = F.min("rows").over(Window.partitionBy())  # a row for each class
    return sizes.withColumn("rows", F.when(smallest < per_class, F.col("rows")).otherwise(per_class))


def shared_out(weights: DataFrame, total: Column | int, weight: str, name: str) -> DataFrame:
    """Share a total over the labels by largest remainder, ties to the lower label.

    The window sees one row for each class.
    """
    weight_sum = F.sum(weight).over(Window.partitionBy())
    exact = weights.withColumn("_exact", F.col(weight) / weight_sum * total)
    whole = exact.withColumn("_whole", F.floor("_exact"))
    by_remainder = Window.orderBy(F.desc(F.col("_exact") - F.col("_whole")), S.LABEL)
    ranked = whole.withColumn("_place", F.row_number().over(by_remainder))
    extra = F.col("_place") <= F.lit(total) - F.sum("_whole").over(Window.partitionBy())
    quota = F.col("_whole") + F.when(extra, 1).otherwise(0)
    return ranked.withColumn(name, quota.cast("long")).drop("_exact", "_whole", "_place")


def refused_if(refused: Column, message: str, passed: Column) -> Column:
    """`passed`, or an error that stops the query where it runs."""
    return F.when(F.coalesce(refused, F.lit(True)), F.raise_error(F.lit(message))).otherwise(passed)


TOO_FEW = "Too few rows in a class for a stratified split."


def split_quotas(sizes: DataFrame) -> DataFrame:
    """Rows (label, rows, train, val) for each label; the rest is test.

    The totals are rounded as a whole: the holdout up, its test half up. Refused are classes
    with fewer than two rows, or fewer than two held-out ones, and parts with fewer rows than
    there are classes. The refusal is part of the plan: it stops the query that uses the quotas.
    """
    everything = Window.partitionBy()  # a row for each class
    total = F.col("_total")
    held = F.ceil(total * HOLDOUT_SHARE)
    test_total = F.ceil(held * TEST_SHARE)
    val_total = held - test_total
    least = F.least(total - held, val_total, test_total)
    known = sizes.withColumns(
        {"_total": F.sum("rows").over(everything), "_classes": F.count(F.lit(1)).over(everything), "_smallest": F.min("rows").over(everything)}
    )
    small = (F.col("_smallest") < 2) | (least < F.col("_classes"))
    known = known.withColumn("rows", refused_if(small, TOO_FEW, F.col("rows"))).drop("_classes", "_smallest")
    train = shared_out(known, total - held, "rows", "train")
    rest = train.withColumn("_rest", F.col("rows") - F.col("train"))
    rest = rest.withColumn("_least", F.min("_rest").over(everything))
    rest = rest.withColumns({name: refused_if(F.col("_least") < 2, TOO_FEW, F.col(name)) for name in ("rows", "_rest")}).drop("_least")
    return shared_out(rest, val_total, "_rest", "val").drop("_rest", "_total")


def downsample(
    df: DataFrame, per_class: int, *, seed: int = SPLIT_SEED, id_col: str = S.ARTICLE_ID
) -> DataFrame:
    """Exactly `per_class` rows of each label, or the table as it is if any class is smaller."""
    sizes = class_sizes(df)
    if (sizes.agg(F.min("rows")).first()[0] or 0) < per_class:
        return df
    return _taken(df, sizes.withColumn("rows", F.lit(per_class).cast("long")), seed, id_col)


def label_samples(
    df: DataFrame, per_class: int = 5, *, seed: int = EXAMPLE_SEED, id_col: str = S.ROW_ID
) -> DataFrame:
    """Exactly `per_class` rows of each label; too small a class is an error."""
    sizes = class_sizes(df)
    short = sizes.where(F.col("rows") < per_class)
    count = short.count()
    if count:
        first = [row[0] for row in short.orderBy(S.LABEL).limit(SHOWN).collect()]
        raise ValueError(
            f"Fewer than {per_class} rows to sample from for labels (first {len(first)} of {count}): {first}"
        )
    return _taken(df, sizes.withColumn("rows", F.lit(per_class).cast("long")), seed, id_col)


def _taken(df: DataFrame, sizes: DataFrame, seed: int, id_col: str) -> DataFrame:
    ordered = with_random_order(df, id_col, seed)
    takes = sizes.select(S.LABEL, F.col("rows").alias("take"))
    return ranked_up_to(ordered, takes, S.LABEL, "_rank", id_col).select(*df.columns)


def sample_and_split(
    df: DataFrame,
    per_class: int | None = None,
    *,
    seed: int = SPLIT_SEED,
    id_col: str = S.ARTICLE_ID,
) -> DataFrame:
    """Rows (id, label, split): sample and 80/10/10 split in one ranked pass.

    Ranks below the sample size are in random order already, so the first of
    them are train, the next val and the rest test. Only ids and labels are read, and no job
    is started here. Classes are added up from the buckets that the ranks need anyway.
    """
    labelled = df.select(id_col, S.LABEL).where(F.col(S.LABEL).isNotNull())
    ordered = with_random_order(labelled, id_col, seed)
    buckets = bucket_sizes(ordered, S.LABEL)
    sizes = buckets.groupBy(S.LABEL).agg(F.sum("_rows").alias("rows"))
    quotas = split_quotas(sample_sizes(sizes, per_class))
    takes = quotas.select(
        S.LABEL,
        F.col("rows").alias("take"),
        F.col("train").alias("_train_end"),
        (F.col("train") + F.col("val")).alias("_val_end"),
    )
    ranked = ranked_up_to(ordered, takes, S.LABEL, "_rank", id_col, buckets)
    split = (
        F.when(F.col("_rank") < F.col("_train_end"), S.SPLITS[0])
        .when(F.col("_rank") < F.col("_val_end"), S.SPLITS[1])
        .otherwise(S.SPLITS[2])
    )
    found = ranked.select(id_col, S.LABEL, split.alias("split"))
    nothing = sizes.agg(F.count(F.lit(1)).alias("classes")).where("classes = 0")
    return found.unionByName(_stopped(nothing, F.lit(TOO_FEW), found))


def _stopped(faults: DataFrame, message: Column, like: DataFrame) -> DataFrame:
    """A table without rows, or an error if there are faults; to be put beside a table like it."""
    stopped = faults.where(F.raise_error(message).cast("boolean"))
    return stopped.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in like.schema])


def split_texts(
    split: DataFrame, articles: DataFrame, columns: list[str], *, id_col: str = S.ARTICLE_ID
) -> DataFrame:
    """Look up the texts of the split rows; a missing text is blank, a missing article stops the query.

    Give a written split: its size is then known, so a small one is broadcast to
    the texts where they lie, and a large one is joined on the unique id. The join
    is an inner one because an outer one could not broadcast the split. Ids without an article
    are found among the ids alone, as a second branch of the same plan that gives no rows.
    """
    texts = [F.coalesce(F.col(name), F.lit("")).alias(name) for name in columns]
    found = split.join(articles.select(id_col, *texts), id_col).select(*split.columns, *columns)
    lost = split.select(id_col).join(articles.select(id_col), id_col, "left_anti")
    message = F.concat(F.lit("No article for ids: "), F.col("ids").cast("string"), F.lit(", the smallest is "), F.col("first").cast("string"))
    lost = lost.agg(F.count(F.lit(1)).alias("ids"), F.min(id_col).alias("first")).where("ids > 0")
    return found.unionByName(_stopped(lost, message, found))

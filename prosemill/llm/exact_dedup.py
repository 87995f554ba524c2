"""Exact deduplication as a stream with keyed state that never expires.

Rows are first written as an arrival log in the shared folder; a row's number in that log is its
content locator. A stream over the log keeps, on disk (RocksDB), one entry per digest: the largest
id seen, the locator of that row and how many rows had the digest. Built-in aggregation folds rows
before they are shuffled, so a text that fills a third of the table sends one row per task and
batch. On a hit the full bytes are compared with those at the locator; should two texts ever share
a digest, the rows of that digest are grouped by the text itself.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosemill.llm.shared import kept, new_folder

#: State store settings: on disk, with its memory bounded on each executor.
STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
    # stores of a stream that has ended are closed soon
    "spark.sql.streaming.stateStore.maintenanceInterval": "10s",
    # many small stores: no room is set aside on disk before it is needed
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # each batch writes only what it changed
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
SHUFFLES = "spark.sql.shuffle.partitions"
#: The log arrives in about so many batches.
BATCHES = 3
#: Rows that one copy of a kept text is compared with, at most (about).
COMPARED = 1000
#: At most so many digests can be called hot, which bounds what is broadcast.
MOST_HOT, LEAST_HOT = 10_000, 10_000


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _text(row: str) -> Column:
    return F.coalesce(F.col(f"{row}.text"), F.lit(""))


def _log(df: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """The arrival log: every row as it is, its id, digest and locator."""
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    rows = rows.select("row", F.col("row.doc_id").alias("doc_id"), digest(_text("row")).alias("digest"))
    return kept(rows.withColumn("locator", F.monotonically_increasing_id()), "arrivals")


def _state(log: DataFrame) -> DataFrame:
    """One row per digest: the keeper (largest id, then locator) and the number of rows."""
    spark = log.sparkSession
    files = log.inputFiles()
    if not files:
        entry = F.struct("doc_id", "locator")
        return log.groupBy("digest").agg(F.max(entry).alias("keeper"), F.count(F.lit(1)).alias("group_size"))
    folder = files[0].rsplit("/", 1)[0]
    updates, progress = new_folder(spark, "state_updates"), new_folder(spark, "state_progress")

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{updates}/batch={number}")

    # a session of its own, so that the settings of the caller's stay as they are meanwhile
    session = spark.newSession()
    for name, value in (STATE | {SHUFFLES: spark.conf.get(SHUFFLES)}).items():
        session.conf.set(name, value)
    stream = (
        session.readStream.schema(log.schema)
        .option("maxFilesPerTrigger", math.ceil(len(files) / BATCHES))
        .parquet(folder)
        .groupBy("digest")
        .agg(F.max(F.struct("doc_id", "locator")).alias("keeper"), F.count(F.lit(1)).alias("group_size"))
    )
    query = (
        stream.writeStream.outputMode("update")
        .foreachBatch(store)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    seen = spark.read.schema(stream.schema).parquet(updates)
    # a digest is written again whenever it grows: keepers and counts only rise
    return seen.groupBy("digest").agg(F.max("keeper").alias("keeper"), F.max("group_size").alias("group_size"))


def _groups(log: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Locator, digest, keeper and group size of every row, by digest.

    Digests with many rows are looked up by a broadcast: more than rows / MOST_HOT rows each, so
    there are fewer than MOST_HOT of them. The others meet by a shuffle of narrow rows.
    """
    state = kept(_state(log).where("group_size > 1"), "repeated")
    total = log.count()
    limit = max(LEAST_HOT, total // MOST_HOT)
    hot, cold = state.where(F.col("group_size") > limit), state.where(F.col("group_size") <= limit)
    rows = log.select("doc_id", "locator", "digest")
    own = F.struct("doc_id", "locator")
    in_hot = rows.join(F.broadcast(hot), "digest")
    in_cold = rows.join(F.broadcast(hot.select("digest")), "digest", "left_anti").join(cold, "digest", "left")
    return in_hot.unionByName(in_cold).select(
        "doc_id", "locator", "digest",
        F.coalesce("keeper", own).alias("keeper"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
    )


def _collided(log: DataFrame, groups: DataFrame) -> DataFrame:
    """Digests that different texts share: every hit's bytes are compared with its keeper's.

    A kept text is copied once per COMPARED hits and each copy meets its share of them, so no
    task gets all rows of a large group.
    """
    copies = F.ceil(F.col("group_size") / COMPARED).cast("int")
    is_keeper = F.col("locator") == F.col("keeper.locator")
    own_copy = F.pmod(F.xxhash64("locator"), copies).cast("int")
    wanted = groups.where("group_size > 1").select(
        "locator", F.col("keeper.locator").alias("kept_at"), is_keeper.alias("is_keeper"),
        F.when(is_keeper, F.sequence(F.lit(0), copies - 1)).otherwise(F.array(own_copy)).alias("copies"),
    )
    texts = log.select("locator", "digest", _text("row").alias("content")).join(wanted, "locator")
    placed = kept(texts.withColumn("copy", F.explode("copies")).drop("copies"), "hits")
    keepers = placed.where("is_keeper").select("kept_at", "copy", F.col("content").alias("kept_content"))
    differ = placed.where("NOT is_keeper").join(keepers, ["kept_at", "copy"]).where("content != kept_content")
    return kept(differ.select("digest").distinct(), "collided")


def exact_groups(df: DataFrame, digest: Callable[[Column], Column] = sha256) -> tuple[DataFrame, DataFrame]:
    """The arrival log, and per row its locator, keeper (id and locator) and group size.

    Texts are equal when their bytes are; a null text counts as empty. Of equal texts the row with
    the largest id stays, a null id being the smallest; of repeated rows with that id the last in
    the log stays. Texts of any length are compared whole; an empty table gives no rows; other columns
    stay in the log as they came.
    """
    log = _log(df, digest)
    groups = kept(_groups(log, digest), "exact_groups")
    collided = _collided(log, groups)
    if collided.isEmpty():
        return log, groups
    mixed = log.join(collided, "digest", "left_semi").select("doc_id", "locator", "digest", _text("row").alias("content"))
    apart = mixed.groupBy("digest", "content").agg(
        F.max(F.struct("doc_id", "locator")).alias("keeper"), F.count(F.lit(1)).alias("group_size")
    )
    again = mixed.join(apart, ["digest", "content"]).select("doc_id", "locator", "digest", "keeper", "group_size")
    return log, kept(groups.join(collided, "digest", "left_anti").unionByName(again), "exact_groups")


def dedup_report(df: DataFrame) -> DataFrame:
    """One row per row: id, the id that stays, group size, whether it stays, sha256 of the text."""
    _, groups = exact_groups(df)
    return groups.select(
        "doc_id",
        F.col("keeper.doc_id").alias("keep_id"),
        "group_size",
        (F.col("locator") == F.col("keeper.locator")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_copies(df: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns as they came."""
    log, groups = exact_groups(df)
    dropped = groups.where(F.col("locator") != F.col("keeper.locator")).select("locator")
    return log.join(dropped, "locator", "left_anti").select("row.*")

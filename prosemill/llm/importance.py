"""Drawing documents that look like a target: importance weights with a bounded number of buckets.

Features (runs of words) fall into buckets by crc32; the gain of a bucket compares its share in the
target with its share in the corpus. A document's weight is the mean gain of its features, and its
score adds Gumbel noise that depends on its id alone, so the highest scores are a draw without
replacement. The last score drawn is found by a weighted median of medians: blocks of keys send
their medians and sizes, and each round discards a fixed share of the keys that are left.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prosemill.llm import frames
from prosemill.llm.decontamination import words_of
from prosemill.llm.shared import kept

#: Words of the longest feature; buckets; scale of gains and noise; words a drawn document needs;
#: per cent of them to draw; seed of the noise.
LONGEST, BUCKETS, SCALE, LEAST_WORDS, PERCENT, SEED = 1, 10_000, 1000, 20, 10, 2024
#: A median is that of so many keys at most, which bounds a task's memory.
BLOCK = 1 << 20
#: So few keys are sorted where the driver runs.
FEW = 4096
#: Keys are written again when so few of them are left (one in).
SHRINK = 4


class Features(NamedTuple):
    """Features of some texts, side by side."""

    buckets: np.ndarray
    rows: np.ndarray  # the text of each feature
    words: np.ndarray  # words of each text


def features(texts: list[str], longest: int = LONGEST, buckets: int = BUCKETS) -> Features:
    found = list(map(words_of, texts))
    words = np.fromiter(map(len, found), np.int64, len(found))
    flat = pa.array(itertools.chain.from_iterable(found), pa.binary())
    stop = np.repeat(np.cumsum(words), words)
    row = np.repeat(np.arange(len(found)), words)
    numbers, rows = [], []
    for size in range(1, longest + 1):
        at = np.flatnonzero(np.arange(len(flat)) + size <= stop)
        parts = [flat.take(pa.array(at + j)) for j in range(size)]
        runs = (pc.binary_join_element_wise(*parts, b" ") if size > 1 else parts[0]).dictionary_encode()
        crcs = np.fromiter(map(zlib.crc32, runs.dictionary.to_pylist()), np.int64, len(runs.dictionary)) % buckets
        numbers.append(crcs[runs.indices.to_numpy()])
        rows.append(row[at])
    return Features(np.concatenate(numbers), np.concatenate(rows), words)


def bucket_counts(df: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all texts: one row a bucket leaves each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in frames.slices(batch):
                counts += np.bincount(features(part.column("text").to_pylist(), longest, buckets).buckets, minlength=buckets)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], names=["bucket", "n"])

    texts = df.select(F.coalesce("text", F.lit("")).alias("text"))
    rows = texts.mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(buckets, np.int64)
    counts[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return counts


def gains(corpus: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * ln of (share in the target / share in the corpus)) of every bucket, smoothed by one."""
    size, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    found = [
        math.floor(scale * math.log((float(t) + 1) * (s_all + size) / ((float(s) + 1) * (t_all + size))))
        for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
    ]
    return np.array(found, np.int64)


def noise(doc_id: int | None, seed: int = SEED, scale: int = SCALE) -> int:
    """Gumbel noise that depends on seed and id alone; a null id counts as a blank text."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-scale * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(df: DataFrame, found: np.ndarray, longest: int = LONGEST, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """Per row: id, words, features, weight, score, and a number of its own (`locator`)."""
    sent = df.sparkSession.sparkContext.broadcast(found)
    fields = "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in frames.slices(batch):
                seen = features(part.column("text").to_pylist(), longest, len(sent.value))
                sizes, sums = np.bincount(seen.rows, minlength=len(seen.words)), np.zeros(len(seen.words), np.int64)
                np.add.at(sums, seen.rows, sent.value[seen.buckets])
                weights = np.where(sizes > 0, sums // np.maximum(sizes, 1), 0)
                ids = part.column("doc_id")
                drawn = weights + np.array([noise(i, seed, scale) for i in ids.to_pylist()], np.int64)
                columns = [ids.cast(pa.int64()), *(pa.array(c, pa.int64()) for c in (seen.words, sizes, weights, drawn))]
                yield pa.RecordBatch.from_arrays(columns, schema=frames.arrow_schema(fields))

    rows = frames.texts(df).mapInArrow(run, fields)
    return kept(rows.withColumn("locator", F.monotonically_increasing_id()), "scores")


class Key(NamedTuple):
    """Place of a row in the order of drawing: highest score, smallest id (null last), locator."""

    score: int
    doc_id: int | None
    locator: int

    def order(self) -> tuple[int, int, int, int]:
        return -self.score, int(self.doc_id is None), self.doc_id or 0, self.locator

    def reached(self) -> Column:
        """Whether a row is drawn no later than this key."""
        score, doc_id, locator = F.col("score"), F.col("doc_id"), F.lit(self.locator)
        if self.doc_id is None:
            tie = doc_id.isNotNull() | (F.col("locator") <= locator)
        else:
            tie = (doc_id < self.doc_id) | ((doc_id == self.doc_id) & (F.col("locator") <= locator))
        return (score > self.score) | ((score == self.score) & F.coalesce(tie, F.lit(False)))


KEYS = "score bigint, doc_id bigint, locator bigint"
SIDES = "side int, size bigint, score bigint, doc_id bigint, locator bigint"


def _median(keys: pa.RecordBatch) -> Key:
    score, locator = keys.column("score").to_numpy(), keys.column("locator").to_numpy()
    ids = keys.column("doc_id")
    order = np.lexsort((locator, pc.fill_null(ids, 0).to_numpy(), pc.is_null(ids).to_numpy(zero_copy_only=False), -score))
    row = int(order[(len(order) - 1) // 2])
    return Key(*(keys.column(name)[row].as_py() for name in Key._fields))


def _reached(keys: pa.RecordBatch, pivot: Key) -> np.ndarray:
    """Which keys are drawn no later than the pivot."""
    score, locator, ids = keys.column("score").to_numpy(), keys.column("locator").to_numpy(), keys.column("doc_id")
    null, number = pc.is_null(ids).to_numpy(zero_copy_only=False), pc.fill_null(ids, 0).to_numpy()
    if pivot.doc_id is None:
        tie = ~null | (locator <= pivot.locator)
    else:
        tie = ~null & ((number < pivot.doc_id) | ((number == pivot.doc_id) & (locator <= pivot.locator)))
    return (score > pivot.score) | ((score == pivot.score) & tie)


def _sides(keys: DataFrame, pivot: Key | None, block_keys: int) -> list[list[tuple[int, Key]]]:
    """Size and median, per block, of the keys drawn before the pivot and of those after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[pa.RecordBatch]] = [[], []]

        def closed(side: int) -> pa.RecordBatch:
            block = pa.Table.from_batches(held[side]).combine_chunks().to_batches()[0]
            held[side] = []
            row = (side, block.num_rows, *_median(block))
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        schema = frames.arrow_schema(SIDES)
        for batch in batches:
            before = np.ones(batch.num_rows, dtype=bool) if pivot is None else _reached(batch, pivot)
            at_pivot = np.zeros(batch.num_rows, dtype=bool)
            if pivot is not None:
                at_pivot = batch.column("locator").to_numpy() == pivot.locator
            for side, chosen in enumerate((before & ~at_pivot, ~before)):
                found = batch.filter(pa.array(chosen))
                if found.num_rows:
                    held[side].append(found)
                    if sum(b.num_rows for b in held[side]) >= block_keys:
                        yield closed(side)
        for side in (0, 1):
            if held[side]:
                yield closed(side)

    sides: list[list[tuple[int, Key]]] = [[], []]
    for row in keys.mapInArrow(run, SIDES).collect():  # one or two rows a block
        sides[row["side"]].append((row["size"], Key(row["score"], row["doc_id"], row["locator"])))
    return sides


def weighted_median(medians: list[tuple[int, Key]]) -> Key:
    """The median at which half of all sizes are reached."""
    ranked = sorted(medians, key=lambda m: m[1].order())
    half, seen = sum(size for size, _ in ranked) / 2, 0
    for size, key in ranked:
        seen += size
        if seen >= half:
            return key
    raise ValueError("No keys.")


def cutoff(keys: DataFrame, count: int, block_keys: int = BLOCK, few: int = FEW) -> Key | None:
    """The key drawn as number `count`; None if there is none.

    At least half of the blocks' keys lie beyond their medians on either side of the pivot, so each
    round discards a quarter of the keys that are left, or more.
    """
    written, wanted = keys, count
    low: Key | None = None  # everything up to it is drawn
    high: Key | None = None  # everything from it on is not
    medians = _sides(keys, None, block_keys)[0]
    left = size = sum(n for n, _ in medians)
    if count <= 0 or count > left:
        return None

    def between() -> DataFrame:
        rows = written
        if low is not None:
            rows = rows.where(~low.reached())
        return rows if high is None else rows.where(high.reached() & (F.col("locator") != high.locator))

    while left > few:
        pivot = weighted_median(medians)
        sides = _sides(between(), pivot, block_keys)
        before = sum(n for n, _ in sides[0])
        if wanted == before + 1:
            return pivot
        if wanted <= before:
            high, medians, left = pivot, sides[0], before
        else:
            low, medians, left, wanted = pivot, sides[1], left - before - 1, wanted - before - 1
        if left * SHRINK <= size:
            written, size = kept(between(), "keys"), left
            low = high = None
    last = sorted((Key(*row) for row in between().collect()), key=Key.order)
    return last[wanted - 1]


def ranks(winners: DataFrame) -> DataFrame:
    """Number in the order of drawing, from 1, by a sort over ranges of keys."""
    placed = winners.orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "locator").select("locator", F.monotonically_increasing_id().alias("place"))
    placed = kept(placed, "drawn").withColumn("part", F.shiftright("place", 33))
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    sizes = sizes.select("part", F.coalesce(F.sum("size").over(order), F.lit(0)).alias("before"))
    inside = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(sizes, "part").select("locator", (F.col("before") + inside + 1).alias("rank"))


def resampled(
    df: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
    longest: int = LONGEST, buckets: int = BUCKETS, scale: int = SCALE, seed: int = SEED,
) -> DataFrame:
    """One row per document: id, features, weight, score, and its rank if it is drawn.

    Drawn are the highest scores among the documents with at least `least_words` words, `percent`
    of their number (floor); ties go to the smaller id, a null id last, and of repeated ids to the
    row read first. A null text has no words, weight 0 and is never drawn (nor is a shorter one);
    a text of any length counts whole; an empty table gives no rows, an empty target draws by the
    smoothed gains against it. Other columns are not read.
    """
    found = gains(bucket_counts(df, longest, buckets), bucket_counts(target, longest, buckets), scale)
    rows = scores(df, found, longest, scale, seed)
    eligible = rows.where(F.col("n_words") >= least_words)
    last = cutoff(eligible.select("score", "doc_id", "locator"), percent * eligible.count() // 100)
    drawn = eligible.where(F.lit(False)) if last is None else eligible.where(last.reached())
    numbers = ranks(drawn.select("score", "doc_id", "locator"))
    return rows.join(numbers, "locator", "left").select("doc_id", "n_features", "weight", "score", "rank")

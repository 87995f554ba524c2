"""What the operators of this folder share: reading tables, folds, maps over texts."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts are handed to Python functions in slices of about this many bytes.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(df: DataFrame, *more: str) -> DataFrame:
    """Id and text, and the columns asked for; a null text counts as empty."""
    return df.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *more)


def in_fold(parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder; a null id counts as a blank text."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(name.cast("binary")) % parts == part


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts hold about `limit` bytes; a longer text stands alone."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(lengths, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, before + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


@contextmanager
def no_collector() -> Iterator[None]:
    """Without the search for cycles, which costs much where many small objects live and none are cyclic."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


#: What an entry of a dict takes beside its characters, in bytes.
ENTRY_BYTES = 160


def entry_bytes(entries: dict[str, bytes]) -> int:
    """About what some entries of a dict take."""
    return sum(map(len, entries)) + sum(map(len, entries.values())) + ENTRY_BYTES * len(entries)


class Remembered:
    """What a worker has found out about words, within a bound of bytes (memory, not results), in two
    generations: a word met in one batch only is forgotten soon, one that comes back is kept, so
    rare words never drive out frequent ones."""

    def __init__(self, most: int) -> None:
        self.most = most // 2  # bytes of a generation
        self.often: dict[str, bytes] = {}
        self.once: dict[str, bytes] = {}
        self.often_bytes = self.once_bytes = 0

    def of(self, words: set[str]) -> tuple[dict[str, bytes], set[str]]:
        """What is known of the words, and those of which nothing is."""
        found = {w: self.often[w] for w in words & self.often.keys()}
        again = {w: self.once.pop(w) for w in words & self.once.keys()}
        size = entry_bytes(again)
        self.once_bytes -= size
        if self.often_bytes + size > self.most:
            self.often, self.often_bytes = {}, 0
        self.often.update(again)
        self.often_bytes += size
        found.update(again)
        return found, words - found.keys()

    def add(self, new: dict[str, bytes]) -> None:
        size = entry_bytes(new)
        if self.once_bytes + size > self.most:
            self.once, self.once_bytes = {}, 0
        if size <= self.most:
            self.once.update(new)
            self.once_bytes += size


def arrow_schema(fields: str) -> pa.Schema:
    """The Arrow schema of a Spark DDL string, for the types used here."""
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
             "string": pa.string(), "binary": pa.binary(), "smallint": pa.int16(), "float": pa.float32(),
             "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
             "array<binary>": pa.list_(pa.binary()),
             "array<float>": pa.list_(pa.float32()),
             "array<string>": pa.list_(pa.string())}
    pairs = [field.split() for field in fields.split(",")]
    return pa.schema([(name, kinds[kind]) for name, kind in pairs])


def give_back() -> None:
    """Hand memory that is free in this worker back to the system: a worker is used again by later
    tasks and stages, and what it has once taken would count against its executor all the time."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def handing_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A map over batches that hands free memory back when a task ends."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def map_texts(
    df: DataFrame, fields: str, prepare: Callable[[], Callable[[list[str]], list]], limit: int = SLICE_BYTES,
    finish: Callable[[], None] | None = None,
) -> DataFrame:
    """Add columns worked out from each text; the text itself is left out.

    `prepare` runs once in a task and gives a function from a list of texts to one
    list (or array) per new column. All other columns pass through as they are. `finish` runs when
    a task ends, to give up what its worker would keep; memory that is free then is handed back.
    """
    kept = [f for f in df.schema.fields if f.name != "text"]
    added = arrow_schema(fields)
    schema = T.StructType([*kept, *T.StructType.fromDDL(fields).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = prepare()
        try:
            for batch in batches:
                for part in slices(batch, limit=limit):
                    columns = work(part.column("text").to_pylist())
                    arrays = [part.column(f.name) for f in kept]
                    arrays += [pa.array(c, type=f.type) for c, f in zip(columns, added, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema.fields])
        finally:
            if finish is not None:
                finish()

    return df.mapInArrow(handing_back(run), schema)


#: Arrays of one fixed size travel in so many pieces, and so many tasks' pieces are added at a time.
PIECES, FAN_IN = 64, 256
SUMS = "piece int, share int, sums binary"


def pieces_of(values: np.ndarray, share: int) -> pa.RecordBatch:
    """An array as rows of PIECES pieces, padded with zeros."""
    padded = np.zeros(-(-len(values) // PIECES) * PIECES, dtype=np.float32)
    padded[: len(values)] = values
    rows = [piece.tobytes() for piece in padded.reshape(PIECES, -1)]
    return pa.RecordBatch.from_arrays(
        [pa.array(range(PIECES), pa.int32()), pa.array([share] * PIECES, pa.int32()), pa.array(rows, pa.binary())],
        schema=arrow_schema(SUMS),
    )


def summed(parts: DataFrame, size: int) -> np.ndarray:
    """The sum of the arrays that tasks sent as pieces.

    Pieces are added FAN_IN tasks at a time and then over all, in streams: a task holds no more
    than one array, and the driver gets one array of the given, fixed size.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, found in zip(batch.column("piece").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                values = np.frombuffer(found, dtype=np.float32)
                sums[piece] = sums[piece] + values if piece in sums else values.astype(np.float64)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([0] * len(sums), pa.int32()),
                 pa.array([s.astype(np.float32).tobytes() for s in sums.values()], pa.binary())],
                schema=arrow_schema(SUMS))

    few = parts.repartition(F.col("piece"), F.col("share")).mapInArrow(add, SUMS)
    whole = few.repartition(F.col("piece")).mapInArrow(add, SUMS)
    table = np.zeros((PIECES, -(-size // PIECES)))
    for row in whole.select("piece", "sums").collect():  # PIECES rows of a fixed size
        table[row["piece"]] += np.frombuffer(row["sums"], dtype=np.float32)
    return table.reshape(-1)[:size]

"""Benchmark decontamination with one Aho-Corasick automaton.

Words are runs of ASCII letters and digits, lower-cased, and of all characters beyond ASCII. Each
benchmark item gives its windows of consecutive words; all windows, joined by single blanks and
closed in by blanks, are the patterns of one automaton. A text is brought to the same form and
scanned once; matches are mapped back to its words and to character offsets of the original.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill.llm import frames
from prosemill.llm.shared import kept

WINDOW = 10
#: Items are searched in blocks whose texts hold about so many bytes, which bounds an automaton.
BLOCK_BYTES = 4 << 20
#: Bytes to blanks and small letters; bytes beyond ASCII stay. Fixed by the definition of a word.
FORM = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
ORIGINAL_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def word_bytes(text: str) -> list[bytes]:
    """The words of a text, in UTF-8."""
    return text.encode("utf-8", "replace").translate(FORM).split(b" ")


def words_of(text: str) -> list[bytes]:
    return list(filter(None, word_bytes(text)))


def windows(words: list[bytes], size: int = WINDOW) -> set[bytes]:
    """Windows of an item; an item of fewer words is one window, one without words has none."""
    if not words:
        return set()
    return {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


@lru_cache(maxsize=2)
def automaton(items: tuple[tuple[str, str], ...], size: int):
    """The automaton over the windows of all items: each gives its number of words and its items."""
    owners: dict[bytes, set[int]] = {}
    for n, (_, text) in enumerate(items):
        for window in windows(words_of(text), size):
            owners.setdefault(window, set()).add(n)
    found = ahocorasick.Automaton()
    for window, numbers in owners.items():
        found.add_word(f" {window.decode('utf-8', 'replace')} ", (window.count(b" ") + 1, tuple(numbers)))
    if owners:
        found.make_automaton()
    return found


def scan(text: str, machine) -> tuple[int, np.ndarray, set[int]]:
    """Words of a text, the numbers of the words that are hit, and the items with windows in it."""
    words = words_of(text)
    none = np.zeros(0, dtype=np.int64)
    if not words or not len(machine):
        return len(words), none, set()
    form = f" {b' '.join(words).decode('utf-8', 'replace')} "
    ends, sizes, items = [], [], set()
    for end, (size, numbers) in machine.iter(form):
        ends.append(end)
        sizes.append(size)
        items.update(numbers)
    if not ends:
        return len(words), none, items
    blanks = np.flatnonzero(np.frombuffer(form.encode("utf-32-le"), dtype=np.uint32) == 32)
    after = np.searchsorted(blanks, np.array(ends))  # a match ends on the blank behind its last word
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, after - np.array(sizes), 1)
    np.add.at(change, after, -1)
    return len(words), np.flatnonzero(np.cumsum(change)[:-1] > 0), items


def places(text: str, hit: np.ndarray) -> list[dict[str, int]]:
    """Number of each hit word and its character offsets in the original text, end exclusive."""
    if not len(hit):
        return []
    found = [m.span() for m in ORIGINAL_WORD.finditer(text)]
    return [{"word": w, "begin": found[w][0], "end": found[w][1]} for w in hit.tolist()]


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def contamination(
    df: DataFrame, benchmark: DataFrame, *more: str, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Per row: its words, its hit words with their offsets in the original text, and the items
    whose windows occur, sorted as text.

    A null text has no words and is clean; repeated rows are scanned each, a text of any length
    whole; an empty table gives no rows, an empty benchmark hits nothing; an item id that repeats
    counts once; of other columns those in `more` stay.

    The benchmark's bytes are summed before any of it is sent: up to `block_bytes` there is one
    automaton and the corpus is scanned once. A larger one is cut into blocks of that size by a
    hash; each takes a scan of its own over the same written table, and the rows are put together.
    """
    items = _items(benchmark)
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = total // block_bytes + 1
    source = frames.texts(df, *more)
    if count == 1:
        return _scanned(source, items, window)
    source = kept(source.withColumn("row", F.monotonically_increasing_id()), "decontamination")
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    found = _scanned(source, items.where(number == 0), window)
    for block in range(1, count):
        found = found.unionByName(_scanned(source, items.where(number == block), window))
    together = found.groupBy("row").agg(
        *[F.first(c).alias(c) for c in ("doc_id", *more)],
        F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return together.select("doc_id", *more, "n_words", "hits", "items")


def _scanned(source: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """One scan with the automaton of some items, whose size the caller has bounded."""
    rows = sorted((r[0], r[1]) for r in items.collect())
    sent = source.sparkSession.sparkContext.broadcast(rows)
    kept_fields = [f for f in source.schema.fields if f.name != "text"]
    fields = "n_words bigint, hits array<struct<word:int,begin:int,end:int>>, items array<string>"
    schema = frames.T.StructType([*kept_fields, *frames.T.StructType.fromDDL(fields).fields])
    place = pa.struct([("word", pa.int32()), ("begin", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(tuple(sent.value), window)
        names = [item for item, _ in sent.value]
        for batch in batches:
            for part in frames.slices(batch):
                counts, hits, owners = [], [], []
                for text in part.column("text").to_pylist():
                    n, hit, numbers = scan(text, machine)
                    counts.append(n)
                    hits.append(places(text, hit))
                    owners.append(sorted({names[i] for i in numbers}))
                arrays = [part.column(f.name) for f in kept_fields]
                arrays += [pa.array(counts, pa.int64()), pa.array(hits, pa.list_(place)), pa.array(owners, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema.fields])

    return source.mapInArrow(frames.handing_back(run), schema)


def without_benchmark(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows without a hit word, with all their columns as they came."""
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), "doc_id", "text")
    return contamination(rows, benchmark, "row").where(F.size("hits") == 0).select("row.*")


def contamination_digest(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The report of `contamination` in plain columns."""
    found = contamination(df, benchmark)
    return found.select(
        "doc_id", "n_words",
        F.size("hits").cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )

"""Phrase collocations by prefix-free parsing.

Pieces of text are cut into chunks where a window of words triggers by its content (its hash), so
equal passages give equal chunks wherever they stand. A chunk reaches over the next trigger's
window, so a phrase that starts in it ends in it; it is counted there alone. Equal chunks are folded
into a dictionary with their frequencies, and phrases are counted in the distinct chunks, weighted.

A frequent phrase has no rarer part, so phrases are only looked at where all their parts can be
frequent: single words are counted with the chunks; pairs of frequent words are counted by their
hash, which can only count too much; and phrases whose pairs all pass are counted as they are. Both
tests are tables of bits of bounded size. Beyond their bound they let more through to the exact
counts, and nothing is lost.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prosemill.llm import frames
from prosemill.llm.shared import kept

#: Words of the longest phrase; occurrences a phrase needs; per cent of a phrase's occurrences that
#: a longer one must reach to replace it; phrases reported for each language.
LONGEST, LEAST, COVERED, FIRST = 4, 30, 80, 2000
#: One window in so many ends a chunk.
PERIOD = 16
#: A task hands on its chunks when it holds so many different ones, and hashes so many words together.
HELD, HASHED = 100_000, 1 << 15
#: The last ranking of a language is made in so many parts first.
PARTS = 64
#: Bits per frequent phrase in the table that tasks test with, and the most and fewest address bits.
BITS, WIDEST, NARROWEST = 16, 27, 12
PROBES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
#: Fixed by the contract: small letters, a piece's end at the marks, blanks between words.
FORM = bytes(
    10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
BLANKS = re.compile(b" {2,}")
CHUNKS = "lang string, chunk string, own int, times bigint"
COUNTS = "lang string, phrase string, size int, n bigint"


def pieces(text: str) -> list[bytes]:
    """Every piece that has words, with single blanks between them."""
    found = BLANKS.sub(b" ", text.encode("utf-8", "replace").translate(FORM)).split(b"\n")
    return list(filter(None, map(bytes.strip, found)))


def hashes(words: pa.Array) -> np.ndarray:
    """64-bit hash of each word: a polynomial in its bytes. No word may be empty."""
    found = np.empty(len(words), np.uint64)
    if not len(words):
        return found
    offsets = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, words.offset * 4)
    data = np.frombuffer(words.buffers()[2], np.uint8)
    powers = np.cumprod(np.full(int(np.diff(offsets).max()), PROBES[0], np.uint64))
    for at in range(0, len(words), HASHED):
        some = offsets[at : at + HASHED + 1].astype(np.int64)
        starts, sizes = some[:-1] - some[0], np.diff(some)
        places = np.arange(some[-1] - some[0]) - np.repeat(starts, sizes)
        total = np.add.reduceat(data[some[0] : some[-1]] * powers[places], starts)
        total = (total ^ sizes.astype(np.uint64)) * np.uint64(PROBES[1])
        found[at : at + HASHED] = total ^ (total >> np.uint64(31))
    return found


def run_hashes(first: np.ndarray, words: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` words from each place of `at` on, from what `first` holds for each place."""
    found = first.copy()
    for j in range(size):
        found = (found ^ words[at + j]) * np.uint64(PROBES[0])
        found ^= found >> np.uint64(31)
    return found


def parsed(found: list[bytes], longest: int = LONGEST, period: int = PERIOD) -> Counter:
    """Chunks of the pieces: (words joined by blanks, how many of its first words are its own).

    Pieces of no more than `period` words are chunks as they are.
    """
    counts: Counter = Counter()
    long = []
    for piece in found:
        words = piece.count(b" ") + 1
        if words <= period:
            counts[piece, words] += 1
        else:
            long.append(piece.split(b" "))
    if not long:
        return counts
    overlap = longest - 1
    words = list(itertools.chain.from_iterable(long))
    sizes = np.fromiter(map(len, long), np.int64, len(long))
    ends = np.cumsum(sizes)
    stop = np.repeat(ends, sizes)  # the end of each word's piece
    places = np.arange(len(words))
    cut = np.zeros(len(words), dtype=bool)
    windows = np.flatnonzero(places + overlap <= stop)
    triggers = run_hashes(np.zeros(len(windows), np.uint64), hashes(pa.array(words, pa.binary())), windows, overlap)
    cut[windows[triggers % np.uint64(period) == 0]] = True
    cut[ends - sizes] = True
    begins = np.flatnonzero(cut)
    nexts = np.append(begins[1:], len(words))
    reaches = np.minimum(nexts + overlap, stop[begins])
    for begin, after, reach in zip(begins.tolist(), nexts.tolist(), reaches.tolist(), strict=True):
        counts[b" ".join(words[begin:reach]), after - begin] += 1
    return counts


def dictionary(df: DataFrame, longest: int = LONGEST, period: int = PERIOD) -> DataFrame:
    """Distinct chunks of each language and how often each occurs. Rows that own no word are the
    single words and their numbers, which travel along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        singles: dict[str, Counter] = {}

        def handed() -> Iterator[pa.RecordBatch]:
            for lang, counts in singles.items():
                held.setdefault(lang, Counter()).update({(word, 0): n for word, n in counts.items()})
            for lang, counts in held.items():
                keys = list(counts)
                for at in range(0, len(keys), 20_000):
                    some = keys[at : at + 20_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(some), pa.string()), pa.array([c for c, _ in some], pa.binary()).cast(pa.string()),
                         pa.array([own for _, own in some], pa.int32()), pa.array([counts[key] for key in some], pa.int64())],
                        schema=frames.arrow_schema(CHUNKS))
            held.clear()
            singles.clear()

        for batch in batches:
            for part in frames.slices(batch):
                by_lang: dict[str, list] = {}
                for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                    by_lang.setdefault(lang, []).extend(pieces(text))
                for lang, found in by_lang.items():
                    held.setdefault(lang, Counter()).update(parsed(found, longest, period))
                    singles.setdefault(lang, Counter()).update(b" ".join(found).split(b" "))
                if sum(map(len, held.values())) > HELD:
                    yield from handed()
        yield from handed()

    texts = df.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    chunks = texts.mapInArrow(run, CHUNKS)
    return kept(chunks.groupBy("lang", "chunk", "own").agg(F.sum("times").alias("times")), "chunks")


class Places:
    """The words of some chunks, side by side, and what is known of each word's place."""

    def __init__(self, langs: pa.Array, chunks: pa.Array):
        lists = pc.split_pattern(chunks, " ")
        self.words = lists.flatten()
        self.sizes = np.diff(lists.offsets.to_numpy())
        self.row = np.repeat(np.arange(len(chunks)), self.sizes)
        self.place = np.arange(len(self.words)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        self.langs, self.hashes = hashes(langs), hashes(self.words)

    def runs(self, at: np.ndarray, size: int) -> np.ndarray:
        return run_hashes(self.langs[self.row[at]], self.hashes, at, size)


def addresses(found: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The bits of a table that stand for each hash."""
    for probe in PROBES:
        yield (found * np.uint64(probe)) >> np.uint64(64 - width)


class Bits(NamedTuple):
    """A table of bits, all of which are set for a hash that was put in."""

    table: np.ndarray
    width: int

    def hold(self, found: np.ndarray) -> np.ndarray:
        hit = np.ones(len(found), dtype=bool)
        for at in addresses(found, self.width):
            hit &= (self.table[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return hit


def bit_table(found: DataFrame) -> Bits | None:
    """The table of some hashes (hash); None if there is none.

    Its size follows the number of hashes up to 2^WIDEST bits, which also bounds what the driver
    gets and sends.
    """
    known = found.count()
    if not known:
        return None
    width = int(min(WIDEST, max(NARROWEST, np.ceil(np.log2(known * BITS)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.concatenate(list(addresses(batch.column("hash").to_numpy().view(np.uint64), width)))
            slots, inverse = np.unique(at >> np.uint64(6), return_inverse=True)
            bits = np.zeros(len(slots), np.uint64)
            np.bitwise_or.at(bits, inverse.reshape(-1), np.uint64(1) << (at & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int64)), pa.array(bits.view(np.int64))], names=["slot", "bits"])

    rows = found.select("hash").mapInArrow(run, "slot bigint, bits bigint").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(1 << (width - 6), np.uint64)
    table[rows.column("slot").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return Bits(table, width)


def _over(chunks: DataFrame, work: Callable[[Places, np.ndarray, pa.RecordBatch], pa.Table], fields: str) -> DataFrame:
    """What `work` makes of the chunks' words, the owned places among them, and the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in frames.slices(batch, "chunk"):
                places = Places(part.column("lang"), part.column("chunk"))
                owned = np.flatnonzero(places.place < part.column("own").to_numpy()[places.row])
                yield from work(places, owned, part).to_batches()

    return chunks.mapInArrow(run, fields)


def word_hashes(words: DataFrame) -> DataFrame:
    """The hash of each word in its language."""

    def work(places: Places, _: np.ndarray, __: pa.RecordBatch) -> pa.Table:
        return pa.table({"hash": places.runs(np.arange(len(places.row)), 1).view(np.int64)})

    return _over(words, work, "hash bigint")


def pair_hashes(chunks: DataFrame, frequent: Bits, least: int) -> DataFrame:
    """Hashes of pairs of frequent words that can have `least` occurrences."""
    sent = chunks.sparkSession.sparkContext.broadcast(frequent)

    def work(places: Places, owned: np.ndarray, part: pa.RecordBatch) -> pa.Table:
        starts = owned[places.place[owned] + 2 <= places.sizes[places.row[owned]]]
        known = sent.value.hold(places.runs(np.arange(len(places.row)), 1))
        starts = starts[known[starts] & known[starts + 1]]
        times = part.column("times").to_numpy()[places.row[starts]]
        found = pa.table({"hash": places.runs(starts, 2).view(np.int64), "n": times})
        return found.group_by("hash").aggregate([("n", "sum")]).select(["hash", "n_sum"]).rename_columns(["hash", "n"])

    return _over(chunks, work, "hash bigint, n bigint").groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def phrase_counts(chunks: DataFrame, pairs: Bits, longest: int, least: int) -> DataFrame:
    """Phrases of two words and more with at least `least` occurrences, counted in distinct chunks."""
    sent = chunks.sparkSession.sparkContext.broadcast(pairs)

    def work(places: Places, owned: np.ndarray, part: pa.RecordBatch) -> pa.Table:
        times, langs, tables = part.column("times").to_numpy(), part.column("lang"), []
        left = places.sizes[places.row] - places.place  # words from here to the chunk's end
        both = np.zeros(len(places.row), dtype=bool)
        inner = np.flatnonzero(left >= 2)
        both[inner] = sent.value.hold(places.runs(inner, 2))
        starts = owned
        for size in range(2, longest + 1):
            starts = starts[left[starts] >= size]
            starts = starts[both[starts + size - 2]]
            row = places.row[starts]
            grams = [places.words.take(pa.array(starts + j)) for j in range(size)]
            tables.append(pa.table({
                "lang": langs.take(pa.array(row)), "phrase": pc.binary_join_element_wise(*grams, " "),
                "size": pa.array(np.full(len(starts), size, np.int32)), "n": times[row],
            }))
        folded = pa.concat_tables(tables).group_by(["lang", "phrase", "size"]).aggregate([("n", "sum")])
        return folded.select(["lang", "phrase", "size", "n_sum"]).rename_columns(["lang", "phrase", "size", "n"])

    found = _over(chunks, work, COUNTS).groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))
    return found.where(F.col("n") >= least)


def frequent_phrases(dictionary: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """Frequent phrases (lang, phrase, size, n) of one word and more, from `dictionary`."""
    words = dictionary.where(F.col("own") == 0).where(F.col("times") >= least)
    singles = words.select("lang", F.col("chunk").alias("phrase"), F.lit(1).alias("size"), F.col("times").alias("n"))
    chunks = dictionary.where(F.col("own") > 0)
    frequent = bit_table(word_hashes(words))
    pairs = None if frequent is None else bit_table(kept(pair_hashes(chunks, frequent, least), "pairs"))
    if pairs is None:
        return singles
    return kept(singles.unionByName(phrase_counts(chunks, pairs, longest, least)), "phrases")


def _joined(words: str, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def best_phrases(known: DataFrame, words: DataFrame, covered: int = COVERED, first: int = FIRST) -> DataFrame:
    """Each language's phrases with the highest scores, from counted phrases (lang, phrase, n, size)
    and words (lang, n). Arithmetic is on decimals, so it is exact."""
    candidates = known.where("size > 1").select("lang", "phrase", F.col("n").alias("a"), "size", F.split("phrase", " ", -1).alias("words"))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", _joined("words", F.lit(1), F.col("k")).alias("head"),
        _joined("words", F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"),
    )
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    rests = known.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    exact = "CAST(a AS DECIMAL(20, 0)) * CAST(2000000 AS DECIMAL(7, 0)) DIV (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))"
    scored = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"]).withColumn("score", F.expr(exact))
    weakest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("cut"))

    # the phrases inside each candidate, and the most that one around them occurs
    lengths = F.sequence(F.lit(2), F.col("size") - 1)
    inner = candidates.where("size > 2").withColumn("length", F.explode(lengths))
    inner = inner.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)))
    inner = inner.select("lang", _joined("words", F.col("at"), F.col("length")).alias("phrase"), "a")
    around = inner.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    wide = "CAST(around AS DECIMAL(20, 0)) * 100 >= CAST(cut.a AS DECIMAL(20, 0)) * " + str(int(covered))
    left = weakest.join(around, ["lang", "phrase"], "left").where(f"around IS NULL OR NOT ({wide})")

    # a language that holds most phrases is first ranked in parts, so the last step gets few of each
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    ranked = left.select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.score", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)).alias("part"))
    for keys in (["lang", "part"], ["lang"]):
        ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= first)
    return ranked.join(words, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def collocations(
    df: DataFrame, longest: int = LONGEST, least: int = LEAST, covered: int = COVERED, first: int = FIRST, period: int = PERIOD
) -> DataFrame:
    """Each language's phrases with the highest scores.

    A null text counts as empty, a null language as `und`; repeated rows count each; a text of any
    length is parsed whole; ties go by occurrences, then by the phrase's bytes; an empty table has
    no phrases. Other columns are not read.
    """
    chunks = dictionary(df, longest, period)
    words = chunks.groupBy("lang").agg(F.sum(F.col("own") * F.col("times")).alias("n"))
    known = frequent_phrases(chunks, longest, least)
    return best_phrases(known, words, covered, first)

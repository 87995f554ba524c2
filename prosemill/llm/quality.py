"""Quality classifier: random-indexing word vectors, pooled, under a small calibrated network.

Words are counted over all texts. Each of the OWN most frequent ones has a number of its own, all others
share the remaining numbers by a hash. Every number has a sparse random index vector. Over all texts
the index vectors of a word's neighbours are added up; that sum, brought to length one, beside the
word's own index vector is its vector. A document is the weighted mean and the spread of its
words' vectors. A network with one hidden layer is fitted to labelled documents, and a temperature,
found on documents kept aside, makes its outputs probabilities.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill.llm import frames

#: Numbers of words, 0 being no word's; those of single words; the width of an index vector.
BUCKETS, OWN, WIDTH = 1 << 15, (1 << 14) - 1, 32
LONGEST = 64
#: Neighbours on each side, and entries of an index vector that are not zero.
REACH, ENTRIES = 2, 2
#: Frequent words count less: SMOOTH / (SMOOTH + share of the word).
SMOOTH = 1e-3
#: The network is fitted to at most so many labelled rows, chosen by a hash of their ids.
SAMPLE = 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 40, 256, 3e-3, 1e-4
#: A task remembers the numbers of so many rarer words (memory, not results), and holds counts of so many.
REMEMBERED, HELD = 300_000, 200_000
#: Tokens whose vectors are gathered together, few enough for the processor's cache.
TOGETHER = 4096
TOKEN = re.compile(r"\w+|[^\w\s]+")


class Numbers(dict):
    """Number of each word: its own if it is among the most frequent, or one shared by its hash.
    Number 0 stands between documents and is no word's."""

    def __init__(self, frequent: list[str]):
        super().__init__(zip(frequent, range(1, len(frequent) + 1), strict=True))
        self.frequent = frequent

    def __missing__(self, word: str) -> int:
        if len(self) > len(self.frequent) + REMEMBERED:
            self.clear()
            self.update(zip(self.frequent, range(1, len(self.frequent) + 1), strict=True))
        number = self[word] = zlib.crc32(word.encode("utf-8", "replace")) % (BUCKETS - 1 - OWN) + 1 + OWN
        return number


def frequent_words(df: DataFrame) -> list[str]:
    """The OWN most frequent words of all texts, ties by the word; words of more than LONGEST
    characters share numbers in any case, which bounds the list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def handed() -> Iterator[pa.RecordBatch]:
            words = list(counts)
            for at in range(0, len(words), 20_000):
                some = words[at : at + 20_000]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), pa.array([counts[w] for w in some], pa.int64())], names=["word", "n"])
            counts.clear()

        for batch in batches:
            for part in frames.slices(batch):
                for text in part.column("text").to_pylist():
                    counts.update(TOKEN.findall(text))
                if len(counts) > HELD:
                    yield from handed()
        yield from handed()

    parts = frames.texts(df).select("text").mapInArrow(run, "word string, n bigint")
    short = parts.where(F.length("word") <= LONGEST)
    ranked = short.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(OWN)
    return [row["word"] for row in ranked.collect()]


@lru_cache(maxsize=1)
def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each number's index vector; number 0 has none."""
    random = np.random.default_rng(20)
    places = random.integers(0, WIDTH, (BUCKETS, ENTRIES))
    signs = random.choice([-1.0, 1.0], (BUCKETS, ENTRIES))
    signs[0] = 0.0
    return places, signs


def tokens(texts: list[str], numbers: Numbers) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all tokens, text after text, and how many tokens each text has."""
    found = [TOKEN.findall(text) for text in texts]
    sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    known = map(numbers.__getitem__, itertools.chain.from_iterable(found))
    ids = np.fromiter(known, dtype=np.int64, count=int(sizes.sum()))
    return ids, sizes


def context_sums(df: DataFrame, frequent: list[str]) -> np.ndarray:
    """For each number the sum of its neighbours' index vectors, and in the last column its count.

    All texts take part; each task sends one table of fixed size.
    """
    width = WIDTH + 1
    sent = df.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers(sent.value)
        places, signs = index_vectors()
        total = np.zeros(BUCKETS * width)
        for batch in batches:
            for part in frames.slices(batch):
                ids, sizes = tokens(part.column("text").to_pylist(), numbers)
                gap = np.repeat(np.arange(len(sizes)), sizes) * REACH  # so many zeros before each text
                spread = np.zeros(len(ids) + REACH * len(sizes), dtype=np.int64)
                spread[np.arange(len(ids)) + gap] = ids
                total += np.bincount(ids * width + WIDTH, minlength=len(total))
                for reach in range(1, REACH + 1):
                    for word, other in ((spread[:-reach], spread[reach:]), (spread[reach:], spread[:-reach])):
                        for k in range(ENTRIES):
                            total += np.bincount(word * width + places[other, k], signs[other, k], len(total))
        yield frames.pieces_of(total, TaskContext.get().partitionId() // frames.FAN_IN)

    parts = frames.texts(df).select("text").mapInArrow(run, frames.SUMS)
    return frames.summed(parts, BUCKETS * width).reshape(BUCKETS, width)


def word_vectors(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vector and weight of each number."""
    places, signs = index_vectors()
    own = np.zeros((BUCKETS, WIDTH))
    for k in range(ENTRIES):
        own[np.arange(BUCKETS), places[:, k]] += signs[:, k]
    context = sums[:, :WIDTH]
    context = context / np.maximum(np.linalg.norm(context, axis=1, keepdims=True), 1e-9)
    own = own / np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-9)
    share = sums[:, WIDTH] / max(sums[:, WIDTH].sum(), 1.0)
    return np.hstack([context, own]).astype(np.float32), (SMOOTH / (SMOOTH + share)).astype(np.float32)


def pooled(texts: list[str], numbers: Numbers, vectors: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted mean and spread of each text's word vectors; zeros for a text without words."""
    ids, sizes = tokens(texts, numbers)
    out = np.zeros((len(texts), 2 * vectors.shape[1]), dtype=np.float32)
    full = np.flatnonzero(sizes)
    starts = (np.cumsum(sizes) - sizes)[full]
    if not len(full):
        return out
    # whole texts, in runs that keep the gathered vectors small
    run = 0
    while run < len(full):
        stop = max(run + 1, int(np.searchsorted(starts, starts[run] + TOGETHER)))
        a, b = starts[run], starts[stop] if stop < len(full) else len(ids)
        w = weights[ids[a:b], None]
        values = vectors[ids[a:b]]
        begins = starts[run:stop] - a
        total = np.add.reduceat(w, begins)
        mean = np.add.reduceat(values * w, begins) / total
        square = np.add.reduceat(values * values * w, begins) / total
        half = vectors.shape[1]
        out[full[run:stop], :half] = mean
        out[full[run:stop], half:] = np.sqrt(np.maximum(square - mean * mean, 0.0))
        run = stop
    return out


@dataclass
class Network:
    """Two layers, the scale of the inputs, and the temperature of the output."""

    middle: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.maximum((x - self.middle) / self.scale @ w1 + b1, 0.0) @ w2 + b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(x)[:, 0] / self.temperature, -60.0, 60.0)))


def _loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0.0, logits) - y * logits))


def fit(x: np.ndarray, y: np.ndarray) -> Network:
    """Fit on four fifths of the rows by Adam; the temperature on the last fifth. Without rows, or
    with one label only, the score is that label's smoothed share for every text."""
    n, width = x.shape
    if not n or y.min() == y.max():
        share = (y.sum() + 0.5) / (n + 1.0)
        layers = [np.zeros((width, 1)), np.zeros(1), np.zeros((1, 1)), np.array([np.log(share / (1 - share))])]
        return Network(np.zeros(width), np.ones(width), layers, 1.0)
    random = np.random.default_rng(9)
    order = random.permutation(n)
    train, aside = order[n // 5 :], order[: n // 5]
    middle, scale = x[train].mean(0), x[train].std(0) + 1e-3
    z = (x - middle) / scale
    layers = [random.normal(0, np.sqrt(2 / width), (width, HIDDEN)), np.zeros(HIDDEN),
              random.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, 1)), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    step = 0
    for _ in range(EPOCHS):
        mixed = random.permutation(train)
        for at in range(0, len(mixed), BATCH):
            rows = mixed[at : at + BATCH]
            w1, b1, w2, b2 = layers
            hidden = np.maximum(z[rows] @ w1 + b1, 0.0)
            out = 1.0 / (1.0 + np.exp(-np.clip(hidden @ w2 + b2, -60.0, 60.0)))
            back = (out - y[rows, None]) / len(rows)
            inner = (back @ w2.T) * (hidden > 0)
            slopes = [z[rows].T @ inner + DECAY * w1, inner.sum(0), hidden.T @ back + DECAY * w2, back.sum(0)]
            step += 1
            for p, m, v, g in zip(layers, first, second, slopes, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net = Network(middle, scale, layers, 1.0)
    if len(aside):
        raw = net.logits(x[aside])[:, 0]
        net.temperature = min(np.geomspace(0.2, 10.0, 80), key=lambda t: _loss(raw / t, y[aside]))
    return net


def quality_scores(df: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per row the probability that its quality label is 1, learned from `labels` (doc_id, quality).

    Word vectors are learned from all texts, the network from at most `sample` labelled rows chosen
    by a hash. Null and empty texts are scored like any text without words; repeated rows are
    scored each, a text of any length whole; labels that are null are left out; an empty table gives
    no rows; other columns are not read. The word vectors have a fixed size.
    """
    spark = df.sparkSession
    frequent = frequent_words(df)
    vectors, weights = word_vectors(context_sums(df, frequent))
    sent = spark.sparkContext.broadcast((frequent, vectors, weights))
    usable = labels.where(F.col("quality").isNotNull()).select("doc_id", F.col("quality").cast("double").alias("quality"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample)
    rows = frames.texts(df).join(chosen, "doc_id")

    def features() -> Callable[[list[str]], list]:
        words, *rest = sent.value
        numbers = Numbers(words)
        return lambda batch: [list(pooled(batch, numbers, *rest).astype(np.float32))]

    seen = frames.map_texts(rows, "features array<float>", features).orderBy("doc_id", "quality").limit(sample).collect()
    x = np.array([r["features"] for r in seen], dtype=np.float64).reshape(-1, 2 * vectors.shape[1])
    model = spark.sparkContext.broadcast(fit(x, np.array([r["quality"] for r in seen], dtype=np.float64)))

    def prepare() -> Callable[[list[str]], list]:
        words, *rest = sent.value
        numbers = Numbers(words)
        return lambda batch: [model.value.scores(pooled(batch, numbers, *rest))]

    return frames.map_texts(frames.texts(df), "score double", prepare)


def quality_report(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from labels outside the held-out fold, score all rows."""
    held_out = frames.in_fold(3, 1)
    scored = quality_scores(df, labels.where(~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

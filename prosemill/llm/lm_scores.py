"""Language-model scoring: a gated recurrent network over the frequent words, word counts for all.

Word counts cover every training text. The most frequent words are the network's symbols; all
others share one symbol, whose probability is handed on to them by their counts. So the model's
probabilities add up to one over the same words as those of the unigram base, and at the start of
training they are the base.

The network is trained where the texts are, in one pass over every symbol of every training text.
The pass is cut into rounds by a hash of the text: in each round every task goes on from the same
weights over its texts of that round, each whole, and the tasks' weights are averaged by the
symbols they saw. Training and scoring carry the state from window to window through a text.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosemill.llm import frames
from prosemill.llm import recurrent as R
from prosemill.llm.shared import kept

#: At most so many frequent words are sent to the tasks; the counts of others are joined.
SENT_WORDS = 1 << 18
#: The pass over the training texts is cut into so many rounds.
ROUNDS = 2
#: Texts of about so many bytes are scored side by side.
SIDE_BY_SIDE = 32 << 20
#: Words are counted over texts of about so many bytes, then handed on.
COUNTED = 16 << 20
#: Fixed: small letters, and the word that stands for a text's end (no word is empty).
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
END_WORD = b""


def tokens(text: str) -> list[bytes]:
    """Words between blanks, tabs, line feeds, vertical tabs, form feeds and returns, lower-cased A-Z."""
    return text.encode("utf-8", "replace").translate(LOWER).split()


def numbered(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of some texts, the number of each word in text order, and how many words each
    text has. The words are those of `tokens`, but cut and told apart in Arrow."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    ends = words.offsets.to_numpy().astype(np.int64) - words.offsets[0].as_py()
    found = words.flatten().cast(pa.binary()).dictionary_encode()
    del words
    distinct, numbers = found.dictionary, found.indices.to_numpy()
    blank = pc.index(distinct, pa.scalar(END_WORD, pa.binary())).as_py()
    if blank >= 0:  # what stands before a leading blank or behind the last one is no word
        real = numbers != blank
        ends, numbers = np.append(0, np.cumsum(real))[ends], numbers[real]
    return distinct, numbers, np.diff(ends)


def as_list(words: pa.Array) -> list[bytes]:
    """The same as `to_pylist`, which makes a scalar of every word first."""
    return words.to_numpy(zero_copy_only=False).tolist()


def word_counts(df: DataFrame) -> DataFrame:
    """How often each word occurs in all texts, and as END_WORD how many texts there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in frames.slices(batch, limit=COUNTED):
                distinct, numbers, _ = numbered(part.column("text"))
                times = np.bincount(numbers, minlength=len(distinct))
                words = pa.concat_arrays([distinct.filter(pa.array(times > 0)), pa.array([END_WORD], pa.binary())])
                found = pa.RecordBatch.from_arrays([words, pa.array(np.append(times[times > 0], part.num_rows), pa.int64())], names=["word", "n"])
                for at in range(0, found.num_rows, 20_000):
                    yield found.slice(at, 20_000)

    parts = df.select("text").mapInArrow(frames.handing_back(run), "word binary, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def suffix(word: bytes) -> int:
    """Input symbol of a word that has none of its own."""
    return R.SYMBOLS + zlib.crc32(word[-2:]) % R.SUFFIXES


class Lexicon:
    """Counts of the words that were sent, and the symbols of the most frequent ones."""

    def __init__(self, words: list[tuple[bytes, int]], total: int, distinct: int):
        self.scale = float(np.log10(total + 0.5 * (distinct + 1)))
        ranked = sorted(words, key=lambda w: (-w[1], w[0]))
        named = [w for w, _ in ranked if w != END_WORD][: R.SYMBOLS - 2]
        symbol = {END_WORD: R.END} | {w: i + 2 for i, w in enumerate(named)}
        #: Place of each word in the arrays below, whose last entry is for words that were not sent.
        self.places = {w: i for i, (w, _) in enumerate(words)}
        self.words = pa.array([w for w, _ in words], pa.binary())
        self.targets = np.array([*(symbol.get(w, R.OTHER) for w, _ in words), R.OTHER])
        self.inputs = np.array([*(symbol[w] if w in symbol else suffix(w) for w, _ in words), 0])
        #: Logarithms of smoothed counts.
        self.logs = np.array([*(float(np.log10(n + 0.5)) for _, n in words), 0.0])
        share = np.zeros(R.SYMBOLS)
        whole = total + 0.5 * (distinct + 1)
        for word, n in words:
            if word in symbol:
                share[symbol[word]] = (n + 0.5) / whole
        if END_WORD not in self.places:
            share[R.END] = 0.5 / whole / 2  # nothing was learned: the end and the others share what is left
        share[R.OTHER] = max(1.0 - share.sum(), 1e-12)
        self.share = share
        #: Logarithm of what the words without a symbol weigh together.
        self.rest = float(np.log10(share[R.OTHER])) + self.scale

    def placed(self, words: list[bytes]) -> np.ndarray:
        """Place of each word, -1 if it was not sent."""
        return np.fromiter(map(self.places.get, words, repeat(-1)), dtype=np.int64, count=len(words))

    def symbols(self, words: list[bytes], at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Input and target symbols of a text, which ends with END; `at` is what `placed` gave."""
        inputs = self.inputs[at]
        for i in np.flatnonzero(at < 0).tolist():
            inputs[i] = suffix(words[i])
        first, last = np.array([R.END]), np.array([R.END])
        return np.concatenate([first, inputs]).astype(np.int16), np.concatenate([self.targets[at], last]).astype(np.int16)

    def encoded(self, texts: pa.Array) -> Encoded:
        """What `placed` and `symbols` give for all words of some texts, each distinct word looked up once."""
        distinct, numbers, sizes = numbered(texts)
        at = pc.fill_null(pc.index_in(distinct, self.words), -1).to_numpy()
        inputs, targets = self.inputs[at].astype(np.int16), self.targets[at].astype(np.int16)
        inputs[at < 0] = [suffix(word) for word in as_list(distinct.filter(pa.array(at < 0)))]
        ends = np.cumsum(sizes + 1)
        first, last = np.zeros(len(numbers) + len(sizes), dtype=bool), np.zeros(len(numbers) + len(sizes), dtype=bool)
        first[ends - sizes - 1], last[ends - 1] = True, True
        whole_in, whole_out = np.full(len(first), R.END, dtype=np.int16), np.full(len(first), R.END, dtype=np.int16)
        whole_in[~first], whole_out[~last] = inputs[numbers], targets[numbers]
        runs = [slice(end - size - 1, end) for end, size in zip(ends.tolist(), sizes.tolist(), strict=True)]
        return Encoded([(whole_in[run], whole_out[run]) for run in runs], distinct, numbers, sizes, at[numbers])


@dataclass(frozen=True)
class Encoded:
    """Some texts as input and target symbols, with their words: the distinct ones, the number and the
    place of each word in text order, and how many each text has."""

    symbols: list[tuple[np.ndarray, np.ndarray]]
    distinct: pa.Array
    numbers: np.ndarray
    sizes: np.ndarray
    places: np.ndarray

    def unsent(self) -> tuple[np.ndarray, list[list[bytes]], list[list[int]]]:
        """For each text how many words were not sent, which ones, and how often each occurs."""
        none = self.places < 0
        text = np.repeat(np.arange(len(self.sizes)), self.sizes)[none]
        keys, times = np.unique(text * len(self.distinct) + self.numbers[none], return_counts=True)
        owner, number = np.divmod(keys, max(len(self.distinct), 1))
        words, times = as_list(self.distinct.take(pa.array(number))), times.tolist()
        ends = np.searchsorted(owner, np.arange(len(self.sizes) + 1)).tolist()
        runs = [slice(a, b) for a, b in pairwise(ends)]
        return np.bincount(text, minlength=len(self.sizes)), [words[run] for run in runs], [times[run] for run in runs]


@lru_cache(maxsize=1)
def _lexicon(sent) -> Lexicon:
    return Lexicon(*sent.value)


def frequent(counts: DataFrame) -> tuple[list[tuple[bytes, int]], int, int]:
    """The words above the smallest count that leaves at most SENT_WORDS of them, the number of all
    tokens, and of all distinct ones. Counts are folded into eighths of octaves to find it."""
    step = F.floor(F.log2("n") * 8).cast("int")
    sizes = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("tokens")).orderBy(F.desc("step")).collect()
    total, distinct = sum(r["tokens"] for r in sizes), sum(r["words"] for r in sizes)
    taken, lowest = 0, None
    for row in sizes:
        if taken + row["words"] > SENT_WORDS:
            break
        taken, lowest = taken + row["words"], row["step"]
    if lowest is None:
        return [], total, distinct
    rows = counts.where(step >= lowest).toArrow()
    return sorted(zip(rows.column("word").to_pylist(), rows.column("n").to_pylist(), strict=True)), total, distinct


def in_round(number: int, rounds: int) -> Column:
    """Whether a text's turn is in this round; each text has its turn in one."""
    return F.pmod(F.xxhash64("text"), F.lit(rounds)) == number


def _trained(df: DataFrame, lexicon, weights: R.Weights) -> R.Weights:
    """One round: every task trains on the whole of each of its texts, then weights are averaged."""
    size = len(R.packed(weights))
    start = df.sparkSession.sparkContext.broadcast(R.packed(weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _lexicon(lexicon)
        trainer, seen = R.Trainer(R.unpacked(start.value, R.initial(known.share))), 0
        for batch in batches:
            for part in frames.slices(batch):
                encoded = known.encoded(part.column("text")).symbols
                trainer.train(encoded)
                seen += sum(len(t) for _, t in encoded)
        trainer.finish()
        if seen:
            values = np.append(R.packed(trainer.weights) * (seen / 1e6), seen / 1e6)
            yield frames.pieces_of(values, TaskContext.get().partitionId() // frames.FAN_IN)

    total = frames.summed(df.select("text").mapInArrow(frames.handing_back(run), frames.SUMS), size + 1)
    return R.unpacked(total[:size] / total[size], weights) if total[size] > 0 else weights


#: What scoring gives for each row before the counts of rarer words are known.
PARTIAL = (
    "n_tokens bigint, sent_known bigint, sent_base double, score double, others bigint, "
    "rare array<binary>, times array<int>"
)


def _partial(df: DataFrame, lexicon, weights: R.Weights) -> DataFrame:
    sent = df.sparkSession.sparkContext.broadcast(R.packed(weights))

    def prepare():
        known = _lexicon(lexicon)
        model = R.unpacked(sent.value, R.initial(known.share))
        has_end = END_WORD in known.places
        end = float(known.logs[known.places[END_WORD]]) if has_end else float(np.log10(0.5))

        def work(batch: list[str]) -> list:
            encoded, columns = [], [[] for _ in range(7)]
            for part in frames.slices(pa.RecordBatch.from_arrays([pa.array(batch, pa.string())], names=["text"])):
                found = known.encoded(part.column("text"))
                encoded += found.symbols
                logs, other = known.logs[found.places], known.targets[found.places] == R.OTHER
                ends = np.append(0, np.cumsum(found.sizes))
                others = np.append(0, np.cumsum(other))[ends]
                unsent, rare, times = found.unsent()
                columns[0] += (found.sizes + 1).tolist()
                columns[1] += (found.sizes - unsent + has_end).tolist()
                columns[2] += [float(logs[a:b].sum()) + end for a, b in pairwise(ends.tolist())]
                logs = logs[other]
                columns[3] += [float(logs[a:b].sum()) for a, b in pairwise(others.tolist())]
                columns[4] += np.diff(others).tolist()
                columns[5] += rare
                columns[6] += times
            columns[3] = np.array(columns[3]) + R.document_scores(model, encoded) / np.log(10.0)
            return columns

        return work

    return frames.map_texts(df, PARTIAL, prepare, SIDE_BY_SIDE)


def lm_scores(df: DataFrame, training: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Per row: tokens, known tokens, training tokens, base and model log10 probability.

    A null text counts as empty and is its end alone; repeated rows are learned from and scored
    each; without training texts every token has the base's probability for an unseen one. Every
    training token is trained on once, in one of the rounds. A text of any length is scored whole,
    its state carried to its end; an empty table gives no rows; other columns are not read. Only the
    most frequent words, at most SENT_WORDS, are sent to tasks.
    """
    context = df.sparkSession.sparkContext
    learned = frames.texts(training)
    counts = kept(word_counts(learned).where("n > 0"), "word_counts")
    words, total, distinct = frequent(counts)
    lexicon = context.broadcast((words, total, distinct))
    plan = Lexicon(words, total, distinct)
    weights = R.initial(plan.share)
    for number in range(rounds):
        weights = _trained(learned.where(in_round(number, rounds)), lexicon, weights)
    rows = _partial(frames.texts(df), lexicon, weights).withColumn("row", F.monotonically_increasing_id())
    rows = kept(rows, "scored")

    # rarer words: their counts come by a join, and are added up per row
    pairs = rows.select("row", F.explode(F.arrays_zip("rare", "times")).alias("pair"))
    pairs = pairs.select("row", F.col("pair.rare").alias("word"), F.col("pair.times").alias("times"))
    found = pairs.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("rare_sum"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
    )
    rare_sum = F.coalesce("rare_sum", F.lit(0.0))
    return rows.drop("rare", "times").join(found, "row", "left").select(
        "doc_id", "n_tokens",
        (F.col("sent_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("sent_base") + rare_sum - F.col("n_tokens") * plan.scale).alias("base_score"),
        (F.col("score") + rare_sum - F.col("others") * plan.rest).alias("score"),
    )


def lm_report(df: DataFrame) -> DataFrame:
    """Learn from the rows outside the held-out fold, score all."""
    held_out = frames.in_fold(5, 1)
    scored = lm_scores(df, df.where(~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")

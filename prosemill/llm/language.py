"""Language identification by rank-order profiles.

A language's profile is the list of its most frequent character n-grams (one to three characters,
words closed in by single blanks) in order. A document's own most frequent n-grams are ranked the
same way, and each is charged how far out of place it is in the language's profile, or the largest
charge if it is not there. The language with the least total is the prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prosemill.llm import frames

#: N-grams in a profile.
PROFILE = 400
#: An n-gram is a number with 21 bits for each character, which holds every code point.
BITS = np.uint64(21)
BLANK = np.uint64(32)
#: A task adds up so many entries before it folds them.
HELD = 2_000_000
UNDETERMINED = "und"


def gram_text(number: int) -> str:
    """The characters of an n-gram."""
    chars = [chr(number >> shift & (1 << 21) - 1) for shift in (42, 21, 0) if number >> shift]
    return "".join(chars)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def grams(text: str) -> np.ndarray:
    """All n-grams of a text, sorted; none if it has no letter."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[codes]
    # of each run of other characters one blank stays
    stays = letter.copy()
    stays[1:] |= letter[:-1]
    stays[0] = True
    codes = np.where(letter, codes, 32)[stays].astype(np.uint64)
    if len(codes) < 3:
        return np.zeros(0, dtype=np.uint64)
    two = codes[:-1] << BITS | codes[1:]
    three = (two[:-1] << BITS | codes[2:])[codes[1:-1] != BLANK]
    found = np.concatenate([codes[codes != BLANK], two, three])
    found.sort()
    return found


def counted(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array, and how often each occurs."""
    starts = np.flatnonzero(np.append(True, found[1:] != found[:-1])) if len(found) else np.zeros(0, dtype=np.int64)
    return found[starts], np.diff(np.append(starts, len(found)))


def _folded(parts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Counts of several parts added up."""
    values = np.concatenate([v for v, _ in parts])
    order = np.argsort(values, kind="stable")
    values, numbers = values[order], np.concatenate([n for _, n in parts])[order]
    starts = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    return [(values[starts], np.add.reduceat(numbers, starts))]


def language_profiles(df: DataFrame, size: int = PROFILE) -> DataFrame:
    """Place of the most frequent n-grams of each language, from all rows with a text and a `lang`.

    Tasks add up their own counts; the sums are added up by n-gram. Ties go to the smaller number.
    A language that fills most of the table costs no more than any other.
    """
    rows = df.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            for part in frames.slices(batch):
                held = 0
                for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                    entries = counted(grams(text))
                    sums.setdefault(lang, []).append(entries)
                    held += len(entries[0])
                    if held > HELD:
                        held, sums = 0, {k: _folded(mine) for k, mine in sums.items()}
                sums = {k: _folded(mine) for k, mine in sums.items()}
        for lang, mine in sums.items():
            for values, numbers in mine:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(values), pa.string()), pa.array(values.astype(np.int64)), pa.array(numbers, pa.int64())],
                    names=["lang", "gram", "n"])

    sums = rows.mapInArrow(frames.handing_back(run), "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return sums.withColumn("place", F.row_number().over(order)).where(F.col("place") <= size).select("lang", "gram", "place")


class Classifier:
    """Distances of documents to the profiles of all languages."""

    def __init__(self, profiles: list[tuple[str, int, int]], size: int = PROFILE):
        self.langs = sorted({lang for lang, _, _ in profiles})
        self.known = np.array(sorted({gram for _, gram, _ in profiles}), dtype=np.uint64)
        self.size = size
        #: Place of each known n-gram in each language, -1 where it has none.
        self.places = np.full((len(self.langs), len(self.known)), -1, dtype=np.int64)
        for lang, gram, place in profiles:
            self.places[self.langs.index(lang), np.searchsorted(self.known, np.uint64(gram))] = place - 1

    def predict(self, text: str) -> tuple[str, float]:
        """The nearest language and a score from 0 to 1: how much less out of place it is than all
        could be. A text without a letter is undetermined, as is any if nothing was learned."""
        values, numbers = counted(grams(text))
        if not len(values) or not self.langs:
            return UNDETERMINED, 0.0
        falling = numbers.max() - numbers
        kind = np.uint16 if falling.max() < 1 << 16 else np.int64
        top = values[np.argsort(falling.astype(kind), kind="stable")[: self.size]]
        at = np.minimum(np.searchsorted(self.known, top), len(self.known) - 1)
        there = np.where(self.known[at] == top, self.places[:, at], -1)
        charge = np.where(there < 0, self.size, np.abs(there - np.arange(len(top)))).sum(axis=1)
        best = int(np.argmin(charge))
        return self.langs[best], 1.0 - float(charge[best]) / (self.size * len(top))


def predicted_languages(df: DataFrame, profiles: DataFrame, *more: str) -> DataFrame:
    """Per row its predicted language and score, and whether its text has a letter. Null texts and
    texts without a letter are `und`; if no language was learned, so are all.

    The profiles (at most PROFILE rows for each language that was learned) are fetched and sent to
    the executors. Repeated rows are judged each, by the whole of a text of any length; an empty table
    gives no rows; other columns than those asked for are left out.
    """
    rows = [(r["lang"], r["gram"], r["place"]) for r in profiles.collect()]
    sent = df.sparkSession.sparkContext.broadcast(rows)

    def prepare():
        classifier = Classifier(sent.value)

        def work(batch: list[str]) -> list:
            found = [classifier.predict(text) for text in batch]
            letters = [lang != UNDETERMINED or len(grams(text)) > 0 for text, (lang, _) in zip(batch, found, strict=True)]
            return [[lang for lang, _ in found], [score for _, score in found], letters]

        return work

    return frames.map_texts(frames.texts(df, *more), "lang_pred string, score double, has_letter boolean", prepare)


def with_language(df: DataFrame) -> DataFrame:
    """The rows with a letter, with all their columns as they came. Only texts without one are
    undetermined for what they are; where no row has a `lang` to learn from, or `lang` itself says
    `und`, texts with letters stay."""
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), "doc_id", "text")
    found = predicted_languages(rows, language_profiles(df), "row")
    return found.where("has_letter").select("row.*")


def language_report(df: DataFrame) -> DataFrame:
    """Learn from the rows outside the held-out fold, predict for all."""
    held_out = frames.in_fold(4, 2)
    found = predicted_languages(df, language_profiles(df.where(~held_out)))
    return found.drop("has_letter").withColumn("held_out", held_out)

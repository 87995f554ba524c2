"""Vocabularies fitted on the training part, bag-of-words and TF-IDF features.

Texts are tokenized once. Documents stay in their rows from there on: what is shuffled are counts
of terms for the vocabulary, nothing else. Words are counted first, then the pairs of those words whose
pairs can still be among the most frequent terms.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prosemill import schema as S
from prosemill.functions.terms import Listed, Tokens, counted, numbered, runs, side_by_side, spelled, term_key
from prosemill.functions.text import tokens
from prosemill.session import written

# A term is kept from this many training documents on, and up to
# this share of them.
MIN_DF = 5
MAX_DF = 0.95
# Pairs are looked for among so many words at most; beyond that all pairs are counted.
PAIR_WORDS = 30_000


@dataclass(frozen=True)
class Representation:
    """How texts become numbers: longest term in tokens, vocabulary cap, weighting."""

    name: str
    longest: int
    max_features: int
    tfidf: bool = True


def bow_unigram(max_features: int = 3000) -> Representation:
    return Representation("bow_unigram", 1, max_features, tfidf=False)


def tfidf_unigram(max_features: int = 3000) -> Representation:
    return Representation("tfidf_unigram", 1, max_features)


def tfidf_uni_bigram(max_features: int = 6000) -> Representation:
    return Representation("tfidf_uni_bigram", 2, max_features)


@dataclass(frozen=True)
class Inputs:
    """The texts that are turned into numbers: settings with a text column of their own, and if
    there is one, the setting (name, first, second) whose text is the first's, a blank, the second's.

    The joined setting is put together from the tokens of its parts, since no token holds a blank.
    Name it only where the text really is the join of the two. With `words` given, terms are made of
    these alone.
    """

    own: dict[str, str]
    joined: tuple[str, str, str] | None = None
    words: frozenset[str] | None = None

    def names(self) -> list[str]:
        return [*self.own, *([self.joined[0]] if self.joined else [])]


def _inputs(settings: Inputs | dict[str, str] | None) -> Inputs:
    if isinstance(settings, Inputs):
        return settings
    return Inputs(S.INPUT_SETTINGS if settings is None else settings)


def document_tokens(
    texts: DataFrame, settings: Inputs | dict[str, str] | None = None, *, id_col: str = S.ARTICLE_ID
) -> DataFrame:
    """Rows (id, label, split, tokens), with the tokens of every setting of its own, a blank between two.

    Each text is tokenized once, where it lies; a null text has no tokens. No token holds a blank, and one
    text is written, read and handed over at a fraction of the cost of an array.
    """
    found = [F.array_join(tokens(F.col(column)), " ").alias(name) for name, column in _inputs(settings).own.items()]
    return texts.select(id_col, S.LABEL, "split", F.struct(*found).alias("tokens"))


def only_words(settings: Inputs | dict[str, str] | None, words: Iterable[str]) -> Inputs:
    """The settings with terms of these words only; all other tokens make none, and keep their place."""
    return replace(_inputs(settings), words=frozenset(words))


def _own_tokens(documents: DataFrame, inputs: Inputs, *others: str) -> tuple[DataFrame, list[str]]:
    """The documents with a column of tokens for every own setting, null if there are none, and the names
    of these columns."""
    columns = [f"_own{i}" for i in range(len(inputs.own))]
    own = [F.nullif(F.col("tokens")[name], F.lit("")).alias(column) for name, column in zip(inputs.own, columns, strict=True)]
    return documents.select(*others, *own), columns


def _by_setting(tokens: list[Tokens], own: list[str], joined: tuple[str, str, str] | None) -> dict[str, Tokens]:
    """The tokens of every setting; those of the joined one are its parts' tokens, one after the other."""
    found = dict(zip(own, tokens, strict=True))
    return found | {joined[0]: found[joined[1]].then(found[joined[2]])} if joined else found


def term_counts(
    documents: DataFrame, longest: int, settings: Inputs | dict[str, str] | None = None, *, shortest: int = 1
) -> DataFrame:
    """Rows (setting, term, df, total): documents with the term, and its occurrences.

    Documents are read once. Their tokens are numbered where they lie, a run of documents at a time, and a
    run gives each of its terms once, with its counts for every setting; these are what is shuffled.
    """
    inputs = _inputs(settings)
    texts, columns = _own_tokens(documents, inputs)
    own, joined = list(inputs.own), inputs.joined
    known = None if inputs.words is None else pa.array(sorted(inputs.words), pa.string())
    numbers = [f"_{kind}{i}" for i in range(len(inputs.names())) for kind in ("df", "total")]

    def of_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in (run for batch in batches for run in runs(batch, columns)):
            found, words = numbered(run, columns, known)
            by_setting = _by_setting(found, own, joined).values()
            keys, counts = side_by_side([counted(*each.terms(len(words), longest, shortest), run.num_rows) for each in by_setting])
            yield pa.RecordBatch.from_arrays([spelled(keys, words), *map(pa.array, counts)], ["term", *numbers])

    parts = texts.mapInArrow(of_runs, ", ".join(["term string", *(f"{name} long" for name in numbers)]))
    by_term = parts.groupBy("term").agg(*[F.sum(name).alias(name) for name in numbers])
    found = [
        F.struct(F.lit(name).alias("setting"), F.col(f"_df{i}").alias("df"), F.col(f"_total{i}").alias("total"))
        for i, name in enumerate(inputs.names())
    ]
    return by_term.select("term", F.inline(F.array(*found))).where("df > 0").select("setting", "term", "df", "total")


def fitted_vocabulary(
    documents: DataFrame,
    split: DataFrame,
    representations: Iterable[Representation],
    settings: Inputs | dict[str, str] | None = None,
    *,
    min_df: int = MIN_DF,
    max_df: float = MAX_DF,
) -> DataFrame:
    """Rows (setting, representation, term_idx, term, df, total, idf) from the training part.

    `documents` are those of `document_tokens`. Bounds are inclusive and count blank documents; the
    most frequent terms stay, ties by term; positions follow the order of the terms.
    """
    representations = list(representations)
    train = F.col("split") == S.SPLITS[0]
    train_rows = split.where(train).agg(F.count(F.lit(1)).alias("n")).scalar()
    learned = documents.where(train)
    usual = F.col("df") <= F.lit(max_df) * train_rows
    words = term_counts(learned, 1, settings).where(F.col("df") >= min_df)
    caps = [r.max_features for r in representations if r.longest > 1]
    if caps:
        words = written(words, "words")
        chosen = _pair_words(words, words.where(usual), max(caps))
        able = settings if chosen is None else only_words(settings, chosen)
        words = words.unionByName(term_counts(learned, 2, able, shortest=2).where(F.col("df") >= min_df))
    counts = words.where(usual)
    kept = None
    for r in representations:
        candidates = counts if r.longest > 1 else counts.where(~F.contains("term", F.lit(" ")))
        best = _most_frequent(candidates, r.max_features).withColumn("representation", F.lit(r.name))
        kept = best if kept is None else kept.unionByName(best)
    in_order = Window.partitionBy("setting", "representation").orderBy("term")
    return kept.select(
        "setting",
        "representation",
        (F.row_number().over(in_order) - 1).alias("term_idx"),
        "term",
        "df",
        "total",
        (F.log((train_rows + 1) / (F.col("df") + 1)) + 1).alias("idf"),
    )


def _pair_words(words: DataFrame, candidates: DataFrame, cap: int) -> list[str] | None:
    """The words a pair in the vocabulary can be made of, or None if they are more than PAIR_WORDS.

    A pair occurs no more often, and in no more documents, than either of its words. Where the cap is
    filled by words alone, a pair that is rarer than the last of them cannot get in, so both words of
    one that does occur at least that often. Words in too many documents make pairs all the same.
    """
    lasts = _most_frequent(candidates, cap).groupBy("setting").agg(F.min("total").alias("last"), F.count(F.lit(1)).alias("found"))
    lasts = lasts.where(F.col("found") >= cap).select("setting", "last")
    able = words.join(F.broadcast(lasts), "setting", "left").where(F.col("total") >= F.coalesce("last", F.lit(0)))
    found = able.select("term").distinct().limit(PAIR_WORDS + 1).collect()
    return [row["term"] for row in found] if len(found) <= PAIR_WORDS else None


def _most_frequent(candidates: DataFrame, cap: int) -> DataFrame:
    """The most frequent terms of each setting.

    The cap is a constant, so each task keeps no more than that many terms before
    the shuffle, however large the language is.
    """
    best_first = Window.partitionBy("setting").orderBy(F.desc("total"), "term")
    return (
        candidates.withColumn("_position", F.row_number().over(best_first))
        .where(F.col("_position") <= cap)
        .drop("_position")
    )


def feature_rows(
    documents: DataFrame,
    vocabulary: DataFrame,
    representations: Iterable[Representation],
    settings: Inputs | dict[str, str] | None = None,
    *,
    id_col: str = S.ARTICLE_ID,
) -> DataFrame:
    """Rows (setting, representation, split, id, label, indices, weights).

    A document's terms are looked up and counted where it lies, a run of documents at a time: nothing is
    shuffled, and a document without a known term has empty arrays. A vocabulary has at most as many terms for each setting
    and representation as its cap says; it is fetched here and sent to the tasks.
    """
    inputs, representations = _inputs(settings), list(representations)
    caps = {r.name: r.max_features for r in representations}
    wanted = vocabulary.where(F.col("representation").isin(list(caps)) & F.col("setting").isin(inputs.names()))
    lists: dict[tuple[str, str], list[tuple[int, str, float]]] = {}
    for setting, name, *entry in wanted.select("setting", "representation", "term_idx", "term", "idf").collect():
        lists.setdefault((setting, name), []).append(tuple(entry))
    known = sorted({word for entries in lists.values() for _, term, _ in entries for word in term.split(" ")})
    numbers = {word: i for i, word in enumerate(known)}
    vocabularies = [
        (setting, r.name, _listed(sorted(lists.get((setting, r.name), [])), r, numbers)) for setting in inputs.names() for r in representations
    ]
    beside = ["split", id_col, S.LABEL]
    texts, columns = _own_tokens(documents, inputs, *beside)
    own, joined, words = list(inputs.own), inputs.joined, pa.array(known, pa.string())

    def of_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in (run for batch in batches for run in runs(batch, columns)):
            tokens = _by_setting(numbered(run, columns, words)[0], own, joined)
            for setting, name, listed in vocabularies:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.repeat(setting, run.num_rows), pa.repeat(name, run.num_rows), *(run.column(column) for column in beside),
                        *listed.entries(tokens[setting], len(words), run.num_rows),
                    ],
                    names,
                )

    fields = T.StructType().add("setting", "string").add("representation", "string")
    for column in beside:
        fields = fields.add(column, documents.schema[column].dataType)
    fields = fields.add("indices", T.ArrayType(T.IntegerType())).add("weights", T.ArrayType(T.DoubleType()))
    names = fields.names
    return texts.mapInArrow(of_runs, fields)


def _listed(entries: list[tuple[int, str, float]], kind: Representation, numbers: dict[str, int]) -> Listed:
    """A vocabulary's entries (position, term, idf) by the numbers of the words."""
    keys = np.array([term_key([numbers[word] for word in term.split(" ")], len(numbers)) for _, term, _ in entries], dtype=np.int64)
    order = np.argsort(keys)
    idf = np.array([value for _, _, value in entries], dtype=np.float64)
    return Listed(keys[order], order, idf if kind.tfidf else None, kind.longest)


def long_features(features: DataFrame, *, id_col: str = S.ARTICLE_ID) -> DataFrame:
    """One row per document and known term: (setting, representation, split, id, term_idx, weight)."""
    pairs = F.arrays_zip(F.col("indices").alias("term_idx"), F.col("weights").alias("weight"))
    rows = features.select(
        "setting",
        "representation",
        "split",
        id_col,
        F.inline_outer(pairs).alias("term_idx", "weight"),
    )
    return rows.where(F.col("term_idx").isNotNull())


def feature_summary(
    vocabulary: DataFrame,
    split: DataFrame,
    representations: Iterable[Representation],
    settings: Inputs | dict[str, str] | None = None,
) -> DataFrame:
    """Vocabulary size and rows per split part for every setting and representation."""
    names = _inputs(settings).names()
    fits = split.sparkSession.createDataFrame(
        [(s, r.name) for s in names for r in representations],
        "input_setting string, representation string",
    )
    sizes = vocabulary.groupBy(
        F.col("setting").alias("input_setting"), "representation"
    ).agg(F.count(F.lit(1)).alias("vocab_size"))
    parts = split.agg(
        *[F.count_if(F.col("split") == name).alias(f"{name}_rows") for name in S.SPLITS]
    )
    rows = {f"{name}_rows": parts.select(f"{name}_rows").scalar() for name in S.SPLITS}
    return (
        fits.join(sizes, ["input_setting", "representation"], "left")
        .na.fill(0, ["vocab_size"])
        .withColumns(rows)
    )

"""Cleaned articles to split, vocabularies and feature tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from prosemill import schema as S
from prosemill.operators import features as Fe
from prosemill.operators import sampling as Sa
from prosemill.operators.columns import require_columns
from prosemill.session import written
from prosemill.sources.csv import write_summary_csv
from prosemill.sources.tables import (
    write_features,
    write_table,
    write_vocabulary,
    write_vocabulary_json,
)


# The settings of a table that the cleaning job wrote: its third text is the join of the others.
CLEANED = Fe.Inputs(
    {name: S.INPUT_SETTINGS[name] for name in ("title", "body")}, ("combined", "title", "body")
)


@dataclass(frozen=True)
class Features:
    """The written split and vocabulary and the summary."""

    split: DataFrame
    vocabulary: DataFrame
    summary: DataFrame


def run(
    articles: DataFrame,
    out_dir: str,
    per_class: int,
    *,
    max_features_unigram: int = 3000,
    max_features_bigram: int = 6000,
    min_df: int = Fe.MIN_DF,
    max_df: float = Fe.MAX_DF,
    seed: int = Sa.SPLIT_SEED,
    settings: Fe.Inputs | None = None,
) -> Features:
    """Sample, split, look up texts, fit on train, transform all parts, write.

    Three cut points: the split, its tokens and the vocabulary are each read more than once
    afterwards. By default every setting has a text column of its own; give `settings` (see
    `CLEANED`) where the third text is known to be the join of the other two.
    """
    inputs = Fe.Inputs(S.INPUT_SETTINGS) if settings is None else settings
    columns = list(inputs.own.values())
    require_columns(articles, [S.ARTICLE_ID, S.LABEL, *columns])
    kinds = [Fe.tfidf_unigram(max_features_unigram), Fe.tfidf_uni_bigram(max_features_bigram)]
    folder = f"{out_dir}/{per_class}perclass"
    split = write_table(
        Sa.sample_and_split(articles, per_class, seed=seed), f"{folder}/split_assignment"
    )
    texts = Sa.split_texts(split, articles, columns)
    tokens = written(Fe.document_tokens(texts, inputs), "tokens")
    vocabulary = write_vocabulary(
        Fe.fitted_vocabulary(tokens, split, kinds, inputs, min_df=min_df, max_df=max_df),
        f"{folder}/vocabulary",
    )
    require_terms(vocabulary, kinds, inputs)
    write_vocabulary_json(vocabulary, f"{folder}/vocabulary_json")
    write_features(Fe.feature_rows(tokens, vocabulary, kinds, inputs), f"{folder}/features")
    summary = Fe.feature_summary(vocabulary, split, kinds, inputs)
    write_summary_csv(summary, f"{folder}/feature_summary")
    return Features(split, vocabulary, summary)


def require_terms(vocabulary: DataFrame, kinds: list[Fe.Representation], inputs: Fe.Inputs) -> DataFrame:
    """Stop if a setting is left without any term."""
    fits = {(setting, kind.name) for setting in inputs.names() for kind in kinds}
    found = vocabulary.select("setting", "representation").distinct().collect()
    empty = sorted(fits - {tuple(row) for row in found})
    if empty:
        raise ValueError(f"No terms remain for: {empty}")
    return vocabulary

"""Texts of 5 MB, with and without blanks, through the operators whose own tests have none."""

import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from prosemill.llm import catalog as K
from prosemill.llm.decontamination import contamination_digest
from prosemill.llm.exact_dedup import dedup_report
from prosemill.llm.jaccard_join import jaccard_report
from prosemill.llm.language import language_profiles, predicted_languages
from prosemill.llm.lm_scores import lm_scores
from prosemill.llm.piece_codec import round_trip
from prosemill.llm.quality import quality_scores
from prosemill.llm.token_counts import token_counts
from prosemill.llm.token_files import read_token_files, write_token_files
from prosemill.llm.shared import new_folder
from tests.conftest import rows

BLANK_FREE = "abcdefghij" * 500_000
WORDS = " ".join(f"{i:07}" + "word" * 22 for i in range(52_000))
TEXTS = [(1, BLANK_FREE), (2, WORDS), (3, WORDS + " one more"), (4, "short"), (5, WORDS)]


@pytest.fixture(scope="module")
def docs(spark):
    assert min(len(t) for i, t in TEXTS if i != 4) >= 4_900_000
    df = spark.createDataFrame(TEXTS, "doc_id long, text string").repartition(3)
    return df.withColumn("lang", F.when(F.col("doc_id") == 1, "xx").otherwise("en")).cache()


def test_copies(docs):
    assert sorted(rows(dedup_report(docs), "doc_id", "keep_id")) == [(1, 1), (2, 5), (3, 3), (4, 4), (5, 5)]
    assert sorted(rows(jaccard_report(docs), "doc_id", "class_id", "n_links")) == [(1, 1, 0), (2, 2, 1), (3, 2, 1), (4, 4, 0), (5, 2, 1)]


def test_pieces_and_tokens(spark, docs):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(K.PIECE_MODEL))
    want = {i: len(library.encode(t)) for i, t in TEXTS}
    model = K.tokenizer_file(K.PIECE_MODEL)
    assert dict(rows(round_trip(docs, model), "doc_id", "n_pieces")) == want
    assert dict(rows(token_counts(docs, model), "doc_id", "n_tokens")) == want
    words = tokenizers.Tokenizer.from_file(public_tokenizers.path(K.WORD_MODEL))
    path = new_folder(spark, "long_tokens")
    write_token_files(docs, K.tokenizer_file(K.WORD_MODEL), K.WORD_END, path)
    found = dict(rows(read_token_files(spark, path), "doc_id", "n_tokens"))
    assert found == {i: len(words.encode(t, add_special_tokens=False).ids) + 1 for i, t in TEXTS}


def test_scores(spark, docs):
    scored = {r[0]: r[1:] for r in rows(lm_scores(docs, docs, rounds=1), "doc_id", "n_tokens", "n_known", "base_score", "score")}
    assert {i: (n, k) for i, (n, k, _, _) in scored.items()} == {i: (len(t.split()) + 1,) * 2 for i, t in TEXTS}
    assert all(base < 0 and score < 0 for _, _, base, score in scored.values())
    found = dict(rows(predicted_languages(docs, language_profiles(docs)), "doc_id", "lang_pred"))
    assert found[1] == "xx" and found[2] == "en"
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, quality int")
    assert all(0 <= s <= 1 for (s,) in rows(quality_scores(docs, labels), "score"))


def test_benchmark(spark, docs):
    items = spark.createDataFrame([("end", "one more"), ("none", "two more")], "item_id string, text string")
    found = {r[0]: r[1:] for r in rows(contamination_digest(docs, items), "doc_id", "n_words", "n_hit", "n_items")}
    assert found[3] == (52_002, 2, 1) and found[2] == (52_000, 0, 0) and found[1] == (1, 0, 0)

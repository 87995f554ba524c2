from collections import defaultdict

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline as P
from prosemill.llm.frames import table
from tests.conftest import rows
from tests.llm.common import AWKWARD, SF, awkward, documents, empty
from tests.llm.test_decontamination import brute as contaminated
from tests.llm.test_jaccard import brute as classes


def test_stages_by_name():
    assert [name for name, _ in P.STAGES] == ["language_id", "exact_dedup", "jaccard_join", "decontamination", "sentencepiece"]
    assert P.ORACLE_SQL is None


def test_each_stage_against_plain_code(spark):
    """All five stages over one table, each on what the one before kept."""
    docs = table(spark, SF, "documents")
    left = {d["doc_id"]: d["text"] for d in documents()}
    items = [(str(r[0]), r[1]) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]

    left = {i: t for i, t in left.items() if any(c.isalpha() for c in t)}
    by_text = defaultdict(list)
    for i, t in left.items():
        by_text[t].append(i)
    after_copies = {max(ids): t for t, ids in by_text.items()}
    found = {x: c for x, c, _ in classes(list(after_copies.items()))}
    after_near = {i: t for i, t in after_copies.items() if found[i] == i}
    dirty = {r[0] for r in contaminated(list(after_near.items()), items) if r[5]}
    clean = {i: t for i, t in after_near.items() if i not in dirty}

    wanted = [left, after_copies, after_near, clean]
    for (_, stage), want in zip(P.STAGES, wanted, strict=False):
        docs = P.kept(stage(spark, docs, SF), "test_stage")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert dict(rows(docs, "doc_id", "text")) == want
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = dict(rows(P.STAGES[-1][1](spark, docs, SF), "doc_id", "ids"))
    assert got == {i: library.encode(t) for i, t in clean.items()}


def test_run(spark):
    whole = P.run(spark, SF)
    assert whole.columns == ["doc_id", "lang", "source", "ids"] and 100 < whole.count() < 200


def written(spark, tmp_path, docs, items):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_run_over_awkward_rows(spark, tmp_path):
    docs = awkward(spark).withColumns({"lang": F.lit(None).cast("string"), "source": F.lit("s")})
    sf_dir = written(spark, tmp_path, docs, [("q1", "word word"), ("q2", None)])
    got = rows(P.run(spark, sf_dir), "doc_id", "ids")
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = dict(AWKWARD)
    assert sorted(got, key=str) == sorted([(i, library.encode(texts[i])) for i in (None, 5, 6, 8, 9, 12)], key=str)


def test_run_over_an_empty_table(spark, tmp_path):
    docs = empty(spark).withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.lit(1)})
    assert rows(P.run(spark, written(spark, tmp_path, docs, [("q", "a b c")]))) == []
    for _, stage in P.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0

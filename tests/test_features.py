import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from prosemill.operators import features as Fe
from tests.conftest import rows

SETTING = {"title": "clean_title"}


def texts(spark, data):
    return spark.createDataFrame(
        [(i, 0, part, text) for i, (part, text) in enumerate(data)],
        "article_id long, label int, split string, clean_title string",
    )


def fit(spark, data, kind, min_df=1, max_df=0.95):
    df = texts(spark, data)
    found = Fe.document_tokens(df, SETTING)
    return found, Fe.fitted_vocabulary(found, df, [kind], SETTING, min_df=min_df, max_df=max_df)


SMALL = [("train", "a b"), ("train", "a c"), ("train", "a b b"), ("val", "b c"), ("val", "zzz"), ("test", "")]


def test_idf_and_weights_by_hand(spark):
    kind = Fe.tfidf_unigram(10)
    terms, vocab = fit(spark, SMALL, kind)
    got = sorted(rows(vocab, "term_idx", "term", "df", "total", F.round("idf", 6)))
    assert got == [(0, "b", 2, 3, 1.287682), (1, "c", 1, 1, 1.693147)]
    found = {r[0]: r[1:] for r in rows(Fe.feature_rows(terms, vocab, [kind], SETTING), "article_id", "split", "indices", "weights")}
    assert len(found) == 6
    assert found[3][1] == [0, 1]
    assert found[3][2] == pytest.approx([0.6053485, 0.7959605], abs=1e-7)
    assert found[4] == ("val", [], []) and found[5] == ("test", [], [])


def test_bag_of_words_counts(spark):
    kind = Fe.bow_unigram(10)
    terms, vocab = fit(spark, SMALL, kind)
    found = dict(rows(Fe.feature_rows(terms, vocab, [kind], SETTING), "article_id", "weights"))
    assert found[2] == [2.0] and found[3] == [1.0, 1.0]


def test_vocabulary_ignores_held_out_texts(spark):
    kind = Fe.tfidf_uni_bigram(10)
    _, vocab = fit(spark, SMALL, kind)
    changed = [row if row[0] == "train" else (row[0], "q q q b b") for row in SMALL]
    assert sorted(rows(vocab)) == sorted(rows(fit(spark, changed, kind)[1]))


def test_bounds_are_inclusive_and_count_blank_rows(spark):
    data = [("train", "a b")] * 5 + [("train", "a")] * 14 + [("train", "")]
    _, vocab = fit(spark, data, Fe.tfidf_unigram(10), min_df=5, max_df=0.95)
    assert sorted(rows(vocab, "term")) == [("a",), ("b",)]
    _, vocab = fit(spark, data[:-1], Fe.tfidf_unigram(10), min_df=6, max_df=0.95)
    assert rows(vocab, "term") == []


def expected_features(data, longest, cap, min_df, max_df):
    """The same features in plain Python."""
    import re

    def terms(text):
        tokens = re.findall(r"[a-z']+", text)
        pairs = [f"{x} {y}" for x, y in zip(tokens, tokens[1:])] if longest > 1 else []
        return Counter(tokens + pairs)

    counted = [terms(text) for _, text in data]
    train = [c for c, (part, _) in zip(counted, data) if part == "train"]
    df, total = Counter(), Counter()
    for c in train:
        df.update(c.keys())
        total.update(c)
    kept = [t for t in df if min_df <= df[t] <= max_df * len(train)]
    kept = sorted(sorted(kept, key=lambda t: (-total[t], t))[:cap])
    idf = {t: math.log((1 + len(train)) / (1 + df[t])) + 1 for t in kept}
    result = {}
    for i, c in enumerate(counted):
        weights = {kept.index(t): n * idf[t] for t, n in c.items() if t in idf}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        result[i] = {k: round(w / norm, 9) for k, w in sorted(weights.items())}
    return kept, result


@pytest.mark.parametrize("partitions", [1, 4, 50])
@pytest.mark.parametrize(("longest", "cap"), [(1, 7), (2, 12)])
def test_features_against_plain_python(spark, partitions, longest, cap):
    import random

    draw = random.Random(1)
    words = ["a", "b", "c", "don't", "e", "'", "g", "h", "i", "j"]
    data = [
        (draw.choice(["train", "train", "val", "test"]),
         " ".join(draw.choice(words) for _ in range(draw.randrange(0, 15))))
        for _ in range(60)
    ]
    kind = Fe.Representation("kind", longest, cap)
    df = texts(spark, data).repartition(partitions)
    terms = Fe.document_tokens(df, SETTING)
    vocab = Fe.fitted_vocabulary(terms, df, [kind], SETTING, min_df=2, max_df=0.9)
    kept, expected = expected_features(data, longest, cap, 2, 0.9)
    assert [t for _, t in sorted(rows(vocab, "term_idx", "term"))] == kept
    features = Fe.feature_rows(terms, vocab, [kind], SETTING)
    got = {
        i: {k: round(w, 9) for k, w in zip(indices, weights)}
        for i, indices, weights in rows(features, "article_id", "indices", "weights")
    }
    assert got == expected
    long = Fe.long_features(features)
    assert long.count() == sum(len(v) for v in expected.values())


def test_several_settings_and_representations_in_one_job(spark):
    settings = {"title": "clean_title", "twice": "twice"}
    df = texts(spark, SMALL).withColumn("twice", F.concat("clean_title", F.lit(" "), "clean_title"))
    kinds = [Fe.tfidf_unigram(10), Fe.tfidf_uni_bigram(10)]
    terms = Fe.document_tokens(df, settings)
    vocab = Fe.fitted_vocabulary(terms, df, kinds, settings, min_df=1)
    features = Fe.feature_rows(terms, vocab, kinds, settings)
    assert features.count() == len(SMALL) * 4
    summary = Fe.feature_summary(vocab, df, kinds, settings)
    got = {(s, r): (size, a, b, c) for s, r, size, a, b, c in rows(summary)}
    assert got[("title", "tfidf_unigram")] == (2, 3, 2, 1)
    assert len(got) == 4
    alone = fit(spark, SMALL, kinds[1])[1]
    both = vocab.where("setting = 'title' and representation = 'tfidf_uni_bigram'")
    assert sorted(rows(both)) == sorted(rows(alone))


@pytest.mark.parametrize("longest", [1, 2])
def test_joined_setting_equals_its_joined_text(spark, longest):
    import random

    draw = random.Random(longest)
    words = ["a", "b", "c", "don't", "e", "'", "Zürich"]

    def text():
        return " ".join(draw.choice(words) for _ in range(draw.choice([0, 0, 1, 2, 9])))

    data = [(i, i % 2, draw.choice(["train", "train", "val"]), text(), text(), text()) for i in range(80)]
    df = spark.createDataFrame(data, "article_id long, label int, split string, t string, b string, other string")
    df = df.withColumn("both", F.btrim(F.concat("t", F.lit(" "), "b")))
    kinds = [Fe.Representation("few", longest, 9), Fe.Representation("raw", 1, 50, tfidf=False)]
    apart = Fe.Inputs({"t": "t", "b": "b", "other": "other", "both": "both"})
    joined = Fe.Inputs({"other": "other", "t": "t", "b": "b"}, ("both", "t", "b"))
    found = []
    for inputs in (apart, joined):
        documents = Fe.document_tokens(df, inputs)
        vocab = Fe.fitted_vocabulary(documents, df, kinds, inputs, min_df=1)
        found.append((sorted(rows(vocab)), sorted(rows(Fe.feature_rows(documents, vocab, kinds, inputs)))))
    assert found[0] == found[1] and len(found[0][1]) == 80 * 8


def test_settings_without_any_known_term(spark):
    df = texts(spark, [("train", ""), ("train", "1 2"), ("val", "a")])
    kinds = [Fe.tfidf_unigram(10), Fe.bow_unigram(10)]
    documents = Fe.document_tokens(df, SETTING)
    vocab = Fe.fitted_vocabulary(documents, df, kinds, SETTING)
    assert rows(vocab) == []
    assert {tuple(map(tuple, r)) for r in rows(Fe.feature_rows(documents, vocab, kinds, SETTING), "indices", "weights")} == {((), ())}


def test_pairs_are_counted_only_where_they_can_get_in(spark, monkeypatch):
    import random

    draw = random.Random(3)
    words = ["x y", "don't a", "b", "c", "d", "e", "f", "g", "h", "i"]
    data = [("train", "the " + " ".join(draw.choices(words, range(10, 0, -1), k=draw.randrange(0, 12)))) for _ in range(60)]
    kind, counted = Fe.Representation("kind", 2, 6), []

    def watched(documents, longest, settings=None, *, shortest=1):
        found = counts(documents, longest, settings, shortest=shortest)
        counted.append({t for (t,) in rows(found, "term")})
        return found

    counts = Fe.term_counts
    monkeypatch.setattr(Fe, "term_counts", watched)
    kept, _ = expected_features(data, 2, 6, 2, 0.9)
    _, vocab = fit(spark, data, kind, min_df=2, max_df=0.9)
    assert [t for _, t in sorted(rows(vocab, "term_idx", "term"))] == kept and any(" " in t for t in kept)
    singles, pairs = counted
    assert not any(" " in t for t in singles) and all(" " in t for t in pairs)
    assert len({w for t in pairs for w in t.split()}) < len(singles)
    monkeypatch.setattr(Fe, "PAIR_WORDS", 1)
    _, whole = fit(spark, data, kind, min_df=2, max_df=0.9)
    assert len(counted[3]) > len(pairs) and sorted(rows(whole)) == sorted(rows(vocab))


def test_documents_are_read_once_for_all_counts(spark, tmp_path):
    from tests.test_plan_shapes import plan

    data = [
        (0, 0, "train", "a b", "b c c b"), (1, 0, "train", "", "a b"), (2, 1, "train", "b", ""), (3, 1, "train", None, None),
        (3, 1, "train", "b c", "b c é b'"), (4, 0, "train", "A 1", "c, c"), (5, 0, "val", "b", "a"),
    ]
    df = spark.createDataFrame(data, "article_id long, label int, split string, t string, b string")
    inputs = Fe.Inputs({"t": "t", "b": "b"}, ("both", "t", "b"))
    Fe.document_tokens(df, inputs).write.parquet(f"{tmp_path}/tokens")
    documents = spark.read.parquet(f"{tmp_path}/tokens")

    def expected(known=None):
        import re

        found = {}
        for row in data:
            own = [re.findall(r"[a-z']+", text or "") for text in row[3:]]
            for setting, words in zip(["t", "b", "both"], [*own, own[0] + own[1]]):
                made = [(w,) for w in words] + list(zip(words, words[1:]))
                for term, n in Counter(t for t in made if known is None or known.issuperset(t)).items():
                    df, total = found.get((setting, " ".join(term)), (0, 0))
                    found[setting, " ".join(term)] = (df + 1, total + n)
        return sorted((*at, *n) for at, n in found.items())

    counts = Fe.term_counts(documents, 2, inputs)
    assert plan(counts).count("Scan parquet") == 1 and plan(counts).count("MapInArrow") == 1
    assert sorted(rows(counts)) == expected()
    assert sorted(rows(Fe.term_counts(documents, 2, Fe.only_words(inputs, ["b", "c", "z"])))) == expected({"b", "c", "z"})
    pairs = Fe.term_counts(documents, 2, inputs, shortest=2)
    assert sorted(rows(pairs)) == [row for row in expected() if " " in row[1]]
    assert rows(Fe.term_counts(documents.where("split = 'none'"), 2, inputs)) == []
    assert rows(Fe.term_counts(documents, 2, Fe.only_words(inputs, []))) == []


def test_runs_hold_whole_rows_of_bounded_size(monkeypatch):
    import pyarrow as pa

    from prosemill.functions import terms as Te

    texts = ["a b", None, "b b b a", "c", "a c", None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(texts[::-1])], ["x", "y"])
    monkeypatch.setattr(Te, "RUN_BYTES", 6)
    found = list(Te.runs(batch, ["x", "y"]))
    assert len(found) > 2 and pa.Table.from_batches(found).equals(pa.Table.from_batches([batch]))
    spelled = []
    for run in found:
        (x, y), words = Te.numbered(run, ["x", "y"])
        both = x.then(y)
        spelled += [[words[int(w)].as_py() for w in both.words[both.rows == i]] for i in range(run.num_rows)]
    assert spelled == [" ".join(t for t in pair if t).split() for pair in zip(texts, texts[::-1])]
    assert not list(Te.runs(batch.slice(0, 0), ["x", "y"]))

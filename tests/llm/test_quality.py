import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from prosemill.llm.frames import table
from prosemill.llm import quality as Q
from prosemill.llm.quality import BUCKETS, REACH, WIDTH, Numbers, context_sums, fit, frequent_words, index_vectors, pooled, quality_report, tokens
from tests.conftest import rows
from tests.llm.common import MIDDLE, awkward, documents, empty


def test_context_sums_by_definition(spark):
    docs = documents()[:40]
    df = spark.createDataFrame([(d["doc_id"], d["text"]) for d in docs], "doc_id long, text string").repartition(7)
    places, signs = index_vectors()
    frequent = frequent_words(df)
    numbers = Numbers(frequent)
    want = np.zeros((BUCKETS, WIDTH + 1))
    for d in docs:
        ids = tokens([d["text"]], numbers)[0].tolist()
        for i, word in enumerate(ids):
            want[word, WIDTH] += 1
            for other in ids[max(0, i - REACH) : i] + ids[i + 1 : i + 1 + REACH]:
                np.add.at(want[word], places[other], signs[other])
    want[0, :] = 0
    got = context_sums(df, frequent)
    got[0, :] = 0
    assert np.allclose(got, want)


def test_frequent_words_have_numbers_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(Q, "OWN", 50)
    docs = documents()[:60]
    df = spark.createDataFrame([(d["doc_id"], d["text"]) for d in docs], "doc_id long, text string").repartition(5)
    counts = Counter(w for d in docs for w in Q.TOKEN.findall(d["text"] or ""))
    frequent = frequent_words(df)
    assert frequent == sorted(counts, key=lambda w: (-counts[w], w.encode()))[:50]
    numbers = Numbers(frequent)
    assert [numbers[w] for w in frequent] == list(range(1, 51))
    assert all(50 < numbers[w] < BUCKETS for w in counts if w not in frequent)


def test_pooling_by_definition():
    random = np.random.default_rng(3)
    numbers = Numbers(["a", "b", "c"])
    vectors, weights = random.normal(size=(BUCKETS, 4)).astype(np.float32), random.random(BUCKETS).astype(np.float32)
    texts = ["a b b strange", "", "c", "!! a"]
    found = pooled(texts, numbers, vectors, weights)
    for text, got in zip(texts, found, strict=True):
        ids = [numbers[w] for w in Q.TOKEN.findall(text)]
        if not ids:
            assert not got.any()
            continue
        w, v = weights[ids], vectors[ids]
        mean = (v * w[:, None]).sum(0) / w.sum()
        spread = np.sqrt((w[:, None] * (v - mean) ** 2).sum(0) / w.sum())
        assert np.allclose(got, np.concatenate([mean, spread]), atol=1e-3)


def test_network_learns_and_is_calibrated():
    random = np.random.default_rng(1)
    x = random.normal(size=(4000, 10))
    chance = 1 / (1 + np.exp(-2 * x[:, 0] * x[:, 1]))
    y = (random.random(4000) < chance).astype(float)
    scores = fit(x[:3000], y[:3000]).scores(x[3000:])
    assert np.abs(scores - chance[3000:]).mean() < 0.12


def test_held_out_order(spark):
    found = quality_report(table(spark, MIDDLE, "documents"), table(spark, MIDDLE, "labels"))
    got = rows(found.join(table(spark, MIDDLE, "labels"), "doc_id"), "doc_id", "held_out", "score", "predicted", "quality")
    assert all(held == (zlib.crc32(str(i).encode()) % 3 == 1) and p == (s >= 0.5) and 0 <= s <= 1 for i, held, s, p, _ in got)
    good, bad = ([r[2] for r in got if r[1] and r[4] == q] for q in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.9
    assert found.count() == 1000


def test_awkward_rows(spark):
    df = awkward(spark)
    labels = spark.createDataFrame([(1, 1), (1, 1), (6, 0), (8, None), (77, 1)], "doc_id long, quality int")
    got = rows(quality_report(df, labels), "score")
    assert len(got) == df.count() and all(0 <= r[0] <= 1 for r in got)
    assert {round(r[0], 9) for r in rows(quality_report(df, labels.where("quality = 2")), "score")} == {0.5}
    none = quality_report(empty(spark), labels.where(F.lit(False)))
    assert none.count() == 0

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from prosemill.llm import importance as I
from tests.conftest import rows
from tests.llm.common import AWKWARD, SCHEMA, awkward, empty, random_text

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SMALL = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def grams(text, longest):
    words = WORD.findall((text or "").translate(SMALL))
    return [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)], len(words)


def plain(docs, target, percent=10, least=20, longest=1, buckets=10_000, scale=1000, seed=2024):
    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    corpus, wanted = Counter(), Counter()
    for _, text in docs:
        corpus.update(map(bucket, grams(text, longest)[0]))
    for text in target:
        wanted.update(map(bucket, grams(text, longest)[0]))
    s_all, t_all = float(corpus.total()), float(wanted.total())
    result, pool = [], []
    for n, (doc_id, text) in enumerate(docs):
        found, words = grams(text, longest)
        gained = [math.floor(scale * math.log((wanted[b] + 1.0) * (s_all + buckets) / ((corpus[b] + 1.0) * (t_all + buckets)))) for b in map(bucket, found)]
        weight = sum(gained) // len(gained) if gained else 0
        name = f"{seed}:{'' if doc_id is None else doc_id}".encode()
        h = int(hashlib.sha256(name).hexdigest()[:8], 16)
        score = weight + math.floor(-scale * math.log(-math.log((h + 0.5) / 2**32)))
        result.append([doc_id, len(found), weight, score, None])
        if words >= least:
            pool.append((-score, doc_id is None, doc_id or 0, n))
    for rank, key in enumerate(sorted(pool)[: percent * len(pool) // 100], 1):
        result[key[3]][4] = rank
    return sorted(map(tuple, result), key=str)


@pytest.mark.parametrize(("longest", "percent"), [(1, 10), (2, 35), (3, 100)])
def test_agrees_with_plain_code(spark, longest, percent):
    docs = [(i, random_text(i, i % 70)) for i in range(300)] + [(None, random_text(5, 40)), (301, None)]
    target = ["alpha1 beta2 gamma3 Alpha1", None, "", "zeta9 " * 30]
    df = spark.createDataFrame(docs, SCHEMA).repartition(5)
    items = spark.createDataFrame([(t,) for t in target], "text string")
    found = I.resampled(df, items, percent=percent, longest=longest, buckets=500)
    assert sorted(rows(found), key=str) == plain(docs, target, percent, longest=longest, buckets=500)


@pytest.mark.parametrize("block", [1, 7, 1 << 20])
def test_cutoff_is_exact(spark, block):
    rng = random.Random(block)
    keys = [(rng.choice([-3, 0, 0, 0, 5, rng.randrange(50)]), rng.choice([None, 1, rng.randrange(90)]), n) for n in range(700)]
    df = spark.createDataFrame(keys, I.KEYS).repartition(6)
    ranked = sorted((I.Key(*k) for k in keys), key=I.Key.order)
    for count in (1, 2, 69, 350, 699, 700):
        last = I.cutoff(df, count, block_keys=block, few=3)
        assert last == ranked[count - 1]
    assert df.where(ranked[68].reached()).count() == 69
    assert I.cutoff(df, 0) is None and I.cutoff(df, 701) is None


def test_each_round_discards_a_fixed_share():
    rng = random.Random(4)
    for _ in range(50):
        blocks = [sorted(rng.sample(range(10**6), rng.randrange(1, 40))) for _ in range(rng.randrange(1, 30))]
        medians = [(len(b), I.Key(-b[(len(b) - 1) // 2], 0, 0)) for b in blocks]
        pivot = -I.weighted_median(medians).score
        everything = [k for b in blocks for k in b]
        assert sum(k <= pivot for k in everything) * 4 >= len(everything)
        assert sum(k >= pivot for k in everything) * 4 >= len(everything)


def test_awkward_and_empty_tables(spark):
    items = spark.createDataFrame([("word lazy dog",)], "text string")
    found = rows(I.resampled(awkward(spark), items, percent=100, least_words=1))
    assert [r[:4] for r in sorted(found, key=str)] == [r[:4] for r in plain(AWKWARD, ["word lazy dog"], 100, 1)]
    assert sorted(r[4] for r in found if r[4]) == list(range(1, 11))
    assert rows(I.resampled(empty(spark), items)) == []
    nothing = rows(I.resampled(awkward(spark), items.where("false")))
    assert sorted(nothing, key=str) == plain(AWKWARD, [])


def test_very_long_texts(spark):
    docs = [(1, "x" * 5_000_000), (2, "one two " * 600_000)] + [(i, "one two three " * 10) for i in range(3, 30)]
    found = rows(I.resampled(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame([("one",)], "text string")))
    assert sorted(found, key=str) == plain(docs, ["one"])

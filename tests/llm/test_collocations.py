import random
import re
from collections import Counter

import pytest

from prosemill.llm import collocations as C
from tests.conftest import rows
from tests.llm.common import awkward

SCHEMA = "doc_id long, text string, lang string"


def plain(docs, least, covered=80, first=2000, longest=4):
    """The contract, word for word, with plain counters."""
    counts, words = {}, Counter()
    small = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for text, lang in docs:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(small)):
            found = re.findall("[^ \t]+", piece)
            words[lang or "und"] += len(found)
            for size in range(1, longest + 1):
                for k in range(len(found) - size + 1):
                    counts.setdefault(lang or "und", Counter())[tuple(found[k : k + size])] += 1
    result = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        ranked = []
        for p, a in candidates.items():
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            inside = [q for q in candidates if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not any(100 * f[q] >= covered * a for q in inside):
                ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:first], 1):
            result.append((lang, rank, phrase.decode(), -a, left, right, words[lang], -score))
    return sorted(result)


def texts(seed, n=60):
    rng = random.Random(seed)
    words = ["Ab", "b", "c", "ü", "d-e", "東京", "x\x1cy", "f"]
    made = []
    for _ in range(n):
        size = rng.choice([0, 1, 5, 40, 200])
        made.append("".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t ", ". ", "\r"]) for _ in range(size)))
    return made + [made[3]] * 5 + ["b b b b " * 50, "ab c. " * 40]


@pytest.mark.parametrize("period", [1, 2, 16])
def test_agrees_with_plain_counts(spark, period):
    docs = [(i, t, [None, "en", "fr"][i % 3]) for i, t in enumerate(texts(period))]
    docs += [(999, None, "de"), (998, "a a", "und")]
    df = spark.createDataFrame(docs, SCHEMA).repartition(4)
    want = plain([(t, lang) for _, t, lang in docs], 5, first=25)
    assert sorted(rows(C.collocations(df, least=5, first=25, period=period))) == want and len(want) > 30


def test_a_full_bit_table_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(C, "WIDEST", 6)
    monkeypatch.setattr(C, "NARROWEST", 6)
    docs = [(i, t, "en") for i, t in enumerate(texts(9))]
    df = spark.createDataFrame(docs, SCHEMA)
    assert sorted(rows(C.collocations(df, least=4))) == plain([(t, lang) for _, t, lang in docs], 4)


def test_every_word_is_one_chunks_own():
    found = [p for t in texts(3) for p in C.pieces(t)]
    for period in (1, 3, 16):
        chunks = C.parsed(found, period=period)
        assert sum(own * times for (_, own), times in chunks.items()) == sum(p.count(b" ") + 1 for p in found)
    # equal passages give equal chunks wherever they stand
    passage = b" ".join(b"w%d" % (i * i % 97) for i in range(300))
    once, twice = C.parsed([passage], period=4), C.parsed([b"other " + passage, passage], period=4)
    assert sum((once & twice).values()) >= len(once) - 1 and len(twice) <= len(once) + 2


def test_arithmetic_is_exact_beyond_64_bits(spark):
    big = 3 * 10**17
    known = spark.createDataFrame(
        [("en", "a", big + 1, 1), ("en", "b", big, 1), ("en", "c", big, 1), ("en", "a b", big - 1, 2), ("en", "b c", big // 3, 2),
         ("en", "a b c", big // 3, 3)], "lang string, phrase string, n long, size int")
    words = spark.createDataFrame([("en", 10**18)], "lang string, n long")
    found = {r["phrase"]: (r["rank"], r["score"]) for r in C.best_phrases(known, words).collect()}
    first = (1, 2000000 * (big - 1) // (2 * big + 1))
    longer = min(2000000 * (big // 3) // (big + 1 + big // 3), 2000000 * (big // 3) // (big - 1 + big))
    assert found == {"a b": first, "a b c": (2, longer)}


def test_awkward_and_empty_tables(spark):
    from pyspark.sql import functions as F

    df = awkward(spark).withColumn("lang", F.lit(None).cast("string")).withColumn("phrase", F.lit(1))
    found = rows(C.collocations(df, least=2))
    want = plain([(r["text"], None) for r in df.select("text").collect()], 2)
    assert sorted(found) == want and any(r[2] == "word word word word" for r in found)
    assert rows(C.collocations(spark.createDataFrame([], SCHEMA))) == []
    assert rows(C.collocations(spark.createDataFrame([(1, "a b c", "en")], SCHEMA))) == []


def test_very_long_texts(spark):
    long_word, many = "x" * 5_000_000, "one two three four five " * 210_000
    df = spark.createDataFrame([(1, long_word, "en"), (2, many, "en")], SCHEMA)
    found = {r["phrase"]: r["a"] for r in C.collocations(df).collect()}
    assert found["one two three four"] == 210_000 and found["five one two three"] == 209_999 and len(found) == 5

import hashlib
import re

import pytest

from prosemill.llm.decontamination import contamination, contamination_digest, without_benchmark
from prosemill.llm.frames import table
from tests.conftest import rows
from tests.llm.common import SF, awkward, documents, empty

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
ITEMS = [
    ("q1", "One two three four five six seven eight nine ten eleven twelve"), ("q2", "QUICK brown"), ("q3", None), ("q4", "?!"),
    ("q5", "word word word word word word word word word word word"), ("q2", "quick brown"), ("q6", "façade naïve"),
]
TEXTS = [
    (1, "zero ONE, two three four five six seven eight nine ten... eleven! thirteen"), (2, "the quick-brown fox"), (3, "quickbrown"),
    (4, None), (5, "a façade; naïve view"), (6, "two three four five six seven eight nine ten eleven twelve one"), (7, "word " * 30),
]


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low)


def brute(texts, items):
    out = []
    sets = [(i, {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))}) for i, t in items if (w := words(t))]
    for doc_id, text in texts:
        w = words(text)
        hit, found = set(), set()
        for item, windows in sets:
            for window in windows:
                for k in range(len(w) - len(window) + 1):
                    if tuple(w[k : k + len(window)]) == window:
                        hit.update(range(k, k + len(window)))
                        found.add(item)
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit)))
    return out


def test_awkward_texts_against_plain_search(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string").unionByName(awkward(spark).select("doc_id", "text"))
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    want = brute([(r[0], r[1]) for r in docs.collect()], ITEMS)
    assert sorted(rows(contamination_digest(docs, items)), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("block_bytes", [20, 60])
def test_blocks_of_items_give_the_same(spark, block_bytes):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    whole = rows(contamination(docs, items), "doc_id", "n_words", "hits", "items")
    apart = rows(contamination(docs, items, block_bytes=block_bytes), "doc_id", "n_words", "hits", "items")
    assert sorted(map(str, whole)) == sorted(map(str, apart))


def test_offsets_point_into_the_original(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    texts = dict(TEXTS)
    for doc_id, hits in rows(contamination(docs, items), "doc_id", "hits"):
        for h in hits:
            assert words(texts[doc_id][h["begin"] : h["end"]]) == [words(texts[doc_id])[h["word"]]]


def test_real_tables(spark):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    want = brute([(d["doc_id"], d["text"]) for d in documents()], [(str(r[0]), r[1]) for r in items.select("item_id", "text").collect()])
    assert sorted(rows(contamination_digest(docs, items))) == sorted(want)
    kept = without_benchmark(docs, items)
    assert kept.columns == docs.columns and sorted(r[0] for r in rows(kept, "doc_id")) == sorted(w[0] for w in want if not w[5])


def test_nothing_to_search(spark):
    items = spark.createDataFrame([], "item_id string, text string")
    assert contamination_digest(empty(spark), items).count() == 0
    assert rows(contamination_digest(awkward(spark), items).where("contaminated")) == []

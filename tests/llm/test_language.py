import zlib
from collections import Counter

import numpy as np

from prosemill.llm.frames import table
from prosemill.llm.language import Classifier, counted, gram_text, grams, language_profiles, language_report, with_language
from tests.conftest import rows
from tests.llm.common import MIDDLE, awkward, documents, empty


def plain_grams(text):
    """All n-grams by definition: words of letters, closed in by single blanks."""
    closed = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    closed = " " + " ".join(closed.split(" ")).strip() + " "
    while "  " in closed:
        closed = closed.replace("  ", " ")
    if not closed.strip():
        return Counter()
    out = Counter(c for c in closed if c != " ")
    out.update(closed[i : i + 2] for i in range(len(closed) - 1))
    out.update(closed[i : i + 3] for i in range(len(closed) - 2) if closed[i + 1] != " ")
    return out


def test_grams_by_definition():
    for text in ["Ab, cd!", "", "...", "a", "Été à  la plage 12x", "東京 tower"]:
        values, numbers = counted(grams(text))
        assert {gram_text(int(v)): int(n) for v, n in zip(values, numbers, strict=True)} == plain_grams(text)


def test_profiles_and_distances_by_definition(spark):
    docs = documents(MIDDLE)[:150]
    df = spark.createDataFrame([(d["doc_id"], d["text"], d["lang"]) for d in docs], "doc_id long, text string, lang string")
    sums = {}
    for d in docs:
        sums.setdefault(d["lang"], Counter()).update(plain_grams(d["text"]))
    order = lambda c: sorted(c, key=lambda g: (-c[g], [0] * (3 - len(g)) + [ord(x) for x in g]))[:400]
    want = {lang: order(c) for lang, c in sums.items()}
    got = sorted(rows(language_profiles(df), "lang", "place", "gram"))
    assert [(lang, place, gram_text(g)) for lang, place, g in got] == [(lang, i + 1, g) for lang in sorted(want) for i, g in enumerate(want[lang])]

    model = Classifier([(lang, g, place) for lang, place, g in got])
    for d in docs[:40]:
        own = order(plain_grams(d["text"]))
        charge = {lang: sum(abs(p.index(g) - i) if g in p else 400 for i, g in enumerate(own)) for lang, p in want.items()}
        lang, score = model.predict(d["text"])
        assert charge[lang] == min(charge.values()) and np.isclose(score, 1 - charge[lang] / (400 * len(own)))


def test_held_out_accuracy(spark):
    docs = table(spark, MIDDLE, "documents")
    found = language_report(docs).join(docs.select("doc_id", "lang"), "doc_id")
    got = rows(found, "doc_id", "held_out", "lang", "lang_pred", "score")
    assert all(held == (zlib.crc32(str(i).encode()) % 4 == 2) for i, held, *_ in got)
    held = [r for r in got if r[1]]
    assert len(held) > 150 and sum(r[2] == r[3] for r in held) / len(held) > 0.99
    assert all(0 <= r[4] <= 1 for r in got)


def test_awkward_rows(spark):
    from pyspark.sql import functions as F

    df = awkward(spark).withColumn("lang", F.when(F.col("doc_id") > 5, "xx"))
    got = {r[0]: r[1] for r in rows(language_report(df), "doc_id", "lang_pred")}
    assert got[2] == got[3] == got[4] == got[10] == "und" and got[1] == "xx"
    kept = with_language(df)
    assert kept.columns == df.columns and sorted({r[0] or 0 for r in rows(kept, "doc_id")}) == [0, 1, 5, 6, 8, 9, 11, 12]
    none = empty(spark).withColumn("lang", F.lit(None).cast("string"))
    assert language_report(none).count() == 0
    assert {r[0] for r in rows(language_report(df.withColumn("lang", F.lit(None).cast("string"))), "lang_pred")} == {"und"}


def test_texts_with_letters_stay_when_nothing_was_learned(spark):
    from pyspark.sql import functions as F

    for lang in (None, "und"):
        df = awkward(spark).withColumn("lang", F.lit(lang).cast("string"))
        kept = with_language(df)
        assert kept.columns == df.columns and sorted({r[0] or 0 for r in rows(kept, "doc_id")}) == [0, 1, 5, 6, 8, 9, 11, 12]

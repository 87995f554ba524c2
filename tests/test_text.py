import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from prosemill.functions import matching, text
from tests.conftest import rows


def column(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "i int, c string").coalesce(1)


def evaluated(spark, values, function):
    df = column(spark, values).select("i", function(F.col("c")).alias("v"))
    return [value for _, value in sorted(rows(df), key=lambda r: r[0])]


def test_white_space_agrees_with_python_for_every_character(spark):
    points = [i for i in range(1, 0x3100) if not 0xD800 <= i <= 0xDFFF]
    values = [chr(i) + "a" + chr(i) + "b" + chr(i) for i in points]
    assert evaluated(spark, values, text.strip) == [v.strip() for v in values]
    assert evaluated(spark, values, text.word_count) == [len(v.split()) for v in values]


def test_word_count_of_null_blank_and_padded(spark):
    values = [None, "", " \t\n", " a  b c ", "one"]
    assert evaluated(spark, values, text.word_count) == [0, 0, 0, 3, 1]
    assert evaluated(spark, values, text.is_blank) == [True, True, True, False, False]


def test_preview_cuts_before_replacing(spark):
    value = "a\n" * 150
    assert evaluated(spark, [value], text.preview) == [value[:200].replace("\n", " ")]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(0, 1000, allow_nan=False), min_size=1, max_size=40))
def test_half_even_rounding_scales_like_numpy(spark, values):
    import numpy as np

    df = spark.createDataFrame([(v,) for v in values], "v double").coalesce(1)
    got = [r[0] for r in rows(df.select(text.round_half_even(F.col("v"), 2)))]
    assert got == [float(np.round(v, 2)) for v in values]


def test_feature_tokens_and_bigrams(spark):
    values = ["x", "x y z", "", "' a'b", "Don't"]
    assert evaluated(spark, values, text.tokens) == [
        ["x"], ["x", "y", "z"], [], ["'", "a'b"], ["on't"],
    ]
    pairs = evaluated(spark, values, lambda c: text.bigrams(text.tokens(c)))
    assert pairs == [[], ["x y", "y z"], [], ["' a'b"], []]


def test_profile_words_take_whole_runs_only(spark):
    values = ["The café don't x1 under_score A ok OK the"]
    got = evaluated(spark, values, lambda c: text.profile_words(c, ["the"]))
    assert got == [["don", "ok", "ok"]]


@pytest.mark.parametrize(
    ("value", "marker", "expected"),
    [
        ("CNN said", "cnn", True),
        ("écnn", "cnn", False),
        ("_cnn_", "cnn", False),
        ("cnn2", "cnn", False),
        ("(cnn)", "cnn", True),
        ("the new york times.", "new york times", True),
        ("new  york times", "new york times", False),
        ("a.b", "a.b", True),
        ("axb", "a.b", False),
        ("x(ap) y", "(ap)", False),
        ("x(ap)y", "(ap)", True),
    ],
)
def test_whole_word_markers(spark, value, marker, expected):
    assert evaluated(spark, [value], lambda c: matching.has_marker(c, marker)) == [expected]
    if expected:
        assert evaluated(spark, [value], lambda c: matching.may_have_marker(c, [marker])) == [True]


def test_counting_in_the_row_equals_a_counter(spark):
    from collections import Counter

    from prosemill.operators.words import counted_in_row

    draw = random.Random(5)
    lists = [[draw.choice("abcd") for _ in range(draw.randrange(0, 30))] for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(lists)), "i int, terms array<string>")
    for i, counted in rows(counted_in_row(df, "terms")):
        assert {e["term"]: e["tf"] for e in counted} == dict(Counter(lists[i]))


MARKERS = ["new york", "new york times", "times and fox", "fox news", "fox", "u.s.", "(afp)", "k-9", "times", "s"]


def test_all_markers_by_one_search(spark):
    """Overlapping, nested and case-folded markers against one search for each."""
    import random

    from prosemill.functions.matching import found_markers, has_marker

    draw = random.Random(8)
    bits = ["New York", "new  york", "Times", "times and fox", "Fox News", "foxnews", "U.S.", "u.s", "(AFP)", "k-9", "K-9", "\u212a-9", "ſ", "s", "fox", "and", "-", "_", ".", "é"]
    texts = ["".join(draw.choice(bits) + draw.choice([" ", " ", "", ","]) for _ in range(draw.randrange(9))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, c string")
    for markers in (MARKERS, MARKERS[:5], ["fox"]):
        for ignore in (True, False):
            one = found_markers(df, "c", markers, "found", ignore_case=ignore)
            each = F.array_compact(F.array(*[F.when(has_marker(F.col("c"), m, ignore_case=ignore), F.lit(m)) for m in markers]))
            wrong = one.where(~F.col("found").eqNullSafe(each)).collect()
            assert wrong == [], wrong[:3]
    plan = one._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1

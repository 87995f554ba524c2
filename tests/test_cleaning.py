import pytest
from pyspark.sql import functions as F

from prosemill import schema as S
from prosemill.functions.cleaning import SOURCE_MARKERS, clean_column
from prosemill.operators import cleaning as Cl
from tests.conftest import rows

CASES = [
    (None, "", ""),
    ("&lt;b&gt;Hi&lt;/b&gt; &amp; bye", "hi bye", "hi bye"),
    ("See https://x.org/a?b=1 now", "see now", "see now"),
    ("go WWW.x.org/ now", "go now", "go now"),
    ("mail a.b@c.org!", "mail", "mail"),
    ("WASHINGTON (Reuters) - The vote", "the vote", "washington reuters the vote"),
    ("FOX NEWS - live", "live", "fox news live"),
    ("COVID-19 cases rise", "cases rise", "covid cases rise"),
    ("The New York Times and CNN", "the and", "the new york times and cnn"),
    ("CNN CNN cnn.", "", "cnn cnn cnn"),
    ("_cnn_ said", "cnn said", "cnn said"),
    ("New-York Times report", "new york times report", "new york times report"),
    ("foxnews.com", "foxnews com", "foxnews com"),
    ("don''t  stop", "don't stop", "don't stop"),
    ("Café 2020!", "caf", "caf"),
    ("' '", "' '", "' '"),
    ("tab and\nline", "tab and line", "tab and line"),
    ('<script>var t="</p>";</script>x', "var t x", "var t x"),
    ("&amp;lt;b&amp;gt;", "lt b gt", "lt b gt"),
    ("x &notanentity; &copy y", "x anentity y", "x anentity y"),
]


@pytest.mark.parametrize("remove", [True, False])
def test_hand_fixtures(spark, remove):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, c string")
    got = dict(rows(clean_column(df, "c", "clean", remove_markers=remove), "i", "clean"))
    assert got == {i: c[1] if remove else c[2] for i, c in enumerate(CASES)}


# What each piece leaves behind between two plain words, worked out by hand.
LEAVES = {
    "CNN": "", "cnn": "", "Reuters": "", "(REUTERS)": "", "( reuters )": "", "New York Times": "", "FOX NEWS": "",
    "BREITBART": "", "-": "", "—": "", "&amp;": "", "&lt;i&gt;": "", "<b x='1'>": "", "</b>": "", "http://a.b/c": "",
    "HTTPS://X": "", "www.x": "", "a@b.co": "", "x.y+z@sub.host.org": "", "été": "t", "it''s": "it's", "word": "word",
    "Word2": "word", "U.S.": "u s", "LONDON": "london", "&#39;": "'", "_cnn_": "cnn", "cnn2": "cnn",
    "New  York  Times": "new york times", "x@y": "x y", "2020": "", "foxnews": "foxnews", "'" * 4: "'", "\x1c": "", "&nbsp;": "",
}


def test_pieces_between_plain_words(spark):
    import random

    draw = random.Random(11)
    chosen = [[draw.choice(list(LEAVES)) for _ in range(draw.randrange(9))] for _ in range(2000)]
    texts = ["so " + "".join(f"{piece} so{draw.choice([' ', '  ', chr(10), chr(9)])}" for piece in pieces) for pieces in chosen]
    wanted = [" ".join(" ".join(["so", *[f"{LEAVES[piece]} so" for piece in pieces]]).split()) for pieces in chosen]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, c string")
    got = dict(rows(clean_column(df, "c", "clean"), "i", "clean"))
    wrong = [(t, got[i], w) for i, (t, w) in enumerate(zip(texts, wanted, strict=True)) if got[i] != w]
    assert wrong == []


def test_form_of_the_result(spark):
    import random

    draw = random.Random(12)
    alphabet = "aB'' \t\n<>&;@.:/-—()é0_ſİ"
    texts = ["".join(draw.choice(alphabet) for _ in range(draw.randrange(40))) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, c string")
    once = clean_column(df, "c", "clean")
    for clean, again in rows(clean_column(once, "clean", "again"), "clean", "again"):
        assert set(clean) <= set("abcdefghijklmnopqrstuvwxyz' ")
        assert clean == clean.strip() and "  " not in clean and "''" not in clean
        assert again == clean


def articles(spark):
    data = [
        (0, 7, "CNN - Title", "Body (Reuters) text &amp; more", 1, "old"),
        (1, 9, None, "x", 0, "old"),
    ]
    columns = "article_id long, source_row_id long, title string, text string, label int, clean_title string"
    return spark.createDataFrame(data, columns).withColumn("Unnamed: 3", F.lit(1)).withColumn("extra", F.lit("e"))


def test_cleaned_table_has_fixed_order_and_no_leftovers(spark):
    cleaned = Cl.cleaned_articles(articles(spark))
    known = [c for c in S.CLEANED_COLUMNS if c in cleaned.columns]
    assert cleaned.columns == [*known, "extra"]
    first = cleaned.where("article_id = 0").collect()[0]
    assert first["clean_title"] == "title"
    assert first["clean_title_with_markers"] == "cnn title"
    assert first["clean_title_body"] == "title body text more"
    assert first["raw_title_body"] == "CNN - Title Body (Reuters) text &amp; more"
    assert first["clean_combined_word_count"] == 4
    kept = Cl.cleaned_articles(articles(spark), remove_markers=False).where("article_id = 0")
    assert kept.collect()[0]["clean_title"] == "cnn title"


def test_missing_and_duplicate_columns_are_refused(spark):
    df = articles(spark)
    with pytest.raises(ValueError, match=r"\['label', 'text'\]"):
        Cl.cleaned_articles(df.drop("text", "label"))
    with pytest.raises(ValueError, match="Duplicate column names"):
        Cl.cleaned_articles(df.select("*", F.col("extra")))


def test_quality_report(spark):
    original = articles(spark)
    report = Cl.quality_report(original, Cl.cleaned_articles(original)).collect()[0].asDict()
    assert report["input_rows"] == report["output_rows"] == 2
    assert report["label_counts"] == {"0": 1, "1": 1}
    assert report["label_mapping"] == {"0": "real", "1": "fake"}
    assert report["blank_clean_titles"] == 1 and report["blank_clean_bodies"] == 0
    assert report["mean_clean_title_words"] == 0.5 and report["mean_clean_body_words"] == 2.0
    assert report["duplicate_article_ids"] == 0
    assert report["configured_markers"] == SOURCE_MARKERS
    assert not report["stemming_applied"]

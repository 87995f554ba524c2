"""What the physical plans must and must not hold."""

import re

import pytest

import __spark_entry__ as entry
from prosemill.catalog import features as KF
from prosemill.catalog import profile as KP
from prosemill.catalog import stage1 as KS
from prosemill.catalog.articles import documents, labels
from prosemill.operators import features as Fe
from prosemill.operators import lengths as L
from prosemill.operators import sampling as Sa
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_narrow_queries_join_no_texts(spark):
    for df in (KP.measured(spark, SF), KP.groups(spark, SF)):
        for line in plan(df).splitlines():
            if "Join" in line:
                assert "text#" not in line
    text = plan(L.histogram(KP.measured(spark, SF), L.WORD_COUNTS))
    assert "SinglePartition" not in text and "Python" not in text


def test_sample_reads_ids_and_labels_only(spark):
    df = Sa.sample_and_split(labels(spark, SF).withColumnRenamed("source_row_id", "article_id"))
    text = plan(df)
    assert all("toxic" not in line for line in text.splitlines() if "ReadSchema" in line)


def test_rank_uses_one_partition_for_bucket_ranges_only(spark):
    text = plan(KS.numbered(spark, SF))
    single = [line for line in text.splitlines() if "SinglePartition" in line]
    assert len(single) == 1  # over wide ranges of ids
    assert text.count("Python") == 0


def test_python_only_decodes_entities(spark):
    with_python = {
        name
        for name in ("articles_stage1", "clean_word_counts", "clean_pages_html", "marker_gap", "top_words_by_label")
        if "Python" in plan(entry.queries()[name](spark, SF))
    }
    assert with_python == {"clean_word_counts", "clean_pages_html"}


def test_top_words_are_limited_before_the_last_shuffle(spark):
    text = plan(entry.queries()["top_words_by_label"](spark, SF))
    assert "row_number(), 20, Partial" in text and "row_number(), 20, Final" in text
    # No size filter that builds the counted array a second time (see `unpacked`).
    assert not re.search(r"Filter.*size\(transform", text)


def test_documents_stay_in_their_rows(spark):
    """From the written tokens on, a feature query shuffles no document and tokenizes nothing again."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("bow_unigram", "tfidf_unigram", "tfidf_uni_bigram", "feature_matrix_packed"):
            text = plan(entry.queries()[name](spark, SF))
            assert "Exchange" not in text and "Join" not in text and "Generate explode" not in text, name
            assert "regexp_extract_all" not in text and "tokens" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_each_text_is_tokenized_once(spark):
    parts = KF.split(spark, SF)
    texts = Sa.split_texts(parts, KF.lowered(spark, SF), list(KF.INPUTS.own.values()), id_col="source_row_id")
    before = plan(texts)
    after = plan(Fe.document_tokens(texts, KF.INPUTS, id_col="source_row_id"))
    assert after.count("Exchange") == before.count("Exchange")
    assert after.count("regexp_extract_all") == 2 * (1 + before.count("regexp_extract_all"))  # title and body, in both branches of the union


def test_split_starts_no_job(spark):
    tracker, group = spark.sparkContext.statusTracker(), "no-job"
    table = labels(spark, SF)
    spark.sparkContext.setJobGroup(group, "split")
    try:
        Sa.sample_and_split(table, id_col="source_row_id")
        Sa.sample_and_split(table, 40, id_col="source_row_id")
        assert not tracker.getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_vocabulary_is_limited_before_the_last_shuffle(spark):
    text = plan(entry.queries()["vocab_uni_bigram"](spark, SF))
    cap = KF.UNI_BIGRAM.max_features
    assert f"row_number(), {cap}, Partial" in text


def test_capping_needs_no_join(spark):
    counts = L.with_lengths(documents(spark, SF))
    assert "Join" not in plan(L.capped(counts, L.WORD_COUNTS))


def test_stripped_of_skew_by_histogram(spark):
    df = spark.createDataFrame([(0, 1), (0, 2), (0, 3), (0, 10)], "label int, title_word_count int")
    hist = L.histogram(df, ["title_word_count"], by=["label"])
    stats = rows(L.describe(hist), "count", "mean", "median", "max")
    assert stats == [(4, 4.0, 2.5, 10)]
    assert rows(L.upper_limits(hist), "upper_limit")[0][0] == pytest.approx(9.79)


import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from prosemill import schema as S
from prosemill.catalog.articles import documents, labelled
from prosemill.plans import cleaning, features, profile, stage1
from prosemill.sources.tables import read_features, read_split_tables
from tests.conftest import rows

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("run"))
    raw = labelled(documents(spark, SF), SF).withColumnRenamed(S.ROW_ID, "Unnamed: 0")
    first = stage1.run(raw, f"{out}/handoff", expected={"original": 399, "master": 385}, gzip_csv=True)
    cleaned = cleaning.run(first.complete_cases, f"{out}/processed", markers=["with"], csv=True)
    built = features.run(
        cleaned.articles, f"{out}/features", 40, max_features_unigram=200, max_features_bigram=300, settings=features.CLEANED
    )
    return out, raw, first, cleaned, built


def test_handoff(run):
    _, raw, first, _, _ = run
    counts = {stage: (actual, status) for stage, actual, _, status in rows(first.counts)}
    assert counts["original"] == (399, "OK") and counts["master"] == (385, "OK")
    assert first.master.count() + first.removed.count() == raw.count()
    assert first.complete_cases.count() + first.incomplete_cases.count() == first.master.count()
    ids = sorted(i for (i,) in rows(first.master, S.ARTICLE_ID))
    assert ids == list(range(385))
    per_label = rows(stage1.label_counts(first))
    assert [(label, complete) for label, _, complete in per_label] == [(0, 43), (1, 307)]
    assert sum(master for _, master, _ in per_label) == 385


def test_cleaned(run):
    _, _, first, cleaned, _ = run
    report = cleaned.report.collect()[0]
    assert report["input_rows"] == report["output_rows"] == 350
    assert report["duplicate_article_ids"] == 0
    audit = {(s, label): n for s, _, label, _, n, _, _ in rows(cleaned.marker_audit)}
    assert audit["before_preprocessing", 1] > 0 and audit["after_preprocessing", 1] == 0
    assert [i for (i,) in rows(cleaned.samples, S.ARTICLE_ID)] == sorted(
        i for (i,) in rows(first.complete_cases, S.ARTICLE_ID)
    )[:20]


def test_features(run, spark):
    out, _, _, cleaned, built = run
    folder = f"{out}/features/40perclass"
    tables = read_split_tables(spark, f"{folder}/split_assignment")
    assert {name: t.count() for name, t in tables.items()} == {"train": 64, "val": 8, "test": 8}
    matrices = read_features(spark, f"{folder}/features", "combined", "tfidf_uni_bigram")
    for name, matrix in matrices.items():
        assert rows(matrix, "article_id") == rows(tables[name], "article_id")
    weights = F.aggregate("weights", F.lit(0.0), lambda acc, w: acc + w * w)
    for (norm,) in rows(matrices["train"].select(F.round(weights, 9))):
        assert norm in (0.0, 1.0)
    sizes = {(s, r): n for s, r, n, *_ in rows(built.summary)}
    assert len(sizes) == 6 and sizes["combined", "tfidf_unigram"] == 200
    assert sizes["body", "tfidf_uni_bigram"] == 300


def test_missing_vocabulary_is_an_error(run, tmp_path):
    _, _, _, cleaned, _ = run
    with pytest.raises(ValueError, match="No terms remain"):
        features.run(cleaned.articles, str(tmp_path), 40, min_df=1000)


def test_profile(run, tmp_path):
    _, raw, _, _, _ = run
    tables = profile.run(raw, markers=["with", "this"])
    quality = dict(rows(tables["data_quality_summary"]))
    assert quality["Total records"] == 399
    assert quality["Duplicate title-text articles ignoring label"] == 14
    assert rows(tables["full_row_duplicates"]) == [(399, 0)]
    assert {r[0] for r in rows(tables["source_marker_percentage_comparison"])} == {"with", "this"}
    assert rows(tables["label_distribution"], S.LABEL, "record_count") == [(0, 58), (1, 341)]
    profile.write({"duplicate_analysis": tables["duplicate_analysis"]}, str(tmp_path))
    assert profile.examples(raw).count() == 10


def test_conflict_and_repeated_id_stop_stage1(spark, tmp_path):
    columns = "source_row_id long, title string, text string, label int"
    conflict = spark.createDataFrame([(0, "A", "x", 0), (1, " A", "x ", 1)], columns)
    with pytest.raises(PySparkException, match="conflicting labels"):
        stage1.run(conflict, str(tmp_path))
    repeated = spark.createDataFrame([(0, "A", "x", 0), (0, "B", "x", 1)], columns)
    with pytest.raises(ValueError, match="not a unique key"):
        stage1.run(repeated, str(tmp_path))

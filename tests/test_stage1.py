import random

import pytest
from pyspark.sql import functions as F

from prosemill import schema as S
from prosemill.operators import columns as C
from prosemill.operators import duplicates as D
from prosemill.operators import stage1 as St
from prosemill.operators.ranking import ranked_by_id
from tests.conftest import rows

RAW = [(0, "A", "x", 1), (1, " A ", "x\n", 1), (2, None, "x", 0), (3, "", "x ", 0), (4, "B", None, 1)]
COLUMNS = "source_row_id long, title string, text string, label int"


def raw(spark, data=RAW):
    return spark.createDataFrame(data, COLUMNS)


def keyed(df):
    return df.withColumn(S.CONTENT_KEY, St.content_key(S.TITLE, S.TEXT))


def test_stage1_tables(spark):
    numbered = St.numbered_articles(St.stage1_rows(raw(spark)))
    master = St.master_rows(numbered)
    assert sorted(rows(master, S.ARTICLE_ID, S.ROW_ID)) == [(0, 0), (1, 2), (2, 4)]
    assert master.columns == S.MASTER_COLUMNS
    removed = St.removed_copies(numbered)
    assert removed.columns == [*S.STAGE1_COLUMNS, "removal_reason"]
    assert sorted(rows(removed, S.ROW_ID)) == [(1,), (3,)]
    assert rows(St.complete_cases(numbered), S.ROW_ID) == [(0,)]
    assert sorted(rows(St.incomplete_cases(numbered), S.ROW_ID)) == [(2,), (4,)]
    counts = St.stage_counts(numbered, {"original": 5, "master": 4})
    assert rows(counts) == [
        ("original", 5, 5, "OK"),
        ("duplicates", 2, None, None),
        ("master", 3, 4, "CHECK"),
        ("complete", 1, None, None),
        ("incomplete", 2, None, None),
    ]


def test_conflicting_labels_stop_the_run(spark):
    good = keyed(St.stage1_rows(raw(spark)))
    D.require_no_conflicts(D.article_groups(good))
    bad = keyed(St.stage1_rows(raw(spark, [*RAW, (5, "A", "x", 0)])))
    with pytest.raises(ValueError, match="1 articles have copies"):
        D.require_no_conflicts(D.article_groups(bad))


def test_content_key_keeps_fields_and_null_apart(spark):
    data = [("ab", "c"), ("a", "bc"), (None, "abc"), ("", "abc"), ("1:a", ""), ("", "1:a"), ("-", None)]
    df = spark.createDataFrame(data, "title string, text string")
    keys = rows(df.select(St.content_key("title", "text")))
    assert len(set(keys)) == len(data)


@pytest.mark.parametrize("partitions", [1, 4, 50])
@pytest.mark.parametrize("bits", [2, 5, 20])
def test_dense_rank_of_sparse_clustered_and_negative_ids(spark, partitions, bits):
    draw = random.Random(3)
    ids = {draw.randrange(-(2**16), 2**16) for _ in range(200)} | set(range(1000, 1300))
    ids |= {2**62 + i for i in range(5)} | {-(2**62)}
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(partitions)
    got = dict(rows(ranked_by_id(df, "id", "rank", bits=bits)))
    assert got == {value: position for position, value in enumerate(sorted(ids))}


def test_article_with_a_third_of_all_rows(spark):
    data = [(i, "hot" if i % 3 == 0 else f"t{i % 50}", "x", 1) for i in range(3000)]
    df = raw(spark, data).repartition(7)
    numbered = St.numbered_articles(St.stage1_rows(df))
    first = {}
    for i, title, _, _ in data:
        first.setdefault(title, i)
    expected = {row_id: position for position, row_id in enumerate(sorted(first.values()))}
    assert dict(rows(St.master_rows(numbered), S.ROW_ID, S.ARTICLE_ID)) == expected
    assert St.removed_copies(numbered).count() == 3000 - len(expected)


def test_duplicate_report_and_groups(spark):
    data = [(0, "A", "x", 1), (1, "A", "x", 0), (2, "A", "x", None), (3, "B", "y", 1), (4, "B", "y", 1), (5, "C", "z", 0)]
    groups = D.article_groups(keyed(raw(spark, data)))
    got = sorted(rows(groups, "first_row_id", "group_size", "number_of_labels", "label_variants"))
    assert got == [(0, 3, 2, 3), (3, 2, 1, 1), (5, 1, 1, 1)]
    assert [value for _, value in rows(D.duplicate_report(groups))] == [3.0, 50.0, 2.0, 3.0, 1.0, 3.0]
    single = D.article_groups(keyed(raw(spark, data[5:])))
    assert [value for _, value in rows(D.duplicate_report(single))] == [0.0, 0.0, 0.0, 0.0, 0.0, 1.0]


def test_repeated_rows_and_ids(spark):
    df = spark.createDataFrame(
        [(1, None), (1, None), (1, ""), (2, "a"), (None, "a"), (None, "a")], "i int, c string"
    )
    assert rows(D.repeated_rows(df)) == [(6, 2)]
    assert rows(D.repeated_ids(df, "i")) == [(6, 3)]


def test_label_checks(spark):
    texts = spark.createDataFrame([("0",), ("1.0",), (" 1 ",)], "label string")
    assert rows(C.with_integer_labels(texts)) == [(0,), (1,), (1,)]
    for wrong in (None, "fake", ""):
        with pytest.raises(Exception, match="missing or not numeric"):
            C.with_integer_labels(spark.createDataFrame([(wrong,)], "label string")).collect()
    numbers = spark.createDataFrame([(0,), (3,), (2,), (1,)], "label int")
    with pytest.raises(ValueError, match=r"\[2, 3\]"):
        C.require_label_domain(numbers)
    assert rows(C.label_domain(numbers)) == [(0,), (1,), (2,), (3,)]


def test_column_operators(spark):
    df = spark.createDataFrame([(1, "a")], "` Title ` int, `Unnamed: 0` string")
    named = C.normalized_names(df)
    assert named.columns == ["title", "unnamed: 0"]
    assert C.drop_serial_columns(df).columns == [" Title "]
    assert C.with_row_ids(named.withColumn("unnamed: 0", F.lit("5"))).dtypes[1] == (S.ROW_ID, "bigint")
    with pytest.raises(ValueError, match=r"\['label', 'text'\]"):
        C.require_columns(named)
    with pytest.raises(ValueError, match="not a unique key"):
        C.require_unique(spark.createDataFrame([(1,), (1,)], "a int"), "a")


def test_read_order_ids_over_many_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).repartitionByRange(6, "id").sortWithinPartitions("id").write.parquet(path)
    got = rows(C.with_row_ids(spark.read.parquet(path)))
    assert sorted(row_id for row_id, _ in got) == list(range(1000))
    assert all(row_id == value for row_id, value in got)


def test_first_copy_in_file_order(spark, tmp_path):
    """A serial column that falls: by row id the last row of the file would stay."""
    from prosemill.plans import stage1 as plan
    from prosemill.sources.csv import read_csv

    lines = ["A,x,1", "B,y,0", " A ,x,1", "C,z,0", "B,y,0"]
    (tmp_path / "a.csv").write_text(",title,text,label\n" + "".join(f"{9 - i},{line}\n" for i, line in enumerate(lines)))
    (tmp_path / "b.csv").write_text(",title,text,label\n" + "0,A,x,1\n")
    raw_ = read_csv(spark, str(tmp_path))
    by_file = plan.run(raw_, str(tmp_path / "out"), file_order=True, expected={"master": 3, "original": 7})
    assert sorted(rows(by_file.master, S.ARTICLE_ID, S.ROW_ID, S.TITLE)) == [(0, 9, "A"), (1, 8, "B"), (2, 6, "C")]
    assert sorted(rows(by_file.removed, S.ROW_ID)) == [(0,), (5,), (7,)]
    assert {r[0]: r[1:] for r in rows(by_file.counts)}["original"] == (6, 7, "CHECK")
    assert {r[0]: r[1:] for r in rows(by_file.counts)}["master"] == (3, 3, "OK")
    by_id = plan.run(raw_, str(tmp_path / "out2"))
    assert sorted(rows(by_id.master, S.ARTICLE_ID, S.ROW_ID)) == [(0, 0), (1, 5), (2, 6)]
    assert by_file.master.columns == by_id.master.columns


def test_conflicting_labels_stop_the_numbering(spark, tmp_path):
    from prosemill.plans import stage1 as plan

    df = raw(spark, [*RAW, (5, "A", "x", 0)])
    with pytest.raises(Exception, match="conflicting labels 0 and 1"):
        plan.run(df, str(tmp_path / "out"))
    assert not list((tmp_path / "out").glob("articles/**/*.parquet"))


def test_first_rows(spark):
    assert rows(C.first_rows(raw(spark).repartition(3), 2), S.ROW_ID) == [(0,), (1,)]

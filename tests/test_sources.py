import gzip
import json
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException, PySparkException

from prosemill.operators.columns import normalized_names, with_row_ids
from prosemill.sources import csv as Csv
from prosemill.sources import tables as Tb
from tests.conftest import rows

RAW = (
    ',title,text,label\n'
    '0,"A ""quoted"" title","line one\nline two, with comma",1\n'
    '1,NA,  padded  ,0\n'
    '2,,"x\\",1\n'
)


def parts(path, suffix):
    return sorted(Path(path).glob(f"part-*{suffix}"))


@pytest.mark.parametrize("compressed", [False, True])
def test_headed_multi_line_csv(spark, tmp_path, compressed):
    path = tmp_path / ("raw.csv.gz" if compressed else "raw.csv")
    path.write_bytes(gzip.compress(RAW.encode()) if compressed else RAW.encode())
    df = Csv.read_csv(spark, str(path))
    assert df.columns == ["unnamed: 0", "title", "text", "label"]
    assert rows(with_row_ids(normalized_names(df))) == [
        (0, 'A "quoted" title', "line one\nline two, with comma", "1"),
        (1, None, "  padded  ", "0"),
        (2, None, "x\\", "1"),
    ]
    kept = Csv.read_csv(spark, str(path), na_values=None)
    assert rows(kept, "title")[1] == ("NA",)


def test_row_ids_of_a_csv_without_serial_column(spark, tmp_path):
    for name, start in (("a.csv", 0), ("b.csv", 50)):
        lines = "\n".join(f"t{i},0" for i in range(start, start + 50))
        (tmp_path / name).write_text("title,label\n" + lines + "\n")
    df = with_row_ids(Csv.read_csv(spark, str(tmp_path)))
    assert sorted(rows(df, "source_row_id", "title")) == sorted((i, f"t{i}") for i in range(100))


def test_gzip_round_trip(spark, tmp_path):
    data = [(0, ' a "b"\n', 1), (1, None, 0), (2, "", 0)]
    df = spark.createDataFrame(data, "i long, c string, label int").coalesce(1)
    Csv.write_gzip_csv(df, str(tmp_path / "out"))
    text = gzip.decompress(parts(tmp_path / "out", ".csv.gz")[0].read_bytes()).decode()
    assert text == 'i,c,label\n0," a ""b""\n",1\n1,,0\n2,,0\n'
    back = Csv.read_csv(spark, str(tmp_path / "out"))
    assert sorted(rows(back)) == [("0", ' a "b"\n', "1"), ("1", None, "0"), ("2", None, "0")]


def test_spreadsheet_csv_starts_with_a_byte_order_mark(spark, tmp_path):
    df = spark.createDataFrame([("é", 1)], "c string, n int").coalesce(1)
    Csv.write_spreadsheet_csv(df, str(tmp_path / "out"))
    assert parts(tmp_path / "out", ".csv")[0].read_bytes() == "c,n\né,1\n".encode("utf-8-sig")
    assert Csv.read_csv(spark, str(tmp_path / "out")).columns == ["c", "n"]


def test_features_and_split_tables_by_split(spark, tmp_path):
    data = [
        (setting, "tfidf", split, i, 0, [i], [1.0])
        for setting in ("title", "body")
        for i, split in ((3, "train"), (1, "train"), (2, "val"))
    ]
    columns = "setting string, representation string, split string, article_id long, label int, indices array<int>, weights array<double>"
    Tb.write_features(spark.createDataFrame(data, columns), str(tmp_path / "f"))
    tables = Tb.read_features(spark, str(tmp_path / "f"), "title", "tfidf")
    assert [rows(t, "article_id") for t in tables.values()] == [[(1,), (3,)], [(2,)], []]
    plan = tables["train"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(setting" in plan
    split = spark.createDataFrame([(2, 0, "val"), (5, 0, "train"), (4, 1, "train")], "article_id long, label int, split string")
    Tb.write_table(split, str(tmp_path / "s"))
    assert rows(Tb.read_split_tables(spark, str(tmp_path / "s"))["train"], "article_id") == [(4,), (5,)]


def test_vocabulary_json_in_column_order(spark, tmp_path):
    vocab = spark.createDataFrame([("t", "r", 1, "b"), ("t", "r", 0, "a")], "setting string, representation string, term_idx int, term string")
    Tb.write_vocabulary_json(vocab, str(tmp_path / "v"))
    written = json.loads(parts(tmp_path / "v", ".json")[0].read_text())
    assert written == {"setting": "t", "representation": "r", "terms": ["a", "b"]}


def test_missing_input_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        Csv.read_csv(spark, str(tmp_path / "none.csv"))


def test_surplus_cells_are_never_lost(spark, tmp_path):
    good = 'title,text,label\nt1,"a,b\nc",0\nt2,short\n'
    (tmp_path / "a.csv").write_text(good)
    bad = 'title,text,label\nx,"y",0,lost1,lost2\nu,"v ""w"",\nz",1,more\nt3,ok,1\n'
    (tmp_path / "b.csv").write_text(bad)
    rows_, rejected = Csv.read_csv_apart(spark, str(tmp_path))
    assert sorted(rows(rows_)) == [("t1", "a,b\nc", "0"), ("t2", "short", None), ("t3", "ok", "1")]
    found = sorted(rows(rejected))
    assert [f.rsplit("/", 1)[1] for f, _ in found] == ["b.csv", "b.csv"]
    assert sorted(r.strip() for _, r in found) == ['u,"v ""w"",\nz",1,more', 'x,"y",0,lost1,lost2']
    df = Csv.read_csv(spark, str(tmp_path))
    for action in (df.count, df.collect, df.select("label").collect):
        with pytest.raises(PySparkException, match="more cells than its header"):
            action()
    assert sorted(rows(Csv.read_csv(spark, str(tmp_path / "a.csv")), "title")) == [("t1",), ("t2",)]


def test_files_are_read_by_their_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("title,text,label\nt1,b1,0\n")
    (tmp_path / "b.csv").write_text("text,title,label\nb2,t2,1\n")
    (tmp_path / "c.csv").write_text(",text\n7,b3\n")
    (tmp_path / "d.csv").write_text("")
    df = Csv.read_csv_by_header(spark, str(tmp_path))
    assert df.columns == ["title", "text", "label", "unnamed: 0"]
    assert sorted(rows(df), key=str) == [("t1", "b1", "0", None), ("t2", "b2", "1", None), (None, "b3", None, "7")]
    with pytest.raises(Exception, match="header does not conform"):
        Csv.read_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]).collect()
    (tmp_path / "e.csv").write_text("text,text\n1,2\n")
    with pytest.raises(ValueError, match="Duplicate column names"):
        Csv.read_csv(spark, str(tmp_path / "e.csv"))

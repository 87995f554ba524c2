"""Round trips through the readers and writers, and the column operators, over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosemill import schema as S
from prosemill.catalog import features as KF
from prosemill.catalog.articles import documents, labelled, table
from prosemill.catalog.sql import ARTICLES
from prosemill.operators import columns as C
from prosemill.operators import features as Fe
from prosemill.operators import quality as Q
from prosemill.operators import sampling as Sa
from prosemill.operators import stage1 as St
from prosemill.plans import stage1 as St1
from prosemill.session import shared_folder
from prosemill.sources import csv as Csv
from prosemill.sources import tables as Ta

# The serial numbers of the reversed table fall from here.
FALLING_FROM = 1_000_000_000_000


def folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/prosemill/{name}-{uuid.uuid4().hex}"


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles out as gzip CSV and in again; a blank cell comes back as null."""
    path = folder(spark, "gzip_csv")
    Csv.write_gzip_csv(documents(spark, sf_dir), path)
    return Csv.read_csv(spark, path).withColumn(S.ROW_ID, F.col(S.ROW_ID).cast("long"))


def spreadsheet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles out with a byte order mark and in again, blank cells kept as they are."""
    path = folder(spark, "spreadsheet_csv")
    Csv.write_spreadsheet_csv(documents(spark, sf_dir), path)
    found = Csv.read_csv(spark, path, na_values=None)
    return found.select(F.col(S.ROW_ID).cast("long").alias(S.ROW_ID), *[F.coalesce(c, F.lit("")).alias(c) for c in (S.TITLE, S.TEXT)])


def summary_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class sizes out as one CSV file and in again."""
    path = folder(spark, "summary_csv")
    joined = labelled(documents(spark, sf_dir).select(S.ROW_ID), sf_dir)
    Csv.write_summary_csv(Q.label_distribution(joined).select(S.LABEL, F.col("record_count").alias("articles")), path)
    return Csv.read_csv(spark, path).select(F.col(S.LABEL).cast("int").alias(S.LABEL), F.col("articles").cast("long").alias("articles"))


def report_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested counts out as a JSON report and in again."""
    path = folder(spark, "report_json")
    docs = labelled(documents(spark, sf_dir), sf_dir, "left")
    counts = docs.agg(
        F.count(F.lit(1)).alias("rows"), F.count(S.LABEL).alias("labelled"),
        F.count_if(F.col(S.TEXT) == "").alias("blank_texts"),
    )
    Ta.write_report(counts.select("rows", F.struct("labelled", "blank_texts").alias("found")), path)
    found = spark.read.schema("rows bigint, found struct<labelled:bigint,blank_texts:bigint>").json(path)
    return found.select("rows", "found.labelled", "found.blank_texts")


def split_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split out as a table, and in again part by part."""
    path = folder(spark, "split_table")
    Ta.write_table(KF.split(spark, sf_dir).withColumnRenamed(S.ROW_ID, S.ARTICLE_ID), path)
    parts = Ta.read_split_tables(spark, path)
    return parts["train"].unionByName(parts["val"]).unionByName(parts["test"])


def features_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features out by setting, representation and split; those of the titles in again."""
    path = folder(spark, "feature_tables")
    rows = KF.feature_rows(spark, sf_dir, [KF.UNIGRAM])
    Ta.write_features(rows.withColumnRenamed(S.ROW_ID, S.ARTICLE_ID), path)
    parts = Ta.read_features(spark, path, "title", KF.UNIGRAM.name)
    found = parts["train"].unionByName(parts["val"]).unionByName(parts["test"])
    return Fe.long_features(found).withColumn("weight", F.round("weight", 6))


def vocabulary_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms in column order out as JSON, and in again with their positions."""
    path = folder(spark, "vocabulary_json")
    Ta.write_vocabulary_json(KF.fitted(spark, sf_dir, [KF.UNIGRAM])[2], path)
    lists = spark.read.schema("setting string, representation string, terms array<string>").json(path)
    return lists.select("setting", "representation", F.posexplode("terms").alias("term_idx", "term"))


def column_operators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table with untidy names, a serial column and leftovers of an earlier run, put in order."""
    docs = documents(spark, sf_dir)
    untidy = labelled(docs, sf_dir).select(
        F.col(S.ROW_ID).alias("Unnamed: 0"), (F.col(S.ROW_ID) * 2).alias("UNNAMED: 7"),
        F.col(S.TEXT).alias(" TEXT"), F.col(S.TITLE).alias("Title "), F.length(S.TEXT).cast("long").alias("Extra"),
        F.col(S.LABEL).alias("LABEL"), F.lit("old").alias(S.GENERATED_COLUMNS[0]),
    )
    named = C.reject_duplicate_names(C.require_columns(C.normalized_names(untidy)))
    numbered = C.drop_serial_columns(C.with_row_ids(named))
    return C.preferred_order(C.drop_generated_columns(numbered))


def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles written without quotes: each comma in one makes a surplus cell. No title is cut."""
    path = folder(spark, "unquoted_csv")
    plain = F.regexp_replace(S.TITLE, '["\\r\\x00]', "").alias(S.TITLE)
    # one column to the writer, whose name and values hold the commas
    cells = documents(spark, sf_dir).select(S.ROW_ID, plain).select(F.concat_ws(",", S.ROW_ID, S.TITLE).alias(f"{S.ROW_ID},{S.TITLE}"))
    cells.write.options(header=True, sep="\x01", **Csv._VERBATIM).csv(path)
    found, rejected = Csv.read_csv_apart(spark, path, na_values=None)
    kept = found.select(S.ROW_ID, F.coalesce(S.TITLE, F.lit("")).alias(S.TITLE), F.lit(False).alias("rejected"))
    apart = rejected.select(
        F.substring_index("record", ",", 1).alias(S.ROW_ID),
        F.regexp_replace("record", "^[^,]*,|[\\r\\n]+$", "").alias(S.TITLE), F.lit(True).alias("rejected"),
    )
    return kept.unionByName(apart).withColumn(S.ROW_ID, F.col(S.ROW_ID).cast("long"))


def csv_by_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English and other documents in files with other headers, read as one table by name."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.substring_index("text", "\n", 1).alias(S.TITLE), "lang", "n_chars")
    paths = [folder(spark, "english_csv"), folder(spark, "other_csv")]
    Csv.write_gzip_csv(docs.where("lang = 'en'").select("doc_id", S.TITLE, "n_chars"), paths[0])
    Csv.write_gzip_csv(docs.where("lang <> 'en'").select("lang", S.TITLE, "doc_id"), paths[1])
    found = Csv.read_csv_by_header(spark, paths, na_values=None)
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), S.TITLE, "lang", F.col("n_chars").cast("long").alias("n_chars"))


def first_copies_in_file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles in files by rising id, with a serial column that falls: the first in the files stays."""
    path = folder(spark, "falling_csv")
    docs = documents(spark, sf_dir).repartitionByRange(S.ROW_ID).sortWithinPartitions(S.ROW_ID)
    falling = docs.select((F.lit(FALLING_FROM) - F.col(S.ROW_ID)).alias("Unnamed: 0"), S.TITLE, S.TEXT, F.lit(0).alias(S.LABEL))
    Csv.write_gzip_csv(falling, path)
    raw = St1.prepared(Csv.read_csv(spark, path, na_values=None), file_order=True)
    numbered = St.numbered_articles(St.stage1_rows(raw, S.READ_POSITION), order=S.READ_POSITION)
    return St.master_rows(numbered).select(S.ARTICLE_ID, S.ROW_ID, S.TITLE)


def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first articles as they are, beside the overview of their columns."""
    return C.first_rows(documents(spark, sf_dir), 5)


def split_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stratified split over a column of many values."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias(S.ROW_ID), F.col("source").alias(S.LABEL))
    return Sa.sample_and_split(docs, id_col=S.ROW_ID)


QUERIES = {
    "csv_round_trip": csv_round_trip,
    "spreadsheet_round_trip": spreadsheet_round_trip,
    "summary_round_trip": summary_round_trip,
    "report_round_trip": report_round_trip,
    "split_round_trip": split_round_trip,
    "features_round_trip": features_round_trip,
    "vocabulary_round_trip": vocabulary_round_trip,
    "column_operators": column_operators,
    "split_by_source": split_by_source,
    "csv_rejects": csv_rejects,
    "csv_by_header": csv_by_header,
    "first_copies_in_file_order": first_copies_in_file_order,
    "first_rows": first_rows,
}

_BY_SOURCE = KF._split_sql(None).replace("quality", "source").replace("FROM labels", "FROM documents")

ORACLE = {
    "csv_round_trip": f"WITH {ARTICLES} SELECT source_row_id, nullif(title, '') AS title, nullif(text, '') AS text FROM docs",
    "spreadsheet_round_trip": f"WITH {ARTICLES} SELECT * FROM docs",
    "summary_round_trip": f"WITH {ARTICLES} SELECT label, count(*) AS articles FROM raw GROUP BY label",
    "report_round_trip": f"""WITH {ARTICLES}
SELECT count(*) AS rows, count(label) AS labelled, count(*) FILTER (text = '') AS blank_texts FROM raw_all""",
    "split_round_trip": f"WITH {KF._split_sql(None)} SELECT source_row_id AS article_id, label, split FROM split",
    "features_round_trip": f"""WITH {KF._weights_sql(KF.UNIGRAM)}
SELECT setting, representation, split, source_row_id AS article_id, term_idx, round(weight, 6) AS weight
FROM weights WHERE setting = 'title'""",
    "vocabulary_round_trip": f"WITH {KF._vocabulary_sql(KF.UNIGRAM)} SELECT setting, representation, term_idx, term FROM vocab",
    "column_operators": f"""WITH {ARTICLES}
SELECT source_row_id, title, text, label, length(text) AS extra FROM raw""",
    "split_by_source": f"WITH {_BY_SOURCE} SELECT * FROM split",
    "csv_rejects": f"""WITH {ARTICLES}
SELECT source_row_id, regexp_replace(title, '["\\r\\x00]', '', 'g') AS title, contains(title, ',') AS rejected FROM docs""",
    "csv_by_header": """SELECT doc_id, nullif(split_part(text, chr(10), 1), '') AS title,
       CASE WHEN lang <> 'en' THEN lang END AS lang, CASE WHEN lang = 'en' THEN n_chars END AS n_chars
FROM documents WHERE lang IS NOT NULL""",
    "first_copies_in_file_order": f"""WITH {ARTICLES},
firsts AS (SELECT *, row_number() OVER (PARTITION BY title, text ORDER BY source_row_id) AS copy FROM docs)
SELECT row_number() OVER (ORDER BY source_row_id) - 1 AS article_id, {FALLING_FROM} - source_row_id AS source_row_id, title
FROM firsts WHERE copy = 1""",
    "first_rows": f"WITH {ARTICLES} SELECT * FROM docs ORDER BY source_row_id LIMIT 5",
}

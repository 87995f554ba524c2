"""Stage-1 queries: rows, duplicates, ids, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosemill import schema as S
from prosemill.catalog.articles import documents, labelled, labels, table
from prosemill.catalog.sql import ARTICLES, STAGE1
from prosemill.operators import columns as C
from prosemill.operators import stage1 as St


def stage1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return St.stage1_rows(labelled(documents(spark, sf_dir), sf_dir))


def keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row id and content key of the labelled documents; the texts are not joined."""
    keys = documents(spark, sf_dir).select(
        S.ROW_ID, St.content_key(S.TITLE, S.TEXT).alias(S.CONTENT_KEY)
    )
    return keys.join(labels(spark, sf_dir), S.ROW_ID)


def numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return St.numbered_articles(stage1(spark, sf_dir), keyed=keyed(spark, sf_dir))


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage-1 flags and content key of the labelled documents, worked out where the texts lie."""
    rows = documents(spark, sf_dir).withColumn(S.CONTENT_KEY, St.content_key(S.TITLE, S.TEXT))
    narrow = St.stage1_flags(rows).select(S.ROW_ID, S.CONTENT_KEY, "complete_case")
    return narrow.join(labels(spark, sf_dir), S.ROW_ID)


def narrow_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flagged(spark, sf_dir)
    return St.numbered_articles(rows.drop(S.CONTENT_KEY), keyed=rows.select(S.ROW_ID, S.CONTENT_KEY))


def removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later copies: found on ids and keys, and only their texts are fetched."""
    ids = narrow_numbered(spark, sf_dir).where(F.col(S.ARTICLE_ID).isNull()).select(S.ROW_ID, S.LABEL)
    texts = St.stage1_rows(documents(spark, sf_dir).join(ids, S.ROW_ID))
    return St.removed_copies(texts.withColumn(S.ARTICLE_ID, F.lit(None).cast("long")))


def counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The known counts at one scale; other scales show CHECK.
    expected = {
        "original": 399,
        "duplicates": 14,
        "master": 385,
        "complete": 350,
        "incomplete": 35,
    }
    return St.stage_counts(narrow_numbered(spark, sf_dir), expected)


def generated_row_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.with_row_ids(table(spark, sf_dir, "documents").select("doc_id", "n_chars"))


def column_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    overview = C.column_overview(labelled(documents(spark, sf_dir), sf_dir, "left"))
    return overview.withColumn("position", F.col("position").cast("long"))


QUERIES = {
    "articles_stage1": stage1,
    "dedup_master": lambda spark, sf: St.master_rows(numbered(spark, sf)),
    "removed_duplicates": removed,
    "complete_cases": lambda spark, sf: St.complete_cases(numbered(spark, sf)),
    "incomplete_cases": lambda spark, sf: St.incomplete_cases(numbered(spark, sf)),
    "stage_counts": counted,
    "generated_row_ids": generated_row_ids,
    "label_domain": lambda spark, sf: C.label_domain(
        C.require_label_domain(C.with_integer_labels(labels(spark, sf)))
    ),
    "column_overview": column_overview,
}

ORACLE = {
    "articles_stage1": f"WITH {STAGE1} SELECT * FROM stage1",
    "dedup_master": f"WITH {STAGE1} SELECT * FROM master",
    "removed_duplicates": f"""WITH {STAGE1}
SELECT * EXCLUDE (copy), 'exact_duplicate_title_text' AS removal_reason
FROM firsts WHERE copy > 1""",
    "complete_cases": f"WITH {STAGE1} SELECT * FROM master WHERE complete_case",
    "incomplete_cases": f"WITH {STAGE1} SELECT * FROM master WHERE NOT complete_case",
    "stage_counts": f"""WITH {STAGE1},
counts AS (
  SELECT 'original' AS stage, count(*) AS actual, 399 AS expected FROM stage1
  UNION ALL SELECT 'duplicates', count(*), 14 FROM firsts WHERE copy > 1
  UNION ALL SELECT 'master', count(*), 385 FROM master
  UNION ALL SELECT 'complete', count(*), 350 FROM master WHERE complete_case
  UNION ALL SELECT 'incomplete', count(*), 35 FROM master WHERE NOT complete_case
)
SELECT *, CASE WHEN actual = expected THEN 'OK' ELSE 'CHECK' END AS status FROM counts""",
    "generated_row_ids": """SELECT row_number() OVER (ORDER BY doc_id) - 1 AS source_row_id,
       doc_id, n_chars FROM documents""",
    "label_domain": "SELECT DISTINCT quality AS label FROM labels",
    "column_overview": f"""WITH {ARTICLES},
counts AS (
  SELECT count(*) AS n, count(source_row_id) AS c0, count(title) AS c1, count(text) AS c2,
         count(label) AS c3 FROM raw_all
)
SELECT 0 AS position, 'source_row_id' AS column_name, 'bigint' AS data_type,
       c0 AS filled, n - c0 AS missing FROM counts
UNION ALL SELECT 1, 'title', 'string', c1, n - c1 FROM counts
UNION ALL SELECT 2, 'text', 'string', c2, n - c2 FROM counts
UNION ALL SELECT 3, 'label', 'int', c3, n - c3 FROM counts""",
}

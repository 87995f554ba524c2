"""Profile queries: classes, missing values, lengths, duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosemill import schema as S
from prosemill.catalog.articles import documents, labelled, labels, table
from prosemill.catalog.sql import ARTICLES, half_even, measures, words
from prosemill.operators import duplicates as D
from prosemill.operators import lengths as L
from prosemill.operators import quality as Q
from prosemill.operators.stage1 import content_key
from prosemill.session import written


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in names})


def measured(spark: SparkSession, sf_dir: str, how: str = "inner") -> DataFrame:
    return labelled(L.with_lengths(documents(spark, sf_dir)), sf_dir, how)


def length_summary_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts by label over the first copy of every article."""
    docs = documents(spark, sf_dir).withColumn(S.CONTENT_KEY, content_key(S.TITLE, S.TEXT))
    firsts = L.first_copy_lengths(labelled(L.with_lengths(docs), sf_dir))
    return L.length_summary_by_label(L.histogram(firsts, L.WORD_COUNTS, by=[S.LABEL]))


def groups(spark: SparkSession, sf_dir: str, how: str = "left") -> DataFrame:
    docs = documents(spark, sf_dir).select(
        S.ROW_ID, content_key(S.TITLE, S.TEXT).alias(S.CONTENT_KEY)
    )
    return D.article_groups(labelled(docs, sf_dir, how))


def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.duplicate_groups(groups(spark, sf_dir)).drop(S.CONTENT_KEY)


def label_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal titles under both labels: titles are short enough to repeat across classes."""
    titles = labelled(documents(spark, sf_dir).select(S.ROW_ID, S.TITLE), sf_dir)
    return D.label_conflicts(D.article_groups(titles, S.TITLE))


def full_row_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal rows with the serial column, and without it."""
    docs = table(spark, sf_dir, "documents")
    rest = ["text", "lang", "source", "n_chars"]
    return D.repeated_rows_by_subset(docs, {"all columns": docs.columns, "without doc_id": rest})


def distinct_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct label and title pairs."""
    titles = labelled(documents(spark, sf_dir).select(S.ROW_ID, S.TITLE), sf_dir)
    return titles.select(S.LABEL, S.TITLE).dropDuplicates([S.LABEL, S.TITLE])


def article_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole articles under two labels; the label is whether the id is odd, so copies differ."""
    keys = documents(spark, sf_dir).select(
        S.ROW_ID, content_key(S.TITLE, S.TEXT).alias(S.CONTENT_KEY),
        F.pmod(S.ROW_ID, F.lit(2)).cast("int").alias(S.LABEL),
    )
    return D.label_conflicts(D.article_groups(keys)).drop(S.CONTENT_KEY)


def distinct_whole_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct articles (title and text) of each label, by their keys."""
    keys = documents(spark, sf_dir).select(S.ROW_ID, content_key(S.TITLE, S.TEXT).alias(S.CONTENT_KEY))
    distinct = labelled(keys, sf_dir).select(S.LABEL, S.CONTENT_KEY).distinct()
    return distinct.groupBy(S.LABEL).agg(F.count(F.lit(1)).alias("articles"))


def with_null_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing values where a document of one line has a null body, and an empty rest is blank."""
    docs = documents(spark, sf_dir, one_line_body=None)
    return Q.missing_summary(labelled(Q.with_gaps(docs), sf_dir, "left"))


def boxplot_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    hist = L.histogram(measured(spark, sf_dir), L.WORD_COUNTS, by=[S.LABEL])
    return rounded(
        L.boxplot_stats(hist), "upper_limit", "whisker_low", "q25", "median", "q75", "whisker_high"
    )


def capped_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = measured(spark, sf_dir).select(S.ROW_ID, S.LABEL, *L.WORD_COUNTS)
    capped = L.capped(written(counts, "word_counts"), L.WORD_COUNTS)
    return rounded(capped, *[f"{name}_capped" for name in L.WORD_COUNTS])


QUERIES = {
    "length_summary_unique_articles": length_summary_unique,
    "label_distribution": lambda spark, sf: rounded(
        Q.label_distribution(labels(spark, sf)), "percentage"
    ),
    "label_counts_with_null": lambda spark, sf: rounded(
        Q.label_distribution(
            labelled(documents(spark, sf).select(S.ROW_ID), sf, "left"), keep_null=True
        ),
        "percentage",
    ),
    "missing_summary": lambda spark, sf: Q.missing_summary(
        labelled(Q.with_gaps(documents(spark, sf)), sf, "left")
    ),
    "data_quality_summary": lambda spark, sf: Q.data_quality_summary(
        labelled(Q.with_quality_columns(documents(spark, sf)), sf, "left")
    ),
    "length_describe": lambda spark, sf: rounded(
        L.describe(L.histogram(L.with_lengths(documents(spark, sf)), L.LENGTHS)),
        "mean", "std", "q25", "median", "q75",
    ),
    "mean_length_by_label": lambda spark, sf: rounded(
        L.mean_by_label(L.histogram(measured(spark, sf), L.LENGTHS, by=[S.LABEL])), "mean"
    ),
    "length_summary_by_label": lambda spark, sf: L.length_summary_by_label(
        L.histogram(measured(spark, sf), L.WORD_COUNTS, by=[S.LABEL])
    ),
    "word_count_limits": lambda spark, sf: rounded(
        L.upper_limits(L.histogram(L.with_lengths(documents(spark, sf)), L.WORD_COUNTS)),
        "upper_limit",
    ),
    "boxplot_stats_by_label": boxplot_stats,
    "capped_word_counts": capped_word_counts,
    "duplicate_groups": duplicate_groups,
    "duplicate_report": lambda spark, sf: D.duplicate_report(groups(spark, sf)),
    "label_conflicts": label_conflicts,
    "article_label_conflicts": article_conflicts,
    "distinct_articles_by_label": distinct_whole_articles,
    "missing_summary_null_bodies": with_null_bodies,
    "full_row_duplicates": full_row_duplicates,
    "distinct_titles_by_label": distinct_articles,
    "duplicate_ids": lambda spark, sf: D.repeated_ids(
        table(spark, sf, "conversations").select("conv_id"), "conv_id"
    ),
}

_LENGTHS = f"""
measured AS (
  SELECT source_row_id, label, title, text, length(title) AS title_length,
         length(text) AS text_length, {words('title')} AS title_word_count,
         {words('text')} AS text_word_count
  FROM %s
),
lens AS (
  UNPIVOT (SELECT label, title_length, text_length, title_word_count, text_word_count
           FROM measured)
  ON title_length, text_length, title_word_count, text_word_count
  INTO NAME measure VALUE value
)"""
_MEASURED = _LENGTHS % "raw"
_MEASURED_ALL = _LENGTHS % "raw_all"


def _summary(source: str) -> str:
    return f"""SELECT label, count(*) AS record_count,
       {half_even('avg(title_word_count)', 2)} AS mean_title_words,
       {half_even('quantile_cont(title_word_count, 0.5)', 2)} AS median_title_words,
       {half_even('avg(text_word_count)', 2)} AS mean_text_words,
       {half_even('quantile_cont(text_word_count, 0.5)', 2)} AS median_text_words
FROM {source} GROUP BY label"""


_GROUPS = """
article_groups AS (
  SELECT title, text, count(*) AS group_size, count(DISTINCT label) AS number_of_labels,
         count(DISTINCT coalesce(label, -1)) AS label_variants,
         min(source_row_id) AS first_row_id
  FROM raw_all GROUP BY title, text
)"""

ORACLE = {
    "length_summary_unique_articles": f"""WITH {ARTICLES}, {_MEASURED},
firsts AS (
  SELECT *, row_number() OVER (PARTITION BY title, text ORDER BY source_row_id) AS copy
  FROM measured
)
{_summary('(SELECT * FROM firsts WHERE copy = 1)')}""",
    "label_distribution": """SELECT quality AS label, count(*) AS record_count,
       round(count(*) / sum(count(*)) OVER () * 100, 6) AS percentage
FROM labels WHERE quality IS NOT NULL GROUP BY quality""",
    "label_counts_with_null": f"""WITH {ARTICLES}
SELECT label, count(*) AS record_count,
       round(count(*) / sum(count(*)) OVER () * 100, 6) AS percentage
FROM raw_all GROUP BY label""",
    "missing_summary": f"""WITH {ARTICLES},
counts AS (
  SELECT count(*) FILTER (title IS NULL) AS a, count(*) FILTER (text IS NULL) AS b,
         count(*) FILTER (label IS NULL) AS c,
         count(*) FILTER (title IS NULL OR text IS NULL) AS d,
         count(*) FILTER (title IS NULL AND text IS NULL) AS e,
         count(*) FILTER (coalesce(title, '') = '') AS f,
         count(*) FILTER (coalesce(text, '') = '') AS g,
         count(*) FILTER (coalesce(title, '') = '' OR coalesce(text, '') = '') AS h,
         count(*) FILTER (coalesce(title, '') = '' AND coalesce(text, '') = '') AS i
  FROM raw_all
)
{measures({
    'Missing titles': 'a', 'Missing body texts': 'b', 'Missing labels': 'c',
    'Rows missing title or body': 'd', 'Rows missing both title and body': 'e',
    'Blank titles': 'f', 'Blank body texts': 'g', 'Rows with a blank title or blank body': 'h',
    'Rows with both title and body blank': 'i', 'Body texts blank but not null': 'g - b',
}, 'counts')}""",
    "data_quality_summary": f"""WITH {ARTICLES},
counts AS (
  SELECT count(*) AS n, count(*) FILTER (title IS NULL) AS a,
         count(*) FILTER (text IS NULL) AS b, count(*) FILTER (label IS NULL) AS c,
         count(*) FILTER (title IS NULL OR text IS NULL) AS d,
         count(*) FILTER (title IS NULL AND text IS NULL) AS e,
         count(*) FILTER (title = '') AS f, count(*) FILTER (text = '') AS g,
         count(*) - (SELECT count(*) FROM (SELECT DISTINCT title, text, label FROM raw_all)) AS h,
         count(*) - (SELECT count(*) FROM (SELECT DISTINCT title, text FROM raw_all)) AS i
  FROM raw_all
)
{measures({
    'Total records': 'n', 'Total usable columns': '3', 'Missing titles': 'a',
    'Missing body texts': 'b', 'Missing labels': 'c', 'Rows missing title or body': 'd',
    'Rows missing both title and body': 'e', 'Blank titles after stripping whitespace': 'f',
    'Blank body texts after stripping whitespace': 'g',
    'Duplicate title-text-label records': 'h',
    'Duplicate title-text articles ignoring label': 'i',
}, 'counts')}""",
    "length_describe": f"""WITH {ARTICLES}, {_MEASURED_ALL}
SELECT measure, count(*) AS count, round(avg(value), 6) AS mean,
       round(stddev_samp(value), 6) AS std, min(value) AS min,
       round(quantile_cont(value, 0.25), 6) AS q25,
       round(quantile_cont(value, 0.5), 6) AS median,
       round(quantile_cont(value, 0.75), 6) AS q75, max(value) AS max
FROM lens GROUP BY measure""",
    "mean_length_by_label": f"""WITH {ARTICLES}, {_MEASURED}
SELECT measure, label, round(avg(value), 6) AS mean FROM lens GROUP BY measure, label""",
    "length_summary_by_label": f"WITH {ARTICLES}, {_MEASURED} {_summary('measured')}",
    "word_count_limits": f"""WITH {ARTICLES}, {_MEASURED_ALL}
SELECT measure, round(quantile_cont(value, 0.99), 6) AS upper_limit FROM lens
WHERE measure LIKE '%word_count' GROUP BY measure""",
    "boxplot_stats_by_label": f"""WITH {ARTICLES}, {_MEASURED},
limits AS (
  SELECT measure, quantile_cont(value, 0.99) AS upper_limit FROM lens
  WHERE measure LIKE '%word_count' GROUP BY measure
),
vals AS (
  SELECT measure, label, upper_limit, least(value, upper_limit) AS value
  FROM lens JOIN limits USING (measure)
),
boxes AS (
  SELECT measure, label, any_value(upper_limit) AS upper_limit,
         quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS median,
         quantile_cont(value, 0.75) AS q75
  FROM vals GROUP BY measure, label
),
ends AS (
  SELECT v.measure, v.label,
         min(value) FILTER (value >= q25 - 1.5 * (q75 - q25)) AS low,
         max(value) FILTER (value <= q75 + 1.5 * (q75 - q25)) AS high
  FROM vals v JOIN boxes b ON v.measure = b.measure AND v.label = b.label
  GROUP BY v.measure, v.label
)
SELECT measure, label, round(upper_limit, 6) AS upper_limit,
       round(least(low, q25), 6) AS whisker_low, round(q25, 6) AS q25,
       round(median, 6) AS median, round(q75, 6) AS q75,
       round(greatest(high, q75), 6) AS whisker_high
FROM boxes JOIN ends USING (measure, label)""",
    "capped_word_counts": f"""WITH {ARTICLES}, {_MEASURED}
SELECT source_row_id, label, title_word_count, text_word_count,
       round(least(title_word_count,
         (SELECT quantile_cont(title_word_count, 0.99) FROM measured)), 6)
         AS title_word_count_capped,
       round(least(text_word_count,
         (SELECT quantile_cont(text_word_count, 0.99) FROM measured)), 6)
         AS text_word_count_capped
FROM measured""",
    "duplicate_groups": f"""WITH {ARTICLES}, {_GROUPS}
SELECT group_size, number_of_labels, label_variants, first_row_id
FROM article_groups WHERE group_size > 1""",
    "duplicate_report": f"""WITH {ARTICLES}, {_GROUPS},
counts AS (
  SELECT sum(group_size) AS n, count(*) AS articles,
         count(*) FILTER (group_size > 1) AS repeated,
         coalesce(max(group_size) FILTER (group_size > 1), 0) AS largest,
         count(*) FILTER (group_size > 1 AND number_of_labels > 1) AS conflicts
  FROM article_groups
)
{measures({
    'Duplicate records beyond first copy': 'n - articles',
    'Duplicate percentage': half_even('(n - articles) / n * 100', 2),
    'Number of duplicate article groups': 'repeated',
    'Largest duplicate group size': 'largest',
    'Duplicate groups with conflicting labels': 'conflicts',
    'Unique articles after exact deduplication': 'articles',
}, 'counts')}""",
    "label_conflicts": f"""WITH {ARTICLES}
SELECT title, count(*) AS group_size, count(DISTINCT label) AS number_of_labels,
       count(DISTINCT coalesce(label, -1)) AS label_variants, min(source_row_id) AS first_row_id
FROM raw GROUP BY title HAVING count(DISTINCT label) > 1""",
    "full_row_duplicates": """
SELECT 'all columns' AS subset, (SELECT count(*) FROM documents) AS rows,
       (SELECT count(*) FROM documents)
       - (SELECT count(*) FROM (SELECT DISTINCT * FROM documents)) AS duplicated_rows
UNION ALL
SELECT 'without doc_id', (SELECT count(*) FROM documents),
       (SELECT count(*) FROM documents)
       - (SELECT count(*) FROM (SELECT DISTINCT text, lang, source, n_chars FROM documents))""",
    "distinct_titles_by_label": f"WITH {ARTICLES} SELECT DISTINCT label, title FROM raw",
    "duplicate_ids": """SELECT count(*) AS rows,
       count(*) - count(DISTINCT conv_id) AS duplicated_ids FROM conversations""",
}

_NULL_BODIES = ARTICLES.replace("ELSE '' END", "ELSE NULL END")

ORACLE |= {
    "article_label_conflicts": f"""WITH {ARTICLES}
SELECT count(*) AS group_size, count(DISTINCT source_row_id % 2) AS number_of_labels,
       count(DISTINCT source_row_id % 2) AS label_variants, min(source_row_id) AS first_row_id
FROM docs GROUP BY title, text HAVING count(DISTINCT source_row_id % 2) > 1""",
    "distinct_articles_by_label": f"""WITH {ARTICLES}
SELECT label, count(*) AS articles FROM (SELECT DISTINCT label, title, text FROM raw) GROUP BY label""",
    "missing_summary_null_bodies": ORACLE["missing_summary"].replace(ARTICLES, _NULL_BODIES),
}

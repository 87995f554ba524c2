"""Cleaning queries over documents and web pages, marker audits, top words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosemill import schema as S
from prosemill.catalog.articles import documents, labelled, labels, table
from prosemill.catalog.sql import ARTICLES, SPACE, SPACES, STAGE1, half_even, words
from prosemill.catalog.stage1 import numbered
from prosemill.functions.cleaning import SOURCE_MARKERS, clean_column
from prosemill.functions.text import joined, preview
from prosemill.operators import cleaning as Cl
from prosemill.operators import markers as M
from prosemill.operators import stage1 as St
from prosemill.operators import words as Wo
from prosemill.operators.sampling import label_samples
from prosemill.session import written
from prosemill.sources import spread

# The supplied texts hold no news sources, so frequent words stand in for them.
STAND_INS = ["with", "from", "that", "this"]
# Given as a parameter here, so that the SQL needs no session to be written.
STOP_WORDS = [
    "the", "of", "and", "to", "in", "is", "it", "for", "on", "as", "at", "by", "be", "was",
    "are", "or", "an", "that", "this", "with", "from", "not", "but", "they", "he", "she", "his",
    "her", "its", "their",
]


def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned complete cases."""
    cases = St.complete_cases(numbered(spark, sf_dir))
    return Cl.cleaned_articles(cases, markers=STAND_INS)


def before_after_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first complete cases by id, chosen before they are cleaned."""
    first = St.complete_cases(numbered(spark, sf_dir)).orderBy(S.ARTICLE_ID).limit(20)
    return Cl.before_after_samples(Cl.cleaned_articles(first, markers=STAND_INS))


def clean_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    return clean_column(spread(pages, "page_id"), "html", "clean_html").drop("html")


def clean_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts of all documents, cleaned with source names kept."""
    docs = documents(spark, sf_dir).withColumn(S.LABEL, F.lit(None).cast("int"))
    return Cl.cleaned_articles(docs, remove_markers=False).select(
        S.ROW_ID,
        "clean_title_word_count",
        "clean_body_word_count",
        "clean_combined_word_count",
    )


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's figures as one flat row."""
    master = written(St.master_rows(numbered(spark, sf_dir)), "master")
    report = Cl.quality_report(
        master, Cl.cleaned_articles(master, markers=STAND_INS), markers=STAND_INS
    )
    return report.select(
        "input_rows",
        "output_rows",
        F.col("label_counts")["0"].alias("label_0_rows"),
        F.col("label_counts")["1"].alias("label_1_rows"),
        "blank_clean_titles",
        "blank_clean_bodies",
        "blank_clean_combined",
        "mean_clean_title_words",
        "mean_clean_body_words",
        "duplicate_article_ids",
    )


def profile_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marker hits per label in lowered text; texts are searched before the label join."""
    docs = documents(spark, sf_dir).select(
        S.ROW_ID, F.lower(F.concat(S.TITLE, F.lit(" "), S.TEXT)).alias("_lowered")
    )
    found = M.with_found_markers(docs, "_lowered", STAND_INS, "found")
    return M.marker_hits(labelled(found, sf_dir), {"profile": "found"}, STAND_INS)


def marker_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-ins before and after cleaning, both searched in one pass over the texts."""
    docs = Cl.with_raw_text(documents(spark, sf_dir))
    targets = {S.TITLE: "clean_title", S.TEXT: "clean_body"}
    docs = Cl.with_clean_texts(docs, targets, markers=STAND_INS)
    docs = docs.select(
        S.ROW_ID,
        "raw_title_body",
        joined(F.col("clean_title"), F.col("clean_body")).alias("clean_title_body"),
    )
    found = M.with_found_markers(docs, "raw_title_body", STAND_INS, "before")
    found = M.with_found_markers(found, "clean_title_body", STAND_INS, "after")
    columns = {"before_preprocessing": "before", "after_preprocessing": "after"}
    hits = M.marker_hits(labelled(found, sf_dir), columns, STAND_INS, S.LABELS)
    return M.marker_audit(hits)


def news_marker_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The real source names, none of which the supplied documents hold."""
    docs = Cl.with_raw_text(documents(spark, sf_dir)).select(S.ROW_ID, "raw_title_body")
    found = M.with_found_markers(docs, "raw_title_body", SOURCE_MARKERS, "found")
    columns = {"before_preprocessing": "found"}
    hits = M.marker_hits(labelled(found, sf_dir), columns, SOURCE_MARKERS, S.LABELS)
    return M.marker_audit(hits)


def top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = Wo.document_words(documents(spark, sf_dir), STOP_WORDS)
    return Wo.top_words(labelled(counted, sf_dir))


def body_previews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five seeded examples per label; only their texts are read for the preview."""
    chosen = label_samples(labels(spark, sf_dir))
    return documents(spark, sf_dir).join(chosen, S.ROW_ID).select(
        S.LABEL, S.ROW_ID, S.TITLE, preview(F.col(S.TEXT)).alias("body_preview")
    )


QUERIES = {
    "clean_documents": clean_documents,
    "clean_pages_html": clean_pages,
    "clean_word_counts": clean_word_counts,
    "cleaning_quality_report": quality_report,
    "before_after_samples": before_after_samples,
    "marker_counts_by_label": lambda spark, sf: M.marker_counts_by_label(profile_hits(spark, sf)),
    "marker_gap": lambda spark, sf: M.marker_gap(
        M.marker_counts_by_label(profile_hits(spark, sf))
    ),
    "marker_audit_before_after": marker_audit,
    "news_marker_audit": news_marker_audit,
    "top_words_by_label": top_words,
    "label_samples_preview": body_previews,
}

_BLANK = r"[^\p{L}\p{N}_]"


def _plain(column: str) -> str:
    """Entities, tags, URLs and e-mail addresses of the cleaning rules."""
    sql = column
    for entity, text in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        sql = f"regexp_replace({sql}, '&{entity};?', '{text}', 'g')"
    sql = f"regexp_replace({sql}, '<[^>]+>', ' ', 'g')"
    sql = rf"regexp_replace({sql}, 'https?://[^{SPACE}]+|www\.[^{SPACE}]+', ' ', 'gi')"
    mail = r"[.+-]*[\p{L}\p{N}_][\p{L}\p{N}_.+-]*@[\p{L}\p{N}_.-]+\.[A-Za-z]{2,}\b"
    return f"regexp_replace({sql}, '{mail}', ' ', 'gi')"


def _sources(sql: str, markers: list[str]) -> str:
    """Agency brackets, dateline, then whole-word markers, longest first.

    Every marker is replaced twice: without a look-ahead the border behind one
    hit is used up and hides a hit that follows at once.
    """
    dateline = (
        rf"^[{SPACE}]*[A-Z][A-Z .''-]{{1,40}}[{SPACE}]*(?:\([A-Za-z]+\))?"
        rf"[{SPACE}]*[-–—][{SPACE}]*"
    )
    sql = rf"regexp_replace({sql}, '\([{SPACE}]*reuters[{SPACE}]*\)', ' ', 'gi')"
    sql = f"regexp_replace({sql}, '{dateline}', ' ')"
    for marker in sorted(markers, key=len, reverse=True):
        for _ in range(2):
            sql = rf"regexp_replace({sql}, '(^|{_BLANK}){marker}($|{_BLANK})', '\1 \2', 'gi')"
    return sql


def _letters(sql: str) -> str:
    sql = f"regexp_replace(lower({sql}), '[^a-z'']+', ' ', 'g')"
    return f"trim(regexp_replace({sql}, '''{{2,}}', '''', 'g'))"


def _clean(column: str, markers: list[str]) -> str:
    return _letters(_sources(_plain(column), markers))


_CLEANED = f"""
cleaned AS (
  SELECT *, trim(title_kept || ' ' || body_kept) AS both_kept,
         trim(clean_title || ' ' || clean_body) AS both_clean
  FROM (
    SELECT *, {_letters(_plain('title'))} AS title_kept, {_letters(_plain('text'))} AS body_kept,
           {_clean('title', STAND_INS)} AS clean_title, {_clean('text', STAND_INS)} AS clean_body
    FROM %s
  )
)"""
_CLEAN_CASES = f"{STAGE1}, cases AS (SELECT * FROM master WHERE complete_case), " + (
    _CLEANED % "cases"
)


def _hit(column: str, marker: str) -> str:
    return f"regexp_matches({column}, '(^|{_BLANK}){marker}($|{_BLANK})', 'i')"


def _hits(source: str, column: str, markers: list[str], extra: str = "") -> str:
    return "\nUNION ALL ".join(
        f"SELECT {extra}'{m}' AS marker, label, count(*) AS class_rows,"
        f" count(*) FILTER ({_hit(column, m)}) AS hits FROM {source} GROUP BY label"
        for m in markers
    )


def _audit(stage: str, column: str, markers: list[str], source: str = "cleaned") -> str:
    share = half_even("hits / class_rows * 100", 4)
    return f"""SELECT '{stage}' AS stage, marker, label,
       CASE label WHEN 0 THEN 'real' ELSE 'fake' END AS class_name,
       hits AS articles_with_marker, class_rows AS class_articles, {share} AS percentage
FROM ({_hits(source, column, markers)})"""


_COUNTS = f"""WITH {ARTICLES},
lowered AS (SELECT label, lower(title || ' ' || text) AS body FROM raw),
marker_counts AS (
  SELECT marker, label, hits AS document_count,
         {half_even('hits / class_rows * 100', 3)} AS document_percentage
  FROM ({_hits('lowered', 'body', STAND_INS)})
)"""


_STOP_LIST = ", ".join(f"'{word}'" for word in STOP_WORDS)
_TOP_WORDS = f"""WITH {ARTICLES},
fields AS (
  SELECT source_row_id, label, 'title' AS field, lower(title) AS body FROM raw WHERE title <> ''
  UNION ALL SELECT source_row_id, label, 'body', lower(text) FROM raw WHERE text <> ''
),
runs AS (
  SELECT source_row_id, label, field,
         unnest(regexp_extract_all(body, '[\\p{{L}}\\p{{N}}_]+')) AS word FROM fields
),
counts AS (
  SELECT field, label, word, count(*) AS count, count(DISTINCT source_row_id) AS documents
  FROM runs
  WHERE regexp_full_match(word, '[a-z]{{2,}}') AND word NOT IN ({_STOP_LIST})
  GROUP BY field, label, word
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY field, label ORDER BY count DESC, word) AS position
  FROM counts WHERE documents >= 10
)
SELECT field, label, position, word, count FROM placed WHERE position <= 20"""


ORACLE = {
    "clean_documents": f"""WITH {_CLEAN_CASES}
SELECT article_id, source_row_id, title, text, label, class_name, title_missing, text_missing,
       complete_case, trim(title || ' ' || text, {SPACES}) AS raw_title_body,
       title_kept AS clean_title_with_markers, body_kept AS clean_body_with_markers,
       both_kept AS clean_title_body_with_markers, clean_title, clean_body,
       both_clean AS clean_title_body, {words('clean_title')} AS clean_title_word_count,
       {words('clean_body')} AS clean_body_word_count,
       {words('both_clean')} AS clean_combined_word_count
FROM cleaned""",
    "clean_pages_html": f"""SELECT page_id, {_clean('html', SOURCE_MARKERS)} AS clean_html
FROM pages""",
    "clean_word_counts": f"""WITH {ARTICLES},
kept AS (
  SELECT source_row_id, {_letters(_plain('title'))} AS t, {_letters(_plain('text'))} AS b FROM docs
)
SELECT source_row_id, {words('t')} AS clean_title_word_count,
       {words('b')} AS clean_body_word_count,
       {words("t || ' ' || b")} AS clean_combined_word_count
FROM kept""",
    "cleaning_quality_report": f"""WITH {STAGE1}, {_CLEANED % 'master'}
SELECT count(*) AS input_rows, count(*) AS output_rows,
       count(*) FILTER (label = 0) AS label_0_rows, count(*) FILTER (label = 1) AS label_1_rows,
       count(*) FILTER (clean_title = '') AS blank_clean_titles,
       count(*) FILTER (clean_body = '') AS blank_clean_bodies,
       count(*) FILTER (both_clean = '') AS blank_clean_combined,
       {half_even(f"avg({words('clean_title')})", 3)} AS mean_clean_title_words,
       {half_even(f"avg({words('clean_body')})", 3)} AS mean_clean_body_words,
       count(*) - count(DISTINCT article_id) AS duplicate_article_ids
FROM cleaned""",
    "before_after_samples": f"""WITH {_CLEAN_CASES}
SELECT article_id, label, class_name, title, clean_title, text, clean_body,
       both_clean AS clean_title_body
FROM cleaned ORDER BY article_id LIMIT 20""",
    "marker_counts_by_label": f"{_COUNTS} SELECT * FROM marker_counts",
    "marker_gap": f"""{_COUNTS},
wide AS (
  SELECT marker, max(document_percentage) FILTER (label = 0) AS label_0_percentage,
         max(document_percentage) FILTER (label = 1) AS label_1_percentage
  FROM marker_counts GROUP BY marker
)
SELECT *, abs(label_1_percentage - label_0_percentage) AS absolute_gap FROM wide""",
    "marker_audit_before_after": f"""WITH {ARTICLES}, {_CLEANED % 'raw'},
stages AS (
  SELECT label, trim(title || ' ' || text, {SPACES}) AS before, both_clean AS after FROM cleaned
)
{_audit('before_preprocessing', 'before', STAND_INS, 'stages')}
UNION ALL
{_audit('after_preprocessing', 'after', STAND_INS, 'stages')}""",
    "news_marker_audit": f"""WITH {ARTICLES},
joined AS (SELECT label, trim(title || ' ' || text, {SPACES}) AS body FROM raw)
{_audit('before_preprocessing', 'body', SOURCE_MARKERS, 'joined')}""",
    "top_words_by_label": _TOP_WORDS,
    "label_samples_preview": f"""WITH {ARTICLES},
placed AS (
  SELECT *, row_number() OVER (
    PARTITION BY label ORDER BY md5('503:' || source_row_id), source_row_id) AS place
  FROM raw
)
SELECT label, source_row_id, title, replace(substr(text, 1, 200), chr(10), ' ') AS body_preview
FROM placed WHERE place <= 5""",
}


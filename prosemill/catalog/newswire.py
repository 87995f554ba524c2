"""Documents dressed up as news agency copy, so that every cleaning rule has something to do.

The same table is built here and in SQL: datelines and agency brackets from the language, source
names as words and phrases, doubled apostrophes, and bodies that are missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosemill import schema as S
from prosemill.catalog.articles import documents, labelled, table
from prosemill.catalog.cleaning import _BLANK, _audit, _clean, _hits, _letters, _plain
from prosemill.catalog.sql import ARTICLES, SPACE, SPACES, half_even
from prosemill.functions import cleaning as Fc
from prosemill.functions.matching import has_marker
from prosemill.functions.text import joined
from prosemill.operators import cleaning as Cl
from prosemill.operators import markers as M

# Searched for beside the fixed lists: names that overlap, and one that begins another.
OVERLAPPING = ["new york", "new york times", "times and fox", "fox news", "fox"]


def newswire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row id, title and text by language; French bodies are missing."""
    langs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias(S.ROW_ID), "lang")
    docs = documents(spark, sf_dir).join(langs, S.ROW_ID)
    text, lang = F.col(S.TEXT), F.col("lang")
    body = (
        F.when(lang == "en", F.concat(F.lit("NEW YORK (Reuters) - "), text, F.lit(" ( REUTERS ) it''s said''' so")))
        .when(lang == "de", F.concat(F.lit("BERLIN — "), text, F.lit(" New York Times and Fox News, CNN CNN_x Breitbart!")))
        .when(lang == "es", F.concat(F.lit("St. Ives - "), text, F.lit(" ''''the New  York Times'' of foxnews")))
    )
    title = F.when(lang == "fr", F.concat(F.lit("CNN: "), F.col(S.TITLE))).when(
        lang == "de", F.concat(F.col(S.TITLE), F.lit(" - FOX NEWS"))
    )
    return docs.select(S.ROW_ID, F.coalesce(title, F.col(S.TITLE)).alias(S.TITLE), body.alias(S.TEXT))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts with and without source names."""
    docs = newswire(spark, sf_dir).withColumn(S.LABEL, F.lit(None).cast("int"))
    columns = ["clean_title_with_markers", "clean_body_with_markers", "clean_title", "clean_body"]
    return Cl.cleaned_articles(docs).select(S.ROW_ID, *columns)


def rule_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that each rule has something to do in."""
    docs = newswire(spark, sf_dir)
    text = F.col(S.TEXT)
    rules = {
        "missing text": text.isNull(),
        "agency bracket": text.rlike(Fc.AGENCY),
        "dateline": text.rlike(Fc.DATELINE),
        "doubled apostrophes": text.contains("''"),
        **{f"source {marker}": has_marker(text, marker) for marker in Fc.SOURCE_MARKERS},
    }
    counts = docs.agg(*[F.count_if(hit).alias(f"_{i}") for i, hit in enumerate(rules.values())])
    entries = [F.struct(F.lit(name).alias("rule"), F.col(f"_{i}").alias("texts")) for i, name in enumerate(rules)]
    return counts.select(F.inline(F.array(*entries)))


def _marked(spark: SparkSession, sf_dir: str, markers: list[str]) -> DataFrame:
    docs = newswire(spark, sf_dir).select(S.ROW_ID, F.lower(S.TEXT).alias("_lowered")).where("_lowered IS NOT NULL")
    found = M.with_found_markers(docs, "_lowered", markers, "found")
    return M.marker_counts_by_label(M.marker_hits(labelled(found, sf_dir), {"profile": "found"}, markers))


def marker_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source names before and after cleaning."""
    docs = Cl.with_raw_text(newswire(spark, sf_dir))
    docs = Cl.with_clean_texts(docs, {S.TITLE: "clean_title", S.TEXT: "clean_body"})
    docs = docs.select(
        S.ROW_ID, "raw_title_body", joined(F.col("clean_title"), F.col("clean_body")).alias("clean_title_body")
    )
    found = M.with_found_markers(docs, "raw_title_body", Fc.SOURCE_MARKERS, "before")
    found = M.with_found_markers(found, "clean_title_body", Fc.SOURCE_MARKERS, "after")
    columns = {"before_preprocessing": "before", "after_preprocessing": "after"}
    return M.marker_audit(M.marker_hits(labelled(found, sf_dir), columns, Fc.SOURCE_MARKERS, S.LABELS))


QUERIES = {
    "newswire_cleaned": cleaned,
    "newswire_rule_hits": rule_hits,
    "newswire_marker_counts": lambda spark, sf: _marked(spark, sf, M.PROFILE_MARKERS),
    "newswire_overlapping_markers": lambda spark, sf: _marked(spark, sf, OVERLAPPING),
    "newswire_marker_audit": marker_audit,
}

NEWSWIRE = f"""{ARTICLES},
wire AS (
  SELECT r.source_row_id, l.quality AS label,
         CASE lang WHEN 'fr' THEN 'CNN: ' || title WHEN 'de' THEN title || ' - FOX NEWS' ELSE title END AS title,
         CASE lang WHEN 'en' THEN 'NEW YORK (Reuters) - ' || r.text || ' ( REUTERS ) it''''s said'''''' so'
                   WHEN 'de' THEN 'BERLIN — ' || r.text || ' New York Times and Fox News, CNN CNN_x Breitbart!'
                   WHEN 'es' THEN 'St. Ives - ' || r.text || ' ''''''''the New  York Times'''' of foxnews' END AS text
  FROM docs r JOIN documents d ON d.doc_id = r.source_row_id LEFT JOIN labels l ON l.doc_id = r.source_row_id
)"""

_DATELINE = (
    rf"^[{SPACE}]*[A-Z][A-Z .''-]{{1,40}}[{SPACE}]*(?:\([A-Za-z]+\))?[{SPACE}]*[-–—][{SPACE}]*"
)
_RULES = {
    "missing text": "text IS NULL",
    "agency bracket": rf"regexp_matches(text, '\([{SPACE}]*reuters[{SPACE}]*\)', 'i')",
    "dateline": f"regexp_matches(text, '{_DATELINE}')",
    "doubled apostrophes": "contains(text, '''''')",
    **{f"source {m}": f"regexp_matches(text, '(^|{_BLANK}){m}($|{_BLANK})', 'i')" for m in Fc.SOURCE_MARKERS},
}


def _counts_sql(markers: list[str]) -> str:
    return f"""WITH {NEWSWIRE},
lowered AS (SELECT label, lower(text) AS body FROM wire WHERE text IS NOT NULL AND label IS NOT NULL)
SELECT marker, label, hits AS document_count, {half_even('hits / class_rows * 100', 3)} AS document_percentage
FROM ({_hits('lowered', 'body', markers)})"""


ORACLE = {
    "newswire_cleaned": f"""WITH {NEWSWIRE}, filled AS (SELECT source_row_id, title, coalesce(text, '') AS body FROM wire)
SELECT source_row_id, {_letters(_plain('title'))} AS clean_title_with_markers, {_letters(_plain('body'))} AS clean_body_with_markers,
       {_clean('title', Fc.SOURCE_MARKERS)} AS clean_title, {_clean('body', Fc.SOURCE_MARKERS)} AS clean_body
FROM filled""",
    "newswire_rule_hits": f"WITH {NEWSWIRE} " + " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER ({test}) AS texts FROM wire" for name, test in _RULES.items()
    ),
    "newswire_marker_counts": _counts_sql(M.PROFILE_MARKERS),
    "newswire_overlapping_markers": _counts_sql(OVERLAPPING),
    "newswire_marker_audit": f"""WITH {NEWSWIRE},
stages AS (
  SELECT label, trim(title || ' ' || trim(coalesce(text, ''), {SPACES}), {SPACES}) AS before,
         trim({_clean('title', Fc.SOURCE_MARKERS)} || ' ' || {_clean("coalesce(text, '')", Fc.SOURCE_MARKERS)}) AS after
  FROM wire WHERE label IS NOT NULL
)
{_audit('before_preprocessing', 'before', Fc.SOURCE_MARKERS, 'stages')}
UNION ALL
{_audit('after_preprocessing', 'after', Fc.SOURCE_MARKERS, 'stages')}""",
}

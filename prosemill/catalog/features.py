"""Sampling, split, vocabulary and feature queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosemill import schema as S
from prosemill.catalog.articles import documents, labels
from prosemill.catalog.sql import ARTICLES
from prosemill.functions.text import joined
from prosemill.operators import features as Fe
from prosemill.operators import sampling as Sa
from prosemill.session import written

# Rows per class of the sample, small enough for both classes at every scale but
# the smallest, and a number larger than the smaller class at the compared scale.
PER_CLASS = 40
TOO_MANY = 100
# Vocabulary caps, small enough to cut at the compared scale.
UNIGRAM_CAP = 300
BIGRAM_CAP = 600

UNIGRAM = Fe.tfidf_unigram(UNIGRAM_CAP)
UNI_BIGRAM = Fe.tfidf_uni_bigram(BIGRAM_CAP)
BOW = Fe.bow_unigram(UNIGRAM_CAP)

# Title and body are tokenized; the third setting is their join by definition.
INPUTS = Fe.Inputs({"title": "clean_title", "body": "clean_body"}, ("combined", "title", "body"))


def split(spark: SparkSession, sf_dir: str, per_class: int | None = None) -> DataFrame:
    return Sa.sample_and_split(labels(spark, sf_dir), per_class, id_col=S.ROW_ID)


def lowered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select(
        S.ROW_ID, F.lower(S.TITLE).alias("clean_title"), F.lower(S.TEXT).alias("clean_body")
    )


def split_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lowered title, body and both of all labelled documents with their split part."""
    docs = lowered(spark, sf_dir)
    docs = docs.withColumn("clean_title_body", joined(F.col("clean_title"), F.col("clean_body")))
    columns = list(S.INPUT_SETTINGS.values())
    return Sa.split_texts(split(spark, sf_dir), docs, columns, id_col=S.ROW_ID)


def fitted(
    spark: SparkSession, sf_dir: str, kinds: list[Fe.Representation]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split, document tokens and vocabulary; what is read twice is written first."""
    parts = written(split(spark, sf_dir), "split")
    texts = Sa.split_texts(parts, lowered(spark, sf_dir), list(INPUTS.own.values()), id_col=S.ROW_ID)
    tokens = written(Fe.document_tokens(texts, INPUTS, id_col=S.ROW_ID), "tokens")
    return parts, tokens, Fe.fitted_vocabulary(tokens, parts, kinds, INPUTS)


def feature_rows(spark: SparkSession, sf_dir: str, kinds: list[Fe.Representation]) -> DataFrame:
    _, tokens, vocab = fitted(spark, sf_dir, kinds)
    return Fe.feature_rows(tokens, vocab, kinds, INPUTS, id_col=S.ROW_ID)


def vocabulary(kind: Fe.Representation):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        _, _, vocab = fitted(spark, sf_dir, [kind])
        return vocab.withColumn("idf", F.round("idf", 6))

    return query


def features(kind: Fe.Representation):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = Fe.long_features(feature_rows(spark, sf_dir, [kind]), id_col=S.ROW_ID)
        return rows.withColumn("weight", F.round("weight", 6))

    return query


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document, setting and representation, documents without terms included."""
    rows = feature_rows(spark, sf_dir, [UNIGRAM, UNI_BIGRAM])
    return rows.select(
        "setting",
        "representation",
        "split",
        S.ROW_ID,
        S.LABEL,
        F.size("indices").alias("known_terms"),
        F.array_join(F.transform("indices", lambda i: i.cast("string")), " ").alias("indices"),
        F.round(F.aggregate("weights", F.lit(0.0), lambda acc, w: acc + w * w), 6).alias("norm"),
    )


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = [UNIGRAM, UNI_BIGRAM]
    parts, _, vocab = fitted(spark, sf_dir, kinds)
    return Fe.feature_summary(vocab, parts, kinds, INPUTS)


QUERIES = {
    "downsample_balanced": lambda spark, sf: Sa.downsample(
        labels(spark, sf), PER_CLASS, id_col=S.ROW_ID
    ),
    "downsample_passthrough": lambda spark, sf: Sa.downsample(
        labels(spark, sf), TOO_MANY, id_col=S.ROW_ID
    ),
    "stratified_split": split,
    "sampled_split": lambda spark, sf: split(spark, sf, PER_CLASS),
    "split_tables": lambda spark, sf: split(spark, sf).orderBy("split", S.ROW_ID),
    "split_texts": split_texts,
    "bow_unigram": features(BOW),
    "vocab_unigram": vocabulary(UNIGRAM),
    "vocab_uni_bigram": vocabulary(UNI_BIGRAM),
    "tfidf_unigram": features(UNIGRAM),
    "tfidf_uni_bigram": features(UNI_BIGRAM),
    "feature_matrix_packed": packed,
    "feature_summary": summary,
}


def _split_sql(per_class: int | None) -> str:
    """Ranks by hash within the label, quotas by largest remainder."""
    take = "n"
    if per_class is not None:
        take = f"CASE WHEN min(n) OVER () < {per_class} THEN n ELSE {per_class} END"
    return f"""
placed AS (
  SELECT doc_id AS source_row_id, quality AS label,
         row_number() OVER (
           PARTITION BY quality ORDER BY md5('123:' || doc_id), doc_id) - 1 AS place
  FROM labels
),
classes AS (SELECT label, count(*) AS n FROM placed GROUP BY label),
taken AS (SELECT label, {take} AS take FROM classes),
totals AS (
  SELECT *, sum(take) OVER () AS total, ceil(sum(take) OVER () * 0.2::DOUBLE) AS held FROM taken
),
train_share AS (
  SELECT *, floor(take / total * (total - held)) AS whole,
         take / total * (total - held) - floor(take / total * (total - held)) AS remainder
  FROM totals
),
train_quota AS (
  SELECT *, whole + CASE WHEN row_number() OVER (ORDER BY remainder DESC, label)
                              <= (total - held) - sum(whole) OVER () THEN 1 ELSE 0 END AS train
  FROM train_share
),
val_share AS (
  SELECT *, held - ceil(held * 0.5::DOUBLE) AS val_total,
         floor((take - train) / held * (held - ceil(held * 0.5::DOUBLE))) AS val_whole,
         (take - train) / held * (held - ceil(held * 0.5::DOUBLE))
           - floor((take - train) / held * (held - ceil(held * 0.5::DOUBLE))) AS val_left
  FROM train_quota
),
quota AS (
  SELECT label, take, train, val_whole
         + CASE WHEN row_number() OVER (ORDER BY val_left DESC, label)
                     <= val_total - sum(val_whole) OVER () THEN 1 ELSE 0 END AS val
  FROM val_share
),
split AS (
  SELECT source_row_id, label,
         CASE WHEN place < train THEN 'train' WHEN place < train + val THEN 'val' ELSE 'test' END
           AS split
  FROM placed JOIN quota USING (label) WHERE place < take
)"""


def _downsample_sql(per_class: int) -> str:
    return f"""WITH placed AS (
  SELECT doc_id AS source_row_id, quality AS label,
         row_number() OVER (PARTITION BY quality ORDER BY md5('123:' || doc_id), doc_id) AS place
  FROM labels
),
smallest AS (SELECT min(n) AS n FROM (SELECT count(*) AS n FROM labels GROUP BY quality))
SELECT source_row_id, label FROM placed, smallest WHERE smallest.n < {per_class}
   OR place <= {per_class}"""


def _terms_sql(longest: int) -> str:
    """Counted terms of every document and setting, with the document counts."""
    pairs = """
  UNION ALL
  SELECT setting, source_row_id, split, label, toks[i] || ' ' || toks[i + 1] AS term
  FROM (SELECT *, unnest(range(1, len(toks))) AS i FROM tokenized WHERE len(toks) > 1)"""
    return f"""{ARTICLES}, {_split_sql(None)},
texts AS (
  SELECT s.*, lower(d.title) AS title, lower(d.text) AS body,
         trim(lower(d.title) || ' ' || lower(d.text)) AS both_texts
  FROM split s JOIN docs d USING (source_row_id)
),
inputs AS (
  SELECT 'title' AS setting, source_row_id, split, label, title AS body FROM texts
  UNION ALL SELECT 'body', source_row_id, split, label, body FROM texts
  UNION ALL SELECT 'combined', source_row_id, split, label, both_texts FROM texts
),
tokenized AS (
  SELECT setting, source_row_id, split, label, regexp_extract_all(body, '[a-z'']+') AS toks
  FROM inputs
),
single AS (
  SELECT setting, source_row_id, split, label, unnest(toks) AS term FROM tokenized
  {pairs if longest > 1 else ''}
),
tfs AS (
  SELECT setting, source_row_id, split, label, term, count(*) AS tf
  FROM single GROUP BY ALL
),
size AS (SELECT count(*) AS n FROM split WHERE split = 'train')"""


def _vocabulary_sql(kind: Fe.Representation) -> str:
    return f"""{_terms_sql(kind.longest)},
dfs AS (
  SELECT setting, term, count(*) AS df, sum(tf) AS total
  FROM tfs WHERE split = 'train' GROUP BY setting, term
),
ranked AS (
  SELECT dfs.*, n, row_number() OVER (PARTITION BY setting ORDER BY total DESC, term) AS place
  FROM dfs, size WHERE df >= 5 AND df <= 0.95::DOUBLE * n
),
vocab AS (
  SELECT setting, '{kind.name}' AS representation, term, df, total,
         row_number() OVER (PARTITION BY setting ORDER BY term) - 1 AS term_idx,
         ln((1 + n) / (1 + df)) + 1 AS idf
  FROM ranked WHERE place <= {kind.max_features}
)"""


def _weights_sql(kind: Fe.Representation) -> str:
    norm = "sqrt(sum(w * w) OVER (PARTITION BY setting, source_row_id))" if kind.tfidf else "1"
    weight = "tf * idf" if kind.tfidf else "tf"
    return f"""{_vocabulary_sql(kind)},
raw_weights AS (
  SELECT setting, representation, split, source_row_id, label, term_idx,
         CAST({weight} AS DOUBLE) AS w
  FROM tfs JOIN vocab USING (setting, term)
),
weights AS (
  SELECT setting, representation, split, source_row_id, label, term_idx, w / {norm} AS weight
  FROM raw_weights
)"""


def _features_sql(kind: Fe.Representation) -> str:
    return f"""WITH {_weights_sql(kind)}
SELECT setting, representation, split, source_row_id, term_idx, round(weight, 6) AS weight
FROM weights"""


def _packed_sql(kind: Fe.Representation) -> str:
    return f"""SELECT * FROM (WITH {_weights_sql(kind)},
rows AS (
  SELECT setting, source_row_id, count(*) AS known_terms,
         string_agg(term_idx, ' ' ORDER BY term_idx) AS indices, sum(weight * weight) AS norm
  FROM weights GROUP BY setting, source_row_id
)
SELECT setting, '{kind.name}' AS representation, split, source_row_id, label,
       coalesce(known_terms, 0) AS known_terms, coalesce(indices, '') AS indices,
       round(coalesce(norm, 0), 6) AS norm
FROM tokenized LEFT JOIN rows USING (setting, source_row_id))"""


def _summary_sql(kind: Fe.Representation) -> str:
    return f"""SELECT * FROM (WITH {_vocabulary_sql(kind)}
SELECT setting AS input_setting, '{kind.name}' AS representation, coalesce(v.size, 0) AS vocab_size,
       (SELECT count(*) FROM split WHERE split = 'train') AS train_rows,
       (SELECT count(*) FROM split WHERE split = 'val') AS val_rows,
       (SELECT count(*) FROM split WHERE split = 'test') AS test_rows
FROM (VALUES ('title'), ('body'), ('combined')) s(setting)
LEFT JOIN (SELECT setting, count(*) AS size FROM vocab GROUP BY setting) v USING (setting))"""


def _vocab_rows_sql(kind: Fe.Representation) -> str:
    return f"""WITH {_vocabulary_sql(kind)}
SELECT setting, representation, term_idx, term, df, total, round(idf, 6) AS idf FROM vocab"""


ORACLE = {
    "downsample_balanced": _downsample_sql(PER_CLASS),
    "downsample_passthrough": _downsample_sql(TOO_MANY),
    "stratified_split": f"WITH {_split_sql(None)} SELECT * FROM split",
    "sampled_split": f"WITH {_split_sql(PER_CLASS)} SELECT * FROM split",
    "split_tables": f"WITH {_split_sql(None)} SELECT * FROM split",
    "split_texts": f"""WITH {ARTICLES}, {_split_sql(None)}
SELECT source_row_id, label, split, lower(title) AS clean_title, lower(text) AS clean_body,
       trim(lower(title) || ' ' || lower(text)) AS clean_title_body
FROM split JOIN docs USING (source_row_id)""",
    "bow_unigram": _features_sql(BOW),
    "vocab_unigram": _vocab_rows_sql(UNIGRAM),
    "vocab_uni_bigram": _vocab_rows_sql(UNI_BIGRAM),
    "tfidf_unigram": _features_sql(UNIGRAM),
    "tfidf_uni_bigram": _features_sql(UNI_BIGRAM),
    "feature_matrix_packed": f"{_packed_sql(UNIGRAM)} UNION ALL {_packed_sql(UNI_BIGRAM)}",
    "feature_summary": f"{_summary_sql(UNIGRAM)} UNION ALL {_summary_sql(UNI_BIGRAM)}",
}

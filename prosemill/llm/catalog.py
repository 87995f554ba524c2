"""The registered queries of this folder and, where SQL can express them, their SQL."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from prosemill.llm.collocations import collocations
from prosemill.llm.decontamination import contamination_digest
from prosemill.llm.exact_dedup import dedup_report
from prosemill.llm.frames import table
from prosemill.llm.importance import resampled
from prosemill.llm.jaccard_join import jaccard_report
from prosemill.llm.language import language_report
from prosemill.llm.lm_scores import lm_report
from prosemill.llm.piece_codec import round_trip
from prosemill.llm.quality import quality_report
from prosemill.llm.secret_scan import secret_report
from prosemill.llm.token_counts import token_counts
from prosemill.llm.token_files import read_token_files, write_token_files
from prosemill.llm.shared import new_folder
from prosemill.llm.web_archive import archive_report

WORD_MODEL, WORD_END = "word_bpe_49k.json", 2
PIECE_MODEL = "piece_bpe_32k.model"


def tokenizer_file(name: str) -> bytes:
    """A public tokenizer's file, read where the driver runs."""
    return Path(public_tokenizers.path(name)).read_bytes()


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_report(table(spark, sf_dir, "documents"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), tokenizer_file(PIECE_MODEL))


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_report(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_file(PIECE_MODEL))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "token_files")
    write_token_files(table(spark, sf_dir, "documents"), tokenizer_file(WORD_MODEL), WORD_END, path)
    return read_token_files(spark, path)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_report(table(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_report(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(spark, sf_dir, "documents"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_report(table(spark, sf_dir, "pages"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_lm_scores": op3_lm_scores,
    "op4_token_counts": op4_token_counts,
    "op5_token_files": op5_token_files,
    "op6_language": op6_language,
    "op7_decontamination": op7_decontamination,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_quality": op9_quality,
    "op10_secret_scan": op10_secret_scan,
    "op11_warc": op11_warc,
    "op12_importance": op12_importance,
    "op13_collocations": op13_collocations,
}

ORACLE = {
    "op8_exact_dedup": """
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256
FROM (
    SELECT doc_id, coalesce(text, '') AS text,
           max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
           count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size
    FROM documents
)""",
    "op7_decontamination": r"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
),
item_words AS (
    SELECT CAST(item_id AS VARCHAR) AS item_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
),
windows AS (
    SELECT DISTINCT item_id, least(len(words), 10) AS size, array_to_string(words[k : k + 9], ' ') AS window_text
    FROM (SELECT *, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS k FROM item_words WHERE len(words) > 0)
),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
    SELECT doc_id, size, k, array_to_string(words[k : k + size - 1], ' ') AS window_text
    FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS k FROM doc_words, sizes)
),
found AS (SELECT doc_id, k, p.size, item_id FROM places p JOIN windows w ON w.size = p.size AND w.window_text = p.window_text),
hits AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(k, k + size)) AS place FROM found) GROUP BY doc_id
),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
    FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op11_warc": """
WITH payloads AS (
    SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS hex_digest,
           min(page_id) OVER (PARTITION BY html) AS first_id,
           row_number() OVER (PARTITION BY html ORDER BY page_id) AS place
    FROM (SELECT page_id, coalesce(html, '') AS html FROM pages)
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  CAST((CAST('0x' || substr(hex_digest, 1 + 10 * (i // 8), 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31 AS BIGINT) + 1, 1)), '')
           AS payload_digest,
       CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place > 1 THEN first_id END AS refers_to
FROM payloads""",
    "op12_importance": r"""
WITH RECURSIVE crc_steps AS (
    SELECT n AS byte, n AS value, 0 AS step FROM range(256) t(n)
    UNION ALL
    SELECT byte, CASE WHEN value & 1 = 1 THEN xor(value >> 1, 3988292384) ELSE value >> 1 END, step + 1 FROM crc_steps WHERE step < 8
),
crc_table AS (SELECT list(value ORDER BY byte) AS entries FROM crc_steps WHERE step = 8),
doc_words AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
    FROM documents
),
item_words AS (
    SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
    FROM benchmark
),
spelled AS (
    SELECT word, list_transform(range(strlen(word)), lambda i: CAST('0x' || substr(hex(encode(word)), 2 * i + 1, 2) AS BIGINT)) AS bytes
    FROM (SELECT word FROM doc_words UNION SELECT word FROM item_words)
),
buckets AS (
    SELECT word, xor(list_reduce(bytes, lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 10000 AS bucket
    FROM spelled, crc_table
),
corpus AS (SELECT bucket, count(*) AS s FROM doc_words JOIN buckets USING (word) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM item_words JOIN buckets USING (word) GROUP BY bucket),
totals AS (
    SELECT CAST((SELECT coalesce(sum(s), 0) FROM corpus) AS DOUBLE) AS s_all, CAST((SELECT coalesce(sum(t), 0) FROM target) AS DOUBLE) AS t_all
),
gains AS (
    SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + 10000) / ((s + 1)::DOUBLE * (t_all + 10000)))) AS BIGINT) AS gain
    FROM corpus LEFT JOIN target USING (bucket), totals
),
sums AS (SELECT doc_id, count(*) AS n_features, sum(gain) AS gained FROM doc_words JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
    SELECT d.doc_id, coalesce(n_features, 0) AS n_features, CAST(coalesce(floor(gained / n_features), 0) AS BIGINT) AS weight,
           CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS noise
    FROM documents d LEFT JOIN sums ON sums.doc_id = d.doc_id
),
drawn AS (
    SELECT doc_id, row_number() OVER (ORDER BY weight + noise DESC, doc_id) AS rank, count(*) OVER () AS eligible
    FROM scored WHERE n_features >= 20
)
SELECT s.doc_id, n_features, weight, weight + noise AS score, rank
FROM scored s LEFT JOIN (SELECT doc_id, rank FROM drawn WHERE rank <= 10 * eligible // 100) r ON r.doc_id = s.doc_id""",
    "op13_collocations": r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
),
piece_words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
totals AS (SELECT lang, sum(len(words)) AS n FROM piece_words GROUP BY lang),
grams AS (
    SELECT lang, size, array_to_string(words[k : k + size - 1], ' ') AS phrase
    FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS k FROM piece_words, range(1, 5) sizes(size) WHERE len(words) >= size)
),
counts AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY lang, size, phrase HAVING count(*) >= 30),
candidates AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS words FROM counts WHERE size > 1),
cuts AS (
    SELECT lang, phrase, a, k, array_to_string(words[1 : k], ' ') AS head, array_to_string(words[k + 1 :], ' ') AS rest
    FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)
),
scored AS (
    SELECT c.lang, c.phrase, a, k, h.f AS l, r.f AS r, (CAST(2000000 AS HUGEINT) * a) // (CAST(h.f AS HUGEINT) + r.f) AS score
    FROM cuts c JOIN counts h ON h.lang = c.lang AND h.phrase = head JOIN counts r ON r.lang = c.lang AND r.phrase = rest
),
weakest AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored) WHERE place = 1
),
inner_phrases AS (
    SELECT lang, a AS around, array_to_string(words[k : k + part - 1], ' ') AS phrase
    FROM (SELECT *, unnest(range(1, size - part + 2)) AS k FROM (SELECT *, unnest(range(2, size)) AS part FROM candidates))
),
covers AS (SELECT lang, phrase, max(around) AS around FROM inner_phrases GROUP BY lang, phrase),
ranked AS (
    SELECT w.lang, w.phrase, a, l, r, score, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank
    FROM weakest w LEFT JOIN covers v ON v.lang = w.lang AND v.phrase = w.phrase
    WHERE around IS NULL OR CAST(100 AS HUGEINT) * around < CAST(80 AS HUGEINT) * a
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
}

"""SQL building blocks shared by the comparison queries."""

from __future__ import annotations

from prosemill.functions.text import WHITE_SPACE

# White space as an SQL text: every character by its number.
SPACES = " || ".join(f"chr({ord(c)})" for c in WHITE_SPACE)
SPACE = "".join(rf"\x{{{ord(c):x}}}" for c in WHITE_SPACE)

ARTICLES = f"""
docs AS (
  SELECT doc_id AS source_row_id,
         trim(split_part(text, chr(10), 1), {SPACES}) AS title,
         trim(CASE WHEN instr(text, chr(10)) > 0
                   THEN substr(text, instr(text, chr(10)) + 1) ELSE '' END, {SPACES}) AS text
  FROM documents
),
raw AS (
  SELECT d.*, l.quality AS label FROM docs d JOIN labels l ON l.doc_id = d.source_row_id
),
raw_all AS (
  SELECT d.*, l.quality AS label FROM docs d LEFT JOIN labels l ON l.doc_id = d.source_row_id
)"""

STAGE1 = f"""{ARTICLES},
stage1 AS (
  SELECT *, CASE label WHEN 0 THEN 'real' WHEN 1 THEN 'fake' END AS class_name,
         title = '' AS title_missing, text = '' AS text_missing,
         NOT (title = '' OR text = '') AS complete_case
  FROM raw
),
firsts AS (
  SELECT *, row_number() OVER (PARTITION BY title, text ORDER BY source_row_id) AS copy
  FROM stage1
),
master AS (
  SELECT row_number() OVER (ORDER BY source_row_id) - 1 AS article_id, * EXCLUDE (copy)
  FROM firsts WHERE copy = 1
)"""


def words(column: str) -> str:
    """Number of white-space separated words."""
    return rf"len(regexp_extract_all({column}, '[^{SPACE}]+'))"


def half_even(value: str, digits: int) -> str:
    scale = float(10**digits)
    return f"(round_even(({value}) * {scale}, 0) / {scale})"


def measures(pairs: dict[str, str], source: str) -> str:
    """Rows (measure, value) from a one-row source."""
    rows = [
        f"SELECT '{name}' AS measure, CAST({value} AS DOUBLE) AS value FROM {source}"
        for name, value in pairs.items()
    ]
    return "\nUNION ALL ".join(rows)

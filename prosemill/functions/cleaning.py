"""The ordered text-cleaning rules."""

from __future__ import annotations

import html
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from prosemill.functions.matching import WORD_BORDER, without_markers
from prosemill.functions.text import SPACE_CLASS, WORD_CLASS, filled

# Source names taken out of the final text.
SOURCE_MARKERS = ["reuters", "new york times", "breitbart", "cnn", "fox news"]
# The patterns of the cleaning rules, white space and word
# characters spelled out (see functions.text).
TAG = r"<[^>]+>"
URL = rf"(?iU)(?:https?://[^{SPACE_CLASS}]+|www\.[^{SPACE_CLASS}]+)"
EMAIL = (
    rf"(?iu){WORD_BORDER}[{WORD_CLASS}.+-]+@[{WORD_CLASS}.-]+\.[A-Za-z]{{2,}}{WORD_BORDER}"
)
AGENCY = rf"(?iU)\([{SPACE_CLASS}]*reuters[{SPACE_CLASS}]*\)"
DATELINE = (
    rf"(?U)^[{SPACE_CLASS}]*[A-Z][A-Z .'-]{{1,40}}[{SPACE_CLASS}]*"
    rf"(?:\([A-Za-z]+\))?[{SPACE_CLASS}]*[-–—][{SPACE_CLASS}]*"
)


@F.pandas_udf(StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def decode_entities(column: Column) -> Column:
    """Decode HTML entities once.

    The only step without a native form. Texts without an ampersand are passed to
    Python as null: a condition around the call would not keep them back.
    """
    encoded = F.when(F.contains(column, F.lit("&")), column)
    return F.coalesce(_unescape(encoded), column)


def _replaced_if(column: Column, hint: str, pattern: str, by: str = " ") -> Column:
    """Replace a pattern that cannot match without the given characters.

    The column is named three times, so it should be a plain column: see `steps`.
    """
    replaced = F.regexp_replace(column, pattern, by)
    return F.when(F.contains(column, F.lit(hint)), replaced).otherwise(column)


def without_tags_and_links(column: Column) -> Column:
    return F.regexp_replace(_replaced_if(column, "<", TAG), URL, " ")


def without_addresses(column: Column) -> Column:
    return _replaced_if(column, "@", EMAIL)


def without_dateline(column: Column) -> Column:
    """Agency brackets, then a leading dateline to blanks."""
    return F.regexp_replace(_replaced_if(column, "(", AGENCY), DATELINE, " ")


def letters_spaced(column: Column) -> Column:
    """Lower case, every run of characters but letters and apostrophes to one blank.

    That is the same as a blank per character followed by the collapsing of white
    space.
    """
    return F.regexp_replace(F.lower(column), r"[^a-z']+", " ")


def single_apostrophes(column: Column) -> Column:
    """Runs of apostrophes to one, no blanks outside."""
    return F.btrim(_replaced_if(column, "''", r"'{2,}", "'"))


# The rules in order, in three parts: what is done with and without source names
# alike, what takes the names out, and the last steps. Each rule is applied to the
# column left by the one before, so that a text is worked on once per rule.
MARKUP_STEPS = [decode_entities, without_tags_and_links, without_addresses]
LETTER_STEPS = [letters_spaced, single_apostrophes]


def source_steps(markers: list[str]) -> list[Callable[[Column], Column]]:
    return [without_dateline, lambda column: without_markers(column, markers)]


def steps(
    df: DataFrame, columns: list[str], rules: list[Callable[[Column], Column]]
) -> DataFrame:
    """Apply rules one after the other to some columns of a table.

    All columns go through a rule together: a call to Python for one column above
    the rules of another would make the optimizer repeat those rules.
    """
    for rule in rules:
        df = df.withColumns({column: rule(F.col(column)) for column in columns})
    return df


def clean_column(
    df: DataFrame,
    column: str,
    target: str,
    *,
    remove_markers: bool = True,
    markers: list[str] | None = None,
) -> DataFrame:
    """Add the cleaned form of a text column under a new name."""
    rules = list(MARKUP_STEPS)
    if remove_markers:
        rules += source_steps(SOURCE_MARKERS if markers is None else markers)
    return steps(df.withColumn(target, filled(F.col(column))), [target], rules + LETTER_STEPS)

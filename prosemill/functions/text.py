"""White space, words, tokens and term counts as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that str.strip, str.split and the \s of a text
# pattern treat as white space in Python. Spark's own trim only knows the blank.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a character-class body, for patterns with the flag
# U, and the word characters as a character-class body.
SPACE_CLASS = r"\s\x1c-\x1f"
WORD_CLASS = r"\p{L}\p{N}_"
# Token patterns of the feature step and of the profile step.
FEATURE_TOKEN = r"[a-z']+"
PROFILE_WORD = r"^[a-z]{2,}$"


def filled(column: Column) -> Column:
    """Null becomes the empty text; everything else becomes text."""
    return F.coalesce(column.cast("string"), F.lit(""))


def strip(column: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.btrim(column, F.lit(WHITE_SPACE))


def is_blank(column: Column) -> Column:
    """True for null, empty and white-space-only text."""
    return strip(filled(column)) == ""


def joined(first: Column, second: Column) -> Column:
    """Two texts with a blank between them, stripped outside."""
    return strip(F.concat(first, F.lit(" "), second))


def word_count(column: Column) -> Column:
    """Number of white-space separated words; 0 for null and blank."""
    return F.regexp_count(filled(column), F.lit(f"(?U)[^{SPACE_CLASS}]+"))


def preview(column: Column, size: int = 200) -> Column:
    """The first characters with line feeds shown as blanks."""
    return F.translate(F.substring(column, 1, size), "\n", " ")


def round_half_even(column: Column, digits: int) -> Column:
    """Scale, round to the even neighbour on ties, scale back."""
    scale = float(10**digits)
    return F.rint(column * F.lit(scale)) / F.lit(scale)


def tokens(column: Column, pattern: str = FEATURE_TOKEN) -> Column:
    """All matches of the token pattern, in text order, without lowering."""
    return F.regexp_extract_all(column, F.lit(pattern), F.lit(0))


def profile_words(column: Column, stop_words: list[str]) -> Column:
    """Lower-case whole words of two or more plain letters, stop words left out.

    A word next to an accented letter, a digit or an underscore is part of a
    longer run and does not count, so whole runs are taken first.
    """
    runs = F.regexp_extract_all(F.lower(column), F.lit(f"[{WORD_CLASS}]+"), F.lit(0))
    kept = F.filter(runs, lambda word: word.rlike(PROFILE_WORD))
    if not stop_words:
        return kept
    return F.filter(kept, lambda word: ~word.isin(stop_words))


def bigrams(token_array: Column) -> Column:
    """Neighbouring tokens joined by a blank; none for fewer than two tokens."""
    pairs = F.size(token_array) - 1
    return F.when(
        pairs > 0,
        F.zip_with(
            F.slice(token_array, F.lit(1), pairs),
            F.slice(token_array, F.lit(2), pairs),
            lambda left, right: F.concat(left, F.lit(" "), right),
        ),
    ).otherwise(F.array().cast("array<string>"))


def run_starts(ordered: Column) -> Column:
    """Positions in a sorted array at which a new value begins."""
    positions = F.when(
        F.size(ordered) > 0, F.sequence(F.lit(0), F.size(ordered) - 1)
    ).otherwise(F.array().cast("array<int>"))
    return F.filter(
        positions,
        lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
    )


def run_lengths(ordered: Column, starts: Column) -> Column:
    """`array<struct<term, tf>>` from a sorted array and its run starts."""
    return F.transform(
        starts,
        lambda start, k: F.struct(
            F.get(ordered, start).alias("term"),
            (F.coalesce(F.get(starts, k + 1), F.size(ordered)) - start).alias("tf"),
        ),
    )

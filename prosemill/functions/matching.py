"""Whole-word search for source markers."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosemill.functions.text import WORD_CLASS

# A word border with Unicode letters and digits, spelled out because the meaning
# of \b depends on the Java version.
WORD_BORDER = (
    f"(?:(?<=[{WORD_CLASS}])(?![{WORD_CLASS}])|(?<![{WORD_CLASS}])(?=[{WORD_CLASS}]))"
)


def _is_word(character: str) -> bool:
    return character.isalnum() or character == "_"


def _border(inner: str, *, before: bool) -> str:
    """The border at one end of a marker, given the marker's outermost character."""
    if before:
        return f"(?<![{WORD_CLASS}])" if _is_word(inner) else f"(?<=[{WORD_CLASS}])"
    return f"(?![{WORD_CLASS}])" if _is_word(inner) else f"(?=[{WORD_CLASS}])"


def marker_pattern(marker: str) -> str:
    """Pattern for one marker as a whole word or whole phrase."""
    if not marker:
        raise ValueError("A marker must not be empty.")
    return (
        _border(marker[0], before=True)
        + re.escape(marker)
        + _border(marker[-1], before=False)
    )


def possible_marker_pattern(markers: list[str]) -> str:
    """Pattern that matches wherever a marker may match, and a little more.

    One border for all markers is much cheaper to search for than one for each.
    """
    names = "|".join(re.escape(marker) for marker in markers)
    if all(_is_word(marker[0]) for marker in markers):
        return f"(?<![{WORD_CLASS}])(?:{names})"
    return f"(?:{names})"


def has_marker(column: Column, marker: str, *, ignore_case: bool = True) -> Column:
    flags = "(?iu)" if ignore_case else ""
    return column.rlike(flags + marker_pattern(marker))


def may_have_marker(column: Column, markers: list[str], *, ignore_case: bool = True) -> Column:
    flags = "(?iu)" if ignore_case else ""
    return column.rlike(flags + possible_marker_pattern(markers))


def found_markers(df: DataFrame, column: str, markers: list[str], name: str, *, ignore_case: bool = True) -> DataFrame:
    """Add the array of the markers a text holds, in the order of the list, by one search of the text.

    The search looks ahead at every place, so markers that overlap are all found. Of several that
    begin at one place it gives the longest; the others are its beginnings, and which of these stand
    there as whole words can be told from the longest alone. What was found is then told apart by
    the same rules of letter case.
    """
    flags = "(?iu)" if ignore_case else ""
    alternatives = "|".join(marker_pattern(marker) for marker in longest_first(markers))
    hits = F.regexp_extract_all(F.col(column), F.lit(f"{flags}(?=({alternatives}))"), F.lit(1))
    df = df.withColumn("_hits", F.array_distinct(hits))

    def held(marker: str) -> Column:
        longer = "|".join(re.escape(m) for m in markers if m == marker or _begins(m, marker, ignore_case))
        pattern = F.lit(f"{flags}^(?:{longer})$")
        return F.exists("_hits", lambda hit: F.rlike(hit, pattern))

    found = F.array_compact(F.array(*[F.when(held(marker), F.lit(marker)) for marker in markers]))
    none = F.array().cast("array<string>")
    return df.withColumn(name, F.when(F.size("_hits") > 0, found).otherwise(none)).drop("_hits")


def _begins(longer: str, marker: str, ignore_case: bool) -> bool:
    """Whether a marker is a whole word or phrase at the beginning of a longer one."""
    first = longer[: len(marker)]
    alike = first.casefold() == marker.casefold() if ignore_case else first == marker
    return len(longer) > len(marker) and alike and _is_word(longer[len(marker)]) != _is_word(marker[-1])


def longest_first(markers: list[str]) -> list[str]:
    return sorted(markers, key=len, reverse=True)


def without_markers(column: Column, markers: list[str]) -> Column:
    """Replace each marker by a blank, longest marker first.

    One search for all markers decides whether the replacements run at all, so
    most texts without markers are scanned once and not once per marker.
    """
    if not markers:
        return column
    cleaned = column
    for marker in longest_first(markers):
        cleaned = F.regexp_replace(cleaned, "(?iu)" + marker_pattern(marker), " ")
    return F.when(may_have_marker(column, markers), cleaned).otherwise(column)

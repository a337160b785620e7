"""Names, numbers as text, and lines of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The name of a stop without one, and how much of a name a report shows.
UNKNOWN = "Unknown"
NAME_WIDTH = 50

# How a required and an optional table are marked.
REQUIRED_MARK = "[R]"
OPTIONAL_MARK = "[O]"

# Blank characters in the Unicode sense, as a character class without the brackets.
BLANKS = r"\x09-\x0d\x1c-\x20\x{85}\p{Z}"


def name_or_unknown(name: Column) -> Column:
    """A missing or empty name becomes ``Unknown``."""
    return F.coalesce(F.nullif(name, F.lit("")), F.lit(UNKNOWN))


def clip(text: Column, width: int = NAME_WIDTH) -> Column:
    """The first ``width`` characters (code points)."""
    return F.substring(text, 1, width)


def one_decimal(value: Column) -> Column:
    """One decimal; a tie of the stored binary value goes to the even digit.

    ``format_number`` rounds the exact binary value half-even; ``format_string('%.1f')`` and ``bround`` both look at the
    shortest decimal form instead and differ on values such as 0.35.
    """
    return F.replace(F.format_number(value.cast("double"), 1), F.lit(","), F.lit(""))


def with_thousands(number: Column) -> Column:
    """An integer with commas between groups of three digits."""
    return F.format_number(number, 0)


def rank_label(rank: Column) -> Column:
    """A rank, right-aligned in two places."""
    return F.format_string("%2d", rank)


def title_case(text: Column) -> Column:
    """Each run of letters starts upper-case and goes on lower-case; ``stop_times`` becomes ``Stop_Times``."""
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def required_mark(required: Column) -> Column:
    return F.when(required, F.lit(REQUIRED_MARK)).otherwise(F.lit(OPTIONAL_MARK))


def lines_of(text: Column) -> Column:
    """The lines of a text as an array; a text without a line feed is one line."""
    return F.split(text, "\n")


def is_blank(line: Column) -> Column:
    return ~line.rlike(f"[^{BLANKS}]")


def has_fields(line: Column, at_least: int) -> Column:
    """Whether a line has that many runs of non-blank characters; looks no further than the last one needed."""
    if at_least < 1:
        raise ValueError("at_least must be positive")
    return line.rlike(f"^[{BLANKS}]*+(?:[^{BLANKS}]++[{BLANKS}]++){{{at_least - 1}}}[^{BLANKS}]")

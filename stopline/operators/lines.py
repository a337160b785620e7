"""Counting lines of a text column by what they look like."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from stopline.functions import text as forms
from stopline.functions.text import is_blank, lines_of


def count_lines(text: Column, keep: Callable[[Column], Column] | None = None) -> Column:
    """How many lines of a text satisfy a predicate.

    The lines stay inside their row: nothing is exploded, so nothing has to be grouped back together.
    """
    lines = lines_of(text)
    if keep is not None:
        lines = F.filter(lines, keep)
    return F.coalesce(F.size(lines).cast("bigint"), F.lit(0).cast("bigint"))


def has_content(line: Column) -> Column:
    return ~is_blank(line)


def lacks_prefix(prefix: str) -> Callable[[Column], Column]:
    """Lines with content that do not start with the prefix."""
    return lambda line: has_content(line) & ~F.startswith(line, F.lit(prefix))


def has_fields(at_least: int) -> Callable[[Column], Column]:
    """Lines with at least so many blank-separated fields."""
    return lambda line: forms.has_fields(line, at_least)

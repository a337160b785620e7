"""Paths and file sizes."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from stopline.functions.text import one_decimal

KIB = 1024
MIB = 1024 * 1024


def base_name(path: Column) -> Column:
    """What follows the last slash."""
    return F.substring_index(path, "/", -1)


def parent_path(path: Column) -> Column:
    """What precedes the last slash; empty when there is none."""
    kept = F.length(path) - F.length(base_name(path)) - 1
    return F.substr(path, F.lit(1), F.greatest(kept, F.lit(0)))


def without_prefix(path: Column, prefix: str) -> Column:
    """The path with every occurrence of the prefix text taken out."""
    return F.replace(path, F.lit(prefix), F.lit(""))


def day_path(day: Column, pattern: str) -> Column:
    """A path with a day's ``%Y``, ``%m`` and ``%d`` written into it; NULL for no day."""
    forms = {"%Y": "yyyy", "%m": "MM", "%d": "dd"}
    parts = [part for part in re.split("(%[Ymd])", pattern) if part]
    return F.concat(*(F.date_format(day, forms[part]) if part in forms else F.lit(part) for part in parts))


def to_bytes(text: Column) -> Column:
    """A size given as text; NULL when it is no integer."""
    return text.try_cast("bigint")


def size_label(n_bytes: Column) -> Column:
    """Bytes below 1 KiB as they are, else KB or MB with one decimal."""
    return (
        F.when(n_bytes < KIB, F.concat(n_bytes.cast("string"), F.lit(" B")))
        .when(n_bytes < MIB, F.concat(one_decimal(n_bytes / KIB), F.lit(" KB")))
        .when(n_bytes >= MIB, F.concat(one_decimal(n_bytes / MIB), F.lit(" MB")))
    )

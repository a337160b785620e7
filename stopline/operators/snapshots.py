"""Tagging rows with their snapshot day and putting days together."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopline.schemas import FEED_DATE


def tag_snapshot(rows: DataFrame, day: date) -> DataFrame:
    """Rows of one day's table with that day as ``feed_date``."""
    return rows.withColumn(FEED_DATE, F.lit(day))


def union_days(days: Iterable[DataFrame]) -> DataFrame:
    """All rows of all days. Columns are matched by name; a column that a day lacks is NULL there.

    Days are put together in pairs, and the pairs in pairs: one after the other, the columns would be matched anew for all
    days before, which takes the driver half a minute for two years.
    """
    done = list(days)
    while len(done) > 1:
        pairs = [done[i : i + 2] for i in range(0, len(done), 2)]
        done = [p[0].unionByName(p[1], allowMissingColumns=True) if len(p) == 2 else p[0] for p in pairs]
    return done[0]

"""Counts of any period from counts of its days, which are made once and kept beside the lake.

The rows of a day never change once it is landed, and counts of days add up to counts of periods. So a period that moves on
by a day reads one new day of facts, and of the others one row per key. A day's counts name the landing they were made from:
when the day is landed again, they no longer fit and are made anew.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stopline.operators.counts import rows_per_day
from stopline.period import Period
from stopline.schemas import FEED_DATE, SUMMARY_COLUMNS
from stopline.sinks.landing import land, read_landed, read_landed_days
from stopline.sinks.snapshots import live_entries

# The tables whose rows are counted, and by what.
COUNTED = {"stop_times": "stop_id", "trips": "route_id"}


def landed_schema(table: str) -> T.StructType:
    """The columns of a landed table that a summary uses."""
    return T.StructType([T.StructField(name, T.StringType()) for name in SUMMARY_COLUMNS[table]]).add(FEED_DATE, T.DateType())


def day_counts_path(lake: str, table: str) -> str:
    return f"{lake.rstrip('/')}_day_counts/{table}"


def keep_day_counts(spark: SparkSession, lake: str, period: Period) -> dict[str, list[date]]:
    """Count the days of a period that are landed but not counted since, and return them for each table."""
    done = {}
    for table, key in COUNTED.items():
        path, kept = f"{lake.rstrip('/')}/{table}", day_counts_path(lake, table)
        facts, counted = live_entries(spark, path), live_entries(spark, kept)
        days = [d for d in period if d in facts and (d not in counted or counted[d].source != facts[d].landing)]
        done[table] = days
        if days:
            rows = read_landed_days(spark, path, days, landed_schema(table))
            land(rows_per_day(rows, key), kept, "replace", sources={d: facts[d].landing for d in days})
    return done


def day_counts(spark: SparkSession, lake: str, table: str, period: Period) -> DataFrame:
    """``(feed_date, key, n_rows)`` of the days that :func:`keep_day_counts` has counted."""
    schema = T.StructType([T.StructField(COUNTED[table], T.StringType()), T.StructField("n_rows", T.LongType()), T.StructField(FEED_DATE, T.DateType())])
    return read_landed(spark, day_counts_path(lake, table), period, schema)

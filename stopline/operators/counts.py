"""Counting rows per stop, per route, per day and per table.

Every count groups with ``count(*)``, which Spark combines on the map side: what is shuffled is one row per key and task, so
a stop that holds a third of all rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopline.schemas import FEED_DATE


def visits_per_stop(visits: DataFrame, num_days: int) -> DataFrame:
    """``(stop_id, total_visits, avg_visits_per_day)``; rows without a stop form one group.

    A visit is a timetable row of a daily snapshot. The average is over all days of the period, whether or not the stop
    occurs on each.
    """
    if num_days < 1:
        raise ValueError("num_days must be at least 1")
    totals = visits.groupBy("stop_id").agg(F.count("*").alias("total_visits"))
    return _averaged(totals, num_days)


def visits_from_days(per_day: DataFrame, num_days: int) -> DataFrame:
    """:func:`visits_per_stop` from the output of :func:`rows_per_day` for ``stop_id``."""
    if num_days < 1:
        raise ValueError("num_days must be at least 1")
    return _averaged(merged_days(per_day, "stop_id", "total_visits"), num_days)


def _averaged(totals: DataFrame, num_days: int) -> DataFrame:
    return totals.withColumn("avg_visits_per_day", F.col("total_visits") / F.lit(num_days))


def rows_per_day(rows: DataFrame, key: str) -> DataFrame:
    """``(feed_date, key, n_rows)``: partial counts that :func:`merged_days` makes counts of any days of."""
    return rows.groupBy(FEED_DATE, key).agg(F.count("*").alias("n_rows"))


def merged_days(per_day: DataFrame, key: str, name: str) -> DataFrame:
    """``(key, name)``: the rows of each key over all days, from the output of :func:`rows_per_day`."""
    return per_day.groupBy(key).agg(F.sum("n_rows").alias(name))


def trips_per_route(trips: DataFrame) -> DataFrame:
    """``(route_id, trip_count)``; a trip in several snapshots counts once in each, trips without a route form one group."""
    return trips.groupBy("route_id").agg(F.count("*").alias("trip_count"))


def single_trip_routes(per_route: DataFrame) -> DataFrame:
    """Routes with exactly one trip row in the whole period."""
    return per_route.filter(F.col("trip_count") == 1)


def route_stats(per_route: DataFrame) -> DataFrame:
    """One row ``(total_routes, avg_trips_per_route, single_trip_routes)`` from one pass; the average of nothing is NULL."""
    return per_route.agg(
        F.count("*").alias("total_routes"),
        F.avg("trip_count").alias("avg_trips_per_route"),
        F.count_if(F.col("trip_count") == 1).alias("single_trip_routes"),
    )


def records_per_day(rows: DataFrame) -> DataFrame:
    """``(feed_date, n_records)``."""
    return rows.groupBy(FEED_DATE).agg(F.count("*").alias("n_records"))


def days_loaded(per_day: DataFrame) -> DataFrame:
    """One row ``(n_days, n_records)`` from the output of :func:`records_per_day`."""
    return per_day.agg(
        F.count(FEED_DATE).alias("n_days"),
        F.coalesce(F.sum("n_records"), F.lit(0)).alias("n_records"),
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, n_records)`` for all tables in one job; on Parquet only file footers are read."""
    counted = (
        rows.agg(F.count("*").alias("n_records")).select(F.lit(name).alias("table_name"), "n_records")
        for name, rows in tables.items()
    )
    return reduce(DataFrame.unionByName, counted)

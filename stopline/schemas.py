"""Canonical tables, the feed manifest and the shape of the result document."""

from __future__ import annotations

from pyspark.sql import types as T

# The day of the snapshot a row came from; the partition column of every landed table.
FEED_DATE = "feed_date"

# The five feed tables a summary is made from, and the columns it uses of each.
SUMMARY_COLUMNS = {
    "agency": (),
    "routes": (),
    "stops": ("stop_id", "stop_name"),
    "trips": ("route_id",),
    "stop_times": ("stop_id",),
}
SUMMARY_TABLES = tuple(SUMMARY_COLUMNS)

# Tables a daily feed must have, and tables it may have.
FEED_MANIFEST = (
    ("agency", True),
    ("routes", True),
    ("trips", True),
    ("stops", True),
    ("stop_times", True),
    ("calendar", True),
    ("calendar_dates", False),
    ("shapes", False),
    ("frequencies", False),
    ("transfers", False),
    ("feed_info", False),
)

# The tables of a feed that are landed.
LANDED_TABLES = (
    "agency",
    "routes",
    "stops",
    "trips",
    "stop_times",
    "calendar",
    "calendar_dates",
    "feed_info",
    "transfers",
)

# Fixed value: both stop lists hold at most this many entries.
LIST_SIZE = 30

_STOP_ENTRY = T.StructType(
    [
        T.StructField("stop_id", T.StringType()),
        T.StructField("stop_name", T.StringType()),
        T.StructField("total_visits", T.LongType()),
        T.StructField("avg_visits_per_day", T.DoubleType()),
    ]
)

DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField(
            "period",
            T.StructType(
                [
                    T.StructField("start_date", T.StringType()),
                    T.StructField("end_date", T.StringType()),
                    T.StructField("num_days", T.IntegerType()),
                ]
            ),
        ),
        T.StructField(
            "counts",
            T.StructType([T.StructField(name, T.LongType()) for name in SUMMARY_TABLES]),
        ),
        T.StructField("top_stops", T.ArrayType(_STOP_ENTRY)),
        T.StructField("least_stops", T.ArrayType(_STOP_ENTRY)),
        T.StructField(
            "route_stats",
            T.StructType(
                [
                    T.StructField("total_routes", T.LongType()),
                    T.StructField("avg_trips_per_route", T.DoubleType()),
                    T.StructField("single_trip_routes", T.LongType()),
                ]
            ),
        ),
            # Days of the period that each table has, where that is known: tables landed in a lake.
        T.StructField("days_loaded", T.StructType([T.StructField(name, T.LongType()) for name in SUMMARY_TABLES])),
    ]
)

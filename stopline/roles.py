"""The test tables in the roles of feed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopline.period import Period
from stopline.schemas import FEED_DATE

# All days that the tables have.
EVENT_PERIOD = Period.parse("2024-01-01", "2024-01-30")
ORDER_PERIOD = Period.parse("1995-01-01", "2001-12-31")

# The fortnight used where cutting a period out of a longer history is the point.
FORTNIGHT = Period.parse("2024-01-01", "2024-01-14")

# Event types in the role of landed tables; no event has the last one.
EVENT_MANIFEST = (("view", True), ("click", True), ("purchase", True), ("signup", False), ("refund", False))

# Order priorities in the role of feed tables; no order has the last one.
PRIORITY_MANIFEST = (
    ("1-URGENT", True),
    ("2-HIGH", True),
    ("3-MEDIUM", True),
    ("4-NOT SPECIFIED", False),
    ("5-LOW", False),
    ("6-UNUSED", False),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_visits(spark: SparkSession, sf_dir: str, period: Period | None = EVENT_PERIOD) -> DataFrame:
    """Events as timetable rows, of all days if no period is given: each user is a stop."""
    events = table(spark, sf_dir, "events")
    rows = events if period is None else events.filter(period.has_time(events.ts))
    return rows.select(F.to_date("ts").alias(FEED_DATE), F.col("user_id").alias("stop_id"))


def event_visits_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, but error events belong to no stop."""
    events = table(spark, sf_dir, "events")
    stop = F.when(F.col("event_type") != "error", F.col("user_id"))
    return events.filter(EVENT_PERIOD.has_time(events.ts)).select(F.to_date("ts").alias(FEED_DATE), stop.alias("stop_id"))


def supplier_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as stops for events: a third of the users have none, and some names are empty or NULL."""
    name = (
        F.when(F.col("s_acctbal") < 0, F.lit(""))
        .when(F.col("s_nationkey") == 7, F.lit(None).cast("string"))
        .otherwise(F.col("s_name"))
    )
    return table(spark, sf_dir, "supplier").select(
        F.lit(EVENT_PERIOD.end).alias(FEED_DATE), F.col("s_suppkey").alias("stop_id"), name.alias("stop_name")
    )


def lineitem_visits(spark: SparkSession, sf_dir: str, period: Period | None = ORDER_PERIOD) -> DataFrame:
    """Line items as timetable rows, of all days if no period is given: each part is a stop."""
    items = table(spark, sf_dir, "lineitem")
    rows = items if period is None else items.filter(period.has_time(items.l_shipdate))
    return rows.select(F.to_date("l_shipdate").alias(FEED_DATE), F.col("l_partkey").alias("stop_id"))


def part_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.lit(ORDER_PERIOD.end).alias(FEED_DATE), F.col("p_partkey").alias("stop_id"), F.col("p_name").alias("stop_name")
    )


def lineitem_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as trips: each order is a route."""
    return table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias(FEED_DATE), F.col("l_orderkey").alias("route_id")
    )


def order_feed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as rows of feed tables: the priority names the table, the order date is the day."""
    return table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias(FEED_DATE), F.col("o_orderpriority").alias("table_name")
    )


def summary_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five summary tables, with events as timetable rows."""
    return {
        "agency": table(spark, sf_dir, "nation"),
        "routes": table(spark, sf_dir, "orders"),
        "stops": supplier_stops(spark, sf_dir),
        "trips": lineitem_trips(spark, sf_dir),
        "stop_times": event_visits(spark, sf_dir),
    }

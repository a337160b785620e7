"""The summary of a period: counts, both stop lists and route statistics."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopline.operators.counts import merged_days, route_stats, table_counts, trips_per_route, visits_from_days, visits_per_stop
from stopline.operators.quality import completeness, expected_tables
from stopline.operators.ranking import named_lists
from stopline.period import Period
from stopline.plans.rolling import day_counts, keep_day_counts, landed_schema
from stopline.schemas import (
    DOCUMENT_SCHEMA,
    FEED_DATE,
    FEED_MANIFEST,
    LANDED_TABLES,
    LIST_SIZE,
    SUMMARY_TABLES,
)
from stopline.sinks.landing import land, landed_records, present_days, read_landed
from stopline.sinks.reports import report_lines, result_path, write_document, write_report
from stopline.sources.archives import archive_path, open_archives
from stopline.sources.documents import read_document
from stopline.sources.feed_csv import read_feed_history

_STOP_FIELDS = DOCUMENT_SCHEMA["top_stops"].dataType.elementType.names


def summary_document(tables: Mapping[str, DataFrame], period: Period, k: int = LIST_SIZE) -> DataFrame:
    """The result document as one nested row.

    ``tables`` holds the five summary tables of the period. Timetable rows and trips are each grouped once; their totals are
    the sums of the groups, so neither table is scanned a second time for its count. Every part is a row or two lists of
    at most ``k`` stops by the time the parts are put together.
    """
    per_stop = visits_per_stop(tables["stop_times"], period.num_days)
    per_route = trips_per_route(tables["trips"])
    small = table_counts({name: tables[name] for name in ("agency", "routes", "stops")})
    return _document(small, per_stop, per_route, tables["stops"], period, k, None)


def lake_document(spark: SparkSession, lake: str, period: Period, k: int = LIST_SIZE) -> DataFrame:
    """The same document of landed tables, with the days that each of them has.

    Visits and trips come from the counts of their days (:mod:`stopline.plans.rolling`), so facts are read for days that have
    none yet, and the counts and days of the other tables from their manifests.
    """
    keep_day_counts(spark, lake, period)
    records = {name: landed_records(spark, f"{lake.rstrip('/')}/{name}", period) for name in SUMMARY_TABLES}
    small = spark.createDataFrame(
        [(name, sum(records[name].values())) for name in ("agency", "routes", "stops")], "table_name STRING, n_records BIGINT"
    )
    per_stop = visits_from_days(day_counts(spark, lake, "stop_times", period), period.num_days)
    per_route = merged_days(day_counts(spark, lake, "trips", period), "route_id", "trip_count")
    days = {name: len(found) for name, found in records.items()}
    return _document(small, per_stop, per_route, landed_table(spark, lake, "stops", period), period, k, days)


def _document(
    small: DataFrame, per_stop: DataFrame, per_route: DataFrame, stops: DataFrame, period: Period, k: int, days: Mapping[str, int] | None
) -> DataFrame:
    totals = [
        grouped.agg(F.coalesce(F.sum(column), F.lit(0)).alias("n_records")).withColumn("table_name", F.lit(name))
        for name, grouped, column in (
            ("trips", per_route, "trip_count"),
            ("stop_times", per_stop, "total_visits"),
        )
    ]
    counted = reduce(DataFrame.unionByName, totals, small)

    lists = named_lists(per_stop, stops, k).select(
        "list_name",
        F.struct("rank", *[F.col(name).cast(_stop_type(name)).alias(name) for name in _STOP_FIELDS]).alias("entry"),
    )
    stats = route_stats(per_route).select(F.struct("*").alias("route_stats"))

    parts = counted.unionByName(lists, allowMissingColumns=True).unionByName(stats, allowMissingColumns=True)
    loaded = F.lit(None) if days is None else F.struct(*[F.lit(days[name]).alias(name) for name in SUMMARY_TABLES])
    return parts.agg(
        F.struct(*[_count_of(name).alias(name) for name in SUMMARY_TABLES]).alias("counts"),
        _list_of("top_stops").alias("top_stops"),
        _list_of("least_stops").alias("least_stops"),
        F.first("route_stats", ignorenulls=True).alias("route_stats"),
    ).select(
        F.struct(
            F.lit(period.start.isoformat()).alias("start_date"),
            F.lit(period.end.isoformat()).alias("end_date"),
            F.lit(period.num_days).alias("num_days"),
        ).alias("period"),
        *[name for name in DOCUMENT_SCHEMA.names if name not in ("period", "days_loaded")],
        loaded.cast(DOCUMENT_SCHEMA["days_loaded"].dataType).alias("days_loaded"),
    )


def _stop_type(name: str):
    return DOCUMENT_SCHEMA["top_stops"].dataType.elementType[name].dataType


def _count_of(table: str):
    return F.max(F.when(F.col("table_name") == table, F.col("n_records")))


def _list_of(name: str):
    ranked = F.sort_array(F.collect_list(F.when(F.col("list_name") == name, F.col("entry"))))
    return F.transform(ranked, lambda entry: F.struct(*[entry[field].alias(field) for field in _STOP_FIELDS]))


def land_feeds(spark: SparkSession, feed_root: str, lake: str, period: Period, landed_days: str = "keep") -> None:
    """Land all columns of the tables of each day's CSV directory under ``lake``; those a summary uses must be there."""
    for table, path, days in _to_land(spark, lake, period, landed_days):
        rows = read_feed_history(spark, feed_root, days, table, optional=table not in SUMMARY_TABLES)
        if rows is not None:
            land(rows, path, landed_days, day_by_day=True)


def land_archives(spark: SparkSession, archive_root: str, lake: str, period: Period, landed_days: str = "keep") -> None:
    """The same from each day's zip archive. Archives of days that are not landed yet are opened, once for all tables."""
    tables = list(_to_land(spark, lake, period, landed_days))
    days = sorted({day for _, _, missing in tables for day in missing})
    if not days:
        return
    optional = [table for table in LANDED_TABLES if table not in SUMMARY_TABLES]
    opened = open_archives(spark, [archive_path(archive_root, day) for day in days], [table for table, _, _ in tables], optional)
    for table, path, missing in tables:
        rows = opened.table(table, days=missing)
        if rows.columns != [FEED_DATE]:  # no archive has the table
            land(rows, path, landed_days, day_by_day=True)


def _to_land(spark: SparkSession, lake: str, period: Period, landed_days: str) -> Iterator[tuple[str, str, list[date]]]:
    """Each table with its path and the days to read: with ``keep`` those that are not there yet."""
    for table in LANDED_TABLES:
        path = f"{lake.rstrip('/')}/{table}"
        there = present_days(spark, path) if landed_days == "keep" else set()
        if days := [day for day in period if day not in there]:
            yield table, path, days


def landed_tables(spark: SparkSession, lake: str, period: Period) -> dict[str, DataFrame]:
    """The summary tables of the days of a period, with just the columns a summary uses."""
    return {table: landed_table(spark, lake, table, period) for table in SUMMARY_TABLES}


def landed_table(spark: SparkSession, lake: str, table: str, period: Period) -> DataFrame:
    return read_landed(spark, f"{lake.rstrip('/')}/{table}", period, landed_schema(table))


def lake_completeness(
    spark: SparkSession, lake: str, period: Period, manifest: Sequence[tuple[str, bool]] = FEED_MANIFEST
) -> DataFrame:
    """:func:`completeness` of the tables landed under ``lake``; a day whose landing was not finished has no rows.

    It reads the manifests of the landings, a row for each table and day, and no data.
    """
    found = [
        (day, table, n)
        for table, _ in manifest
        for day, n in landed_records(spark, f"{lake.rstrip('/')}/{table}", period).items()
    ]
    observed = spark.createDataFrame(found, f"{FEED_DATE} DATE, table_name STRING, n_records BIGINT")
    return completeness(expected_tables(period.days(spark), manifest), observed)


def run_summary(
    spark: SparkSession,
    lake: str,
    period: Period,
    output: str,
    made_at: datetime,
    k: int = LIST_SIZE,
    allow_gaps: bool = False,
    days_in_report: bool = False,
) -> DataFrame:
    """Summarise landed tables, write document and report, and return the saved document.

    A day that a table lacks would only make its averages smaller, so it is an error unless gaps are allowed. The document
    says how many days each table has; the report does if asked.
    """
    for table in SUMMARY_TABLES if not allow_gaps else ():
        there = present_days(spark, f"{lake.rstrip('/')}/{table}")
        if gaps := [day.isoformat() for day in period if day not in there]:
            raise ValueError(f"{table} has no rows of {', '.join(gaps)}")
    path = result_path(output, made_at, "json")
    write_document(lake_document(spark, lake, period, k), path)
    document = read_document(spark, path)
    write_report(report_lines(document, made_at, k, days_in_report), result_path(output, made_at, "txt"))
    return document

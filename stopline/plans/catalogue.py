"""Every query of the engine on the test tables. Each takes ``(spark, sf_dir)`` and returns a DataFrame."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator
from datetime import date, datetime

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopline import roles
from stopline.functions import dates, paths, text
from stopline.operators import counts, dimensions, lines, quality, ranking, snapshots
from stopline.period import Period
from stopline.plans import rolling
from stopline.plans.summary import lake_completeness, lake_document, summary_document
from stopline.roles import EVENT_MANIFEST, EVENT_PERIOD, FORTNIGHT, ORDER_PERIOD, PRIORITY_MANIFEST
from stopline.schemas import FEED_DATE, LIST_SIZE, SUMMARY_TABLES
from stopline.scratch import run_folder
from stopline.sinks import landing, reports
from stopline.sources import archives, documents, feed_csv, inventory

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# The fortnight moved on by a day.
MOVED = Period.parse("2024-01-02", "2024-01-15")

# The moment a report says it was made; a parameter, so that the same input gives the same report.
MADE_AT = datetime(2024, 2, 1, 8, 30)

# Where archives, feeds and datasets are in the queries that name them.
ARCHIVE_BASE, FEED_BASE, DATASET_BASE = "https://feeds.example.org/gtfs", "/feeds", "/data"

# How :func:`size_label` writes a size.
SIZE_LABEL = r"^\d+ B$|^\d+\.\d (KB|MB)$"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- sources -------------------------------------------------------------------------------------------------------


@query
def csv_feed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as the ``stops`` table of one day's CSV feed and read back, every column a string."""
    root = run_folder(spark, "csv-feed")
    day = EVENT_PERIOD.start
    roles.table(spark, sf_dir, "customer").write.options(**feed_csv.CSV_OPTIONS).csv(feed_csv.table_path(root, day, "stops"))
    return feed_csv.read_feed_day(spark, root, day, "stops")


@query
def csv_feed_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as daily CSV feeds whose header changes on the way: other column order, one column more."""
    rows = feed_csv.read_feed_period(spark, _changing_feed(spark, sf_dir), EVENT_PERIOD, "", **_DAY_FOLDERS)
    return rows.select(FEED_DATE, "event_id", "user_id", "event_type", "value")


@query
def csv_feed_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same feeds, the days of each header scanned together."""
    rows = feed_csv.read_feed_history(spark, _changing_feed(spark, sf_dir), EVENT_PERIOD, "", optional=True, **_DAY_FOLDERS)
    return rows.select(FEED_DATE, "event_id", "user_id", "event_type", "value")


_DAY_FOLDERS = {"day_directory": f"{FEED_DATE}=%Y-%m-%d", "table_file": ""}


def _changing_feed(spark: SparkSession, sf_dir: str) -> str:
    root = run_folder(spark, "csv-period")
    events = roles.table(spark, sf_dir, "events").withColumn(FEED_DATE, F.to_date("ts"))
    first_half = FORTNIGHT.has_time(events.ts)
    early = events.filter(first_half).select(FEED_DATE, "event_id", "user_id", "event_type")
    late = events.filter(~first_half).select(FEED_DATE, "event_type", "value", "user_id", "event_id")
    for part in (early, late):
        part.hint("rebalance", FEED_DATE).write.partitionBy(FEED_DATE).options(**feed_csv.CSV_OPTIONS).mode("append").csv(root)
    return root


@query
def archive_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders packed into zip archives, expanded to lines, and the lines parsed as CSV."""
    expanded = archives.archive_lines(spark, _zipped_orders(spark, sf_dir)).filter("line_no > 0")
    fields = F.from_csv(
        "line",
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate DATE, o_orderpriority STRING",
    )
    archive = paths.base_name(F.col("archive"))
    return expanded.select(archive.alias("archive_name"), "member", fields.alias("row")).select("archive_name", "member", "row.*")


@query
def archive_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table read out of the same archives by column name; the last column is in none of them."""
    columns = ["o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority", "o_totalprice", "trip_headsign"]
    rows = archives.archived_table(spark, _zipped_orders(spark, sf_dir), "trips", columns)
    return rows.withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


def _zipped_orders(spark: SparkSession, sf_dir: str) -> str:
    """Orders as zip archives with one CSV member, named by their year's first day, and their folder.

    The tasks that read the orders write them, each batch in folders of its own.
    """
    root = run_folder(spark, "archives")
    uri = root if "://" in root else f"file://{root.removeprefix('file:')}"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import csv, fs

        store, folder = fs.FileSystem.from_uri(uri)
        for batch in batches:
            years = pc.year(batch["o_orderdate"])
            for year in pc.unique(years).to_pylist():
                rows = batch.filter(pc.is_null(years) if year is None else pc.equal(years, year))
                buffer = io.BytesIO()
                with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive, archive.open("trips.txt", "w") as member:
                    csv.write_csv(rows, member)
                inner = f"{folder}/{rows['o_orderkey'][0]}"
                store.create_dir(inner)
                path = f"{inner}/undated.zip" if year is None else archives.archive_path(inner, date(year, 1, 1))
                with store.open_output_stream(path) as file:
                    file.write(buffer.getvalue())
                yield pa.RecordBatch.from_arrays([pa.array([path])], names=["path"])

    orders = roles.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate"), "o_orderpriority"
    )
    orders.mapInArrow(pack, "path string").write.format("noop").mode("overwrite").save()
    return root


@query
def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed by day as a table of a monthly dataset, and the records in the files of each day."""
    files = inventory.file_inventory(spark, _event_lake(spark, sf_dir))
    named = F.endswith("path", F.concat(F.lit("/"), "file_name")) & F.col("file_name").rlike("^part-[^/]*[.]parquet$")
    return files.groupBy("dataset", FEED_DATE).agg(
        F.sum("n_records").alias("n_records"),
        F.bool_and(F.col("length") > 0).alias("all_have_bytes"),
        F.bool_and(named).alias("all_named"),
        F.bool_and(F.col("size_label").rlike(SIZE_LABEL)).alias("all_labelled"),
    )


@query
def dataset_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same dataset as a whole: a file for each day at least, and a readable size."""
    totals = inventory.dataset_totals(inventory.file_inventory(spark, _event_lake(spark, sf_dir)))
    enough = (F.col("n_files") >= EVENT_PERIOD.num_days) & (F.col("n_bytes") > 0)
    return totals.select(
        "dataset", "n_records", enough.alias("files_for_all_days"), F.col("size_label").rlike(SIZE_LABEL).alias("labelled")
    )


def _event_lake(spark: SparkSession, sf_dir: str) -> str:
    lake = run_folder(spark, "lake")
    month = landing.dataset_path(lake, EVENT_PERIOD.start)
    landing.land(roles.table(spark, sf_dir, "events").withColumn(FEED_DATE, F.to_date("ts")), f"{month}/events")
    return lake


# --- period and union ----------------------------------------------------------------------------------------------


@query
def period_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The period each event type spans, one row per day of it."""
    spans = roles.table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.date_format(F.min("ts"), "yyyy-MM-dd").alias("first_text"),
        F.date_format(F.max("ts"), "yyyy-MM-dd").alias("last_text"),
    )
    start, end = dates.parse_day(F.col("first_text")), dates.parse_day(F.col("last_text"))
    return spans.select(
        "event_type",
        dates.day_count(start, end).alias("num_days"),
        F.posexplode(dates.days_between(start, end)).alias("at", FEED_DATE),
    ).select(
        "event_type",
        "num_days",
        (F.col("at") + 1).cast("bigint").alias("day_no"),
        FEED_DATE,
        dates.feed_key(F.col(FEED_DATE)).alias("feed_key"),
        dates.month_key(F.col(FEED_DATE)).alias("month_key"),
        dates.next_day(F.col(FEED_DATE)).alias("next_day"),
    )


@query
def period_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive address, path of a table and monthly dataset of each day that has events."""
    day = F.col(FEED_DATE)
    return counts.records_per_day(roles.event_visits(spark, sf_dir, None)).select(
        FEED_DATE,
        paths.day_path(day, f"{ARCHIVE_BASE}/{archives.ARCHIVE_FILE}").alias("archive_url"),
        paths.day_path(day, f"{FEED_BASE}/{feed_csv.DAY_DIRECTORY}/{feed_csv.TABLE_FILE.format(table='stops')}").alias("table_path"),
        paths.day_path(day, f"{DATASET_BASE}/%Y-%m/gtfs").alias("dataset_path"),
        "n_records",
    )


@query
def daily_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed by day; each day read from its own directory, tagged with the day, all days put together."""
    path = run_folder(spark, "daily")
    events = roles.table(spark, sf_dir, "events").withColumn(FEED_DATE, F.to_date("ts"))
    landing.land(events.select(FEED_DATE, "user_id"), path)
    days = (
        snapshots.tag_snapshot(spark.read.schema("user_id BIGINT").parquet(f"{path}/{FEED_DATE}={day}"), day)
        for day in sorted(landing.present_days(spark, path))
    )
    return counts.records_per_day(snapshots.union_days(days))


@query
def union_evolving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earlier days lack a column and later days have another column order."""
    events = roles.table(spark, sf_dir, "events")
    early = events.filter(FORTNIGHT.has_time(events.ts)).select("event_id", "user_id")
    late = events.filter(~FORTNIGHT.has_time(events.ts)).select("value", "user_id", "event_id")
    return snapshots.union_days([early, late]).select("event_id", "user_id", "value")


@query
def land_and_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events landed by day, then the fortnight read back from its directories alone."""
    path = run_folder(spark, "landed")
    rows = roles.table(spark, sf_dir, "events").withColumn(FEED_DATE, F.to_date("ts"))
    landing.land(rows.select(FEED_DATE, "event_id", "user_id"), path, landed_days="fail")
    return landing.read_landed(spark, path, FORTNIGHT, f"event_id BIGINT, user_id BIGINT, {FEED_DATE} DATE")


# --- aggregates ----------------------------------------------------------------------------------------------------


def _event_feed(spark: SparkSession, sf_dir: str) -> str:
    """Events landed as the five summary tables: all are timetable rows and trips, those of three types other tables."""
    lake = run_folder(spark, "event-feed")
    events = roles.table(spark, sf_dir, "events")
    user = F.col("user_id").cast("string")
    stop = F.when(F.col("event_type") != "error", user)
    rows = events.select(F.to_date("ts").alias(FEED_DATE), "event_type", user.alias("user"), stop.alias("stop_id"))
    tables = {
        "agency": rows.filter("event_type = 'signup'").select(FEED_DATE, F.col("user").alias("agency_id")),
        "routes": rows.filter("event_type = 'click'").select(FEED_DATE, F.col("user").alias("route_id")),
        "stops": rows.filter("event_type = 'purchase'").select(FEED_DATE, F.col("user").alias("stop_id"), F.concat(F.lit("Stop "), "user").alias("stop_name")),
        "trips": rows.select(FEED_DATE, F.col("user").alias("route_id")),
        "stop_times": rows.select(FEED_DATE, "stop_id"),
    }
    for name, table in tables.items():
        landing.land(table, f"{lake}/{name}")
    return lake


@query
def rolling_stop_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits of a fortnight that has moved on by a day: its last day is counted, the others' counts are there."""
    lake = _event_feed(spark, sf_dir)
    for period in (FORTNIGHT, MOVED):
        rolling.keep_day_counts(spark, lake, period)
    return counts.visits_from_days(rolling.day_counts(spark, lake, "stop_times", MOVED), MOVED.num_days)


@query
def lake_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, days and route statistics of the document of a landed lake, as flat columns."""
    document = lake_document(spark, _event_feed(spark, sf_dir), EVENT_PERIOD)
    days = [F.col(f"days_loaded.{name}").alias(f"{name}_days") for name in SUMMARY_TABLES]
    return document.select("period.*", "counts.*", *days, "route_stats.*")


@query
def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("region", "nation", "customer", "orders", "lineitem")
    return counts.table_counts({name: roles.table(spark, sf_dir, name) for name in names})


@query
def stop_visit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.visits_per_stop(roles.event_visits(spark, sf_dir), EVENT_PERIOD.num_days)


@query
def route_trip_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.trips_per_route(roles.lineitem_trips(spark, sf_dir))


@query
def single_trip_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.single_trip_routes(counts.trips_per_route(roles.lineitem_trips(spark, sf_dir)))


@query
def route_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.route_stats(counts.trips_per_route(roles.lineitem_trips(spark, sf_dir)))


@query
def route_stats_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as trips of their user's route; error events have no route and count as one."""
    trips = roles.event_visits_with_gaps(spark, sf_dir).withColumnRenamed("stop_id", "route_id")
    return counts.route_stats(counts.trips_per_route(trips))


@query
def feed_day_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.records_per_day(roles.event_visits(spark, sf_dir, None))


@query
def days_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.days_loaded(counts.records_per_day(roles.lineitem_visits(spark, sf_dir, None)))


@query
def latest_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's newest order."""
    orders = roles.table(spark, sf_dir, "orders").withColumn(FEED_DATE, F.to_date("o_orderdate"))
    return dimensions.latest_snapshot(
        orders, "o_custkey", [FEED_DATE, "o_orderkey", "o_orderpriority"], [FEED_DATE, "o_orderkey"]
    )


# --- stop lists ----------------------------------------------------------------------------------------------------


@query
def stop_visits_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stops with names, among them unknown stops, empty names and visits without a stop."""
    visits = counts.visits_per_stop(roles.event_visits_with_gaps(spark, sf_dir), EVENT_PERIOD.num_days)
    return ranking.with_names(visits, roles.supplier_stops(spark, sf_dir))


@query
def top_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = counts.visits_per_stop(roles.event_visits(spark, sf_dir), EVENT_PERIOD.num_days)
    return ranking.named_list(visits, roles.supplier_stops(spark, sf_dir), LIST_SIZE)


@query
def least_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = counts.visits_per_stop(roles.event_visits(spark, sf_dir), EVENT_PERIOD.num_days)
    return ranking.named_list(visits, roles.supplier_stops(spark, sf_dir), LIST_SIZE, ascending=True)


@query
def top_stops_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = counts.visits_per_stop(roles.lineitem_visits(spark, sf_dir), ORDER_PERIOD.num_days)
    return ranking.named_list(visits, roles.part_stops(spark, sf_dir), LIST_SIZE)


@query
def least_stops_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = counts.visits_per_stop(roles.lineitem_visits(spark, sf_dir), ORDER_PERIOD.num_days)
    return ranking.named_list(visits, roles.part_stops(spark, sf_dir), LIST_SIZE, ascending=True)


@query
def ranked_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both lists with the rank of each stop."""
    visits = counts.visits_per_stop(roles.event_visits_with_gaps(spark, sf_dir), EVENT_PERIOD.num_days)
    return ranking.named_lists(visits, roles.supplier_stops(spark, sf_dir), LIST_SIZE)


@query
def all_stops_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rank of every stop among all, not of a list's."""
    return ranking.ranked_stops(counts.visits_per_stop(roles.lineitem_visits(spark, sf_dir), ORDER_PERIOD.num_days))


@query
def long_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 000 least visited stops with names, all if there are fewer."""
    visits = counts.visits_per_stop(roles.lineitem_visits(spark, sf_dir), ORDER_PERIOD.num_days)
    return ranking.named_list(visits, roles.part_stops(spark, sf_dir), 50_000, ascending=True)


# --- completeness --------------------------------------------------------------------------------------------------


def _completeness_input(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    expected = quality.expected_tables(ORDER_PERIOD.days(spark), PRIORITY_MANIFEST)
    return expected, quality.observed_tables(roles.order_feed_rows(spark, sf_dir))


@query
def feed_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.completeness(*_completeness_input(spark, sf_dir))


@query
def feed_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(quality.completeness(*_completeness_input(spark, sf_dir)))


@query
def found_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.found_tables(*_completeness_input(spark, sf_dir))


@query
def missing_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_tables(*_completeness_input(spark, sf_dir))


@query
def lake_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed as a table per type, and which tables each day of that lake has."""
    lake = run_folder(spark, "typed-lake")
    events = roles.table(spark, sf_dir, "events").withColumn(FEED_DATE, F.to_date("ts"))
    for name in (*(name for name, _ in EVENT_MANIFEST), "error"):  # one that no manifest has is landed, too
        landing.land(events.filter(F.col("event_type") == name).select(FEED_DATE, "event_id"), f"{lake}/{name}")
    return lake_completeness(spark, lake, EVENT_PERIOD, EVENT_MANIFEST)


# --- text ----------------------------------------------------------------------------------------------------------


@query
def size_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document sizes, as text and back, with a readable form."""
    size = paths.to_bytes(F.col("n_chars").cast("string"))
    return roles.table(spark, sf_dir, "documents").select(
        "doc_id", size.alias("n_bytes"), paths.size_label(size).alias("size_label")
    )


@query
def source_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and total size of each language, with a readable form."""
    totals = roles.table(spark, sf_dir, "documents").groupBy("lang").agg(
        F.count("*").alias("n_files"), F.sum("n_chars").alias("n_bytes")
    )
    return totals.withColumn("size_label", paths.size_label(F.col("n_bytes")))


@query
def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return roles.table(spark, sf_dir, "pages").select(
        "page_id",
        paths.base_name(url).alias("base_name"),
        paths.parent_path(url).alias("parent_path"),
        paths.without_prefix(url, "https://").alias("without_prefix"),
    )


@query
def table_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order priority as a title-case label with its mark."""
    needed = [name for name, required in PRIORITY_MANIFEST if required]
    name = F.col("o_orderpriority")
    tables = roles.table(spark, sf_dir, "orders").groupBy(name).agg(F.count("*").alias("n_records"))
    return tables.select(
        text.title_case(name).alias("label"),
        text.required_mark(name.isin(needed)).alias("marker"),
        text.with_thousands(F.col("n_records")).alias("n_records_text"),
    )


@query
def line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.col("text")
    return roles.table(spark, sf_dir, "documents").select(
        "doc_id",
        lines.count_lines(body).alias("n_lines"),
        lines.count_lines(body, lines.has_content).alias("n_with_content"),
        lines.count_lines(body, lines.lacks_prefix("The")).alias("n_without_prefix"),
        lines.count_lines(body, lines.has_fields(8)).alias("n_with_fields"),
    )


# --- result document -----------------------------------------------------------------------------------------------


@query
def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and route statistics of the result document, as flat columns."""
    document = summary_document(roles.summary_tables(spark, sf_dir), EVENT_PERIOD)
    return document.select("period.*", "counts.*", "route_stats.*")


@query
def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report_lines(summary_document(roles.summary_tables(spark, sf_dir), EVENT_PERIOD), MADE_AT)


@query
def report_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report written as a text file and read back: how often each line occurs."""
    path = reports.result_path(run_folder(spark, "report"), MADE_AT, "txt")
    reports.write_report(report_lines(spark, sf_dir), path)
    return spark.read.text(path).groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n_lines"))


@query
def summary_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result document written as JSON, read back, and its lists as rows."""
    return documents.document_lists(_saved_document(spark, sf_dir))


@query
def result_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chart series of both lists of a saved document, one row per bar."""
    series = documents.chart_series(_saved_document(spark, sf_dir))
    bars = F.arrays_zip("stop_names", "avg_visits")
    return series.select("list_name", F.posexplode(bars).alias("at", "bar")).select(
        "list_name",
        (F.col("at") + 1).cast("bigint").alias("position"),
        F.col("bar.stop_names").alias("stop_name"),
        F.col("bar.avg_visits").alias("avg_visits_per_day"),
    )


def _saved_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = reports.result_path(run_folder(spark, "document"), MADE_AT, "json")
    reports.write_document(summary_document(roles.summary_tables(spark, sf_dir), EVENT_PERIOD), path)
    return documents.read_document(spark, path)

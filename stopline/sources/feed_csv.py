"""Daily feed tables as CSV: one directory per day, every column a string."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from datetime import date
from multiprocessing.pool import ThreadPool

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopline.operators.snapshots import tag_snapshot, union_days
from stopline.schemas import FEED_DATE
from stopline.sinks.snapshots import files_of
from stopline.sources.storage import can_open, lines_of, open_storage

# How the directory of a day and the file of a table are named.
DAY_DIRECTORY = "sweden-%Y%m%d"
TABLE_FILE = "{table}.txt"

# Feed files double a quote inside a quoted field.
CSV_OPTIONS = {"header": True, "escape": '"'}

_HEADERS_AT_ONCE = 16

# Names that Spark makes up for columns without one.
_UNNAMED = re.compile(r"_c\d+")


def table_path(
    root: str, day: date, table: str, day_directory: str = DAY_DIRECTORY, table_file: str = TABLE_FILE
) -> str:
    return f"{root.rstrip('/')}/{day.strftime(day_directory)}/{table_file.format(table=table)}"


def read_feed_period(
    spark: SparkSession, root: str, period: Iterable[date], table: str, optional: bool = False, **names: str
) -> DataFrame | None:
    """All days of one feed table, matched by column name, with ``feed_date`` added.

    Each day is a scan of its own. A scan over several files would map columns by position, under whichever header it saw
    first, and would have to work out the day of each row from its path, which takes as long as parsing the row. Columns a
    day lacks are NULL there. A day without the file is an error; of an optional table such days have no rows, and the
    result is None if there is none at all.
    """

    def read(day: date) -> DataFrame | None:
        try:
            return read_feed_day(spark, root, day, table, **names)
        except AnalysisException as error:
            if optional and error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    with ThreadPool(_HEADERS_AT_ONCE) as pool:  # Spark looks at a file's header as soon as the scan is defined
        days = [rows for rows in pool.map(read, period) if rows is not None]
    return union_days(days) if days else None


def read_feed_history(
    spark: SparkSession, root: str, period: Iterable[date], table: str, optional: bool = False, **names: str
) -> DataFrame | None:
    """The rows of :func:`read_feed_period` for many days: days are scanned together with all others of the same header.

    One job looks at the first line of every file, and the plan has a scan for each different header, however many days there
    are. The day of a row then comes from a broadcast list of the files, a row each. On stores that tasks cannot open by
    themselves it is :func:`read_feed_period`.
    """
    days = {table_path(root, day, table, **names): day for day in period}
    if not can_open(spark, root):
        return read_feed_period(spark, root, days.values(), table, optional, **names)
    there = files_of(spark, days)
    if missing := sorted(set(days) - set(there)):
        if not optional:
            raise FileNotFoundError(f"[PATH_NOT_FOUND] {missing[0]} and {len(missing) - 1} more")
        if not there:
            return None
    parts = _parts(spark, {path: (days[path], files) for path, files in there.items()})
    written = [(name, p["day"]) for p in parts for name in {p["file"], p["file"].replace("file:///", "file:/", 1)}]  # as Spark names local files
    named = spark.createDataFrame(written, f"_file STRING, {FEED_DATE} DATE")

    first: dict[date, dict] = {}
    for part in sorted(parts, key=lambda p: p["path"]):
        if part["header"] is not None:
            first.setdefault(part["day"], part)
    like = {part["header"]: part["path"] for part in first.values()}
    with ThreadPool(_HEADERS_AT_ONCE) as pool:
        schemas = dict(zip(like, pool.map(lambda path: spark.read.options(**CSV_OPTIONS).csv(path).schema, like.values()), strict=True))
    groups: dict[tuple[str, ...], list[str]] = {}
    for path in sorted(there):
        if days[path] in first:  # else there is no line in it
            groups.setdefault(tuple(schemas[first[days[path]]["header"]].names), []).append(path)
    scans = []
    for columns, paths in groups.items():
        schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
        reader = spark.read.options(**CSV_OPTIONS).schema(schema)
        if not any(map(_UNNAMED.fullmatch, columns)):
            reader = reader.option("enforceSchema", False)  # files whose header does not fit fail
        rows = reader.csv(paths).withColumn("_file", F.col("_metadata.file_path"))
        scans.append(rows.join(F.broadcast(named), "_file").drop("_file"))
    return union_days(scans) if scans else spark.createDataFrame([], f"{FEED_DATE} DATE")


def _parts(spark: SparkSession, days: dict[str, tuple[date, list[tuple[str, str]]]]) -> list[dict]:
    """Every file of these days, with its day and its first line with anything in it."""
    files = [(day, *file) for day, found in days.values() for file in found]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    listed = spark.createDataFrame(files, "day DATE, path STRING, file STRING").repartition(tasks)
    return [row.asDict() for row in listed.mapInArrow(_first_lines, "day DATE, path STRING, file STRING, header STRING").collect()]


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        headers = []
        for path in batch["path"].to_pylist():
            with open_storage(path) as file:
                headers.append(next(lines_of(file), None))
        yield batch.append_column("header", pa.array(headers, pa.string()))


def read_feed_day(spark: SparkSession, root: str, day: date, table: str, **names: str) -> DataFrame:
    """One day of one feed table, with ``feed_date`` added. ``names`` are those of :func:`table_path`."""
    path = table_path(root, day, table, **names)
    # The header of every file is compared with the first one, so a directory whose parts disagree fails instead of
    # shifting columns.
    rows = spark.read.options(**CSV_OPTIONS, enforceSchema=False).csv(path)
    if any(map(_UNNAMED.fullmatch, rows.columns)):
        rows = spark.read.options(**CSV_OPTIONS).schema(rows.schema).csv(path)
    return tag_snapshot(rows, day)

"""Daily feed archives: zip files with one CSV member per table.

A task only unzips: members become lines, and lines become columns by Spark's own CSV rules, so an archive gives the same
rows as its text in a directory. However many tables are asked for, each archive is opened once. How its members are then
read depends on the store alone. Where the store can be opened from a task, the one look at an archive finds the place and
the header of every member, and a Python data source makes each member a task that streams just its bytes from there. From
any other store Spark's ``binaryFile`` loads archives whole (up to its own limit of 2 GiB each); their lines are written out
once, by table, and the tables are read from that.
"""

from __future__ import annotations

import csv
import io
import json
import re
import struct
import zipfile
from collections.abc import Callable, Collection, Iterator, Sequence
from datetime import date, datetime
from itertools import chain, islice
from weakref import WeakSet

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from stopline.schemas import FEED_DATE
from stopline.scratch import run_folder
from stopline.sources.storage import can_open, lines_of, open_storage

# Fixed value: how the archive of a day is named.
ARCHIVE_FILE = "sweden-%Y%m%d.zip"

# Different headers that the archives of one table may have.
MAX_HEADERS = 1000

_LINES_AT_ONCE = 50_000

_LINES = T.StructType(
    [
        T.StructField("archive", T.StringType()),
        T.StructField("member", T.StringType()),
        T.StructField("line_no", T.LongType()),
        T.StructField("line", T.StringType()),
    ]
)

_ROWS = T.StructType(
    [
        T.StructField(FEED_DATE, T.DateType()),
        T.StructField("header", T.StringType()),
        T.StructField("line", T.StringType()),
    ]
)

# Where a member of an archive is, and how it begins.
_PLACES = T.StructType(
    [
        *(T.StructField(n, T.StringType()) for n in ("table_name", "archive", "member", "header")),
        *(T.StructField(n, T.LongType()) for n in ("offset", "method", "packed", "size", "crc")),
    ]
)

# From the path of an archive, the name of a member and its contents to columns.
Unpack = Callable[[str, str, zipfile.ZipExtFile], Iterator[dict[str, pa.Array]]]
Batches = Iterator[pa.RecordBatch]


def archive_path(root: str, day: date, archive_file: str = ARCHIVE_FILE) -> str:
    return f"{root.rstrip('/')}/{day.strftime(archive_file)}"


def archive_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(archive, member, line_no, line)`` of all members of the zip files at or under ``path``; lines count from 0."""
    files = _zip_files(spark, path)
    if not _streamed(spark, path):
        return files.select("path", "content").mapInArrow(_from_content(_read_lines), _LINES)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    members = files.select("path").repartition(tasks).mapInArrow(_list_members, "path string, member string")
    return members.repartition(tasks).mapInArrow(_from_storage(_read_lines), _LINES)


def archived_table(
    spark: SparkSession, path: str | list[str], table: str, columns: Sequence[str] | None = None, optional: bool = False
) -> DataFrame:
    """One table of :func:`open_archives`."""
    return open_archives(spark, path, [table], [table] if optional else []).table(table, columns)


def open_archives(spark: SparkSession, path: str | list[str], tables: Sequence[str], optional: Collection[str] = ()) -> Archives:
    """The zip files at or under ``path``, each opened once for all the tables. One without a table that is not optional is an error.

    From stores that tasks can open, what comes to the driver is a row for each member: a table of an archive, which is a day.
    """
    files = _zip_files(spark, path)
    if not _streamed(spark, path):
        folder = run_folder(spark, "archive-lines")
        rows = files.select("path", "content").mapInArrow(_all_lines(tables, optional), _STAGED)
        rows.write.partitionBy("table_name").parquet(folder)
        return _StagedLines(spark, spark.read.schema(_STAGED).parquet(folder))
    # Few short rows with much work behind each: a fixed number of partitions keeps adaptive execution from putting them
    # all into one task.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    places = files.select("path").repartition(tasks).mapInArrow(_find_members(tables, optional), _PLACES)
    return _MemberPlaces(spark, [row.asDict() for row in places.collect()])


class Archives:
    """Tables of opened archives. ``headers`` of a table are the different ones that its members have."""

    spark: SparkSession

    def headers(self, table: str) -> list[str]:
        raise NotImplementedError

    def lines(self, table: str, days: Collection[date] | None) -> DataFrame:
        """``(feed_date, header, line)`` without the header lines."""
        raise NotImplementedError

    def table(self, table: str, columns: Sequence[str] | None = None, days: Collection[date] | None = None) -> DataFrame:
        """The given columns of one table (else all) as strings, with ``feed_date``, of all archives or those of some days.

        Columns are found by each member's own header; one that a day lacks is NULL there. The day comes from the eight
        digits that end the archive's name; it is NULL where there are none.
        """
        headers = self.headers(table)
        if len(headers) > MAX_HEADERS:
            raise ValueError(f"{table}: more than {MAX_HEADERS} different headers")
        names = {header: next(csv.reader([header])) for header in headers}
        wanted = list(dict.fromkeys(n for header in headers for n in names[header])) if columns is None else list(columns)
        if not wanted:
            if columns is None:
                return self.spark.createDataFrame([], T.StructType([_ROWS[FEED_DATE]]))
            raise ValueError("name at least one column")

        def row(header: str) -> Column:
            fields = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(len(names[header]))])
            parsed = F.from_csv("line", fields.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), {"escape": '"'})
            place = {name: i for i, name in reversed(list(enumerate(names[header])))}
            none = F.lit(None).cast("string")
            return F.struct(*((parsed[f"_{place[n]}"] if n in place else none).alias(n) for n in wanted))

        rows = self.lines(table, days)
        if not headers:
            return rows.select(*(F.lit(None).cast("string").alias(n) for n in wanted), FEED_DATE)
        by_header = F.lit(None)
        for header in reversed(headers):
            by_header = F.when(F.col("header") == header, row(header)).otherwise(by_header)
        return rows.select(FEED_DATE, by_header.alias("row")).select("row.*", FEED_DATE)


class _MemberPlaces(Archives):
    """Members that tasks read from their places."""

    def __init__(self, spark: SparkSession, places: list[dict]) -> None:
        self.spark, self.places = spark, places

    def headers(self, table: str) -> list[str]:
        return sorted({p["header"] for p in self.places if p["table_name"] == table and p["header"] is not None})

    def lines(self, table: str, days: Collection[date] | None) -> DataFrame:
        mine = [p for p in self.places if p["table_name"] == table and (days is None or _archive_day(p["archive"]) in days)]
        if not mine:
            return self.spark.createDataFrame([], _ROWS)
        if self.spark not in _registered:
            self.spark.dataSource.register(MemberSource)
            _registered.add(self.spark)
        return self.spark.read.format(MemberSource.name()).option("places", json.dumps(mine)).load()


class _StagedLines(Archives):
    """Lines that were written out when the archives were opened; a member's first row has its header and no line."""

    def __init__(self, spark: SparkSession, rows: DataFrame) -> None:
        self.spark, self.rows = spark, rows

    def headers(self, table: str) -> list[str]:
        first = self.rows.filter((F.col("table_name") == table) & F.col("line").isNull() & F.col("header").isNotNull())
        return sorted(row["header"] for row in first.select("header").distinct().limit(MAX_HEADERS + 1).collect())

    def lines(self, table: str, days: Collection[date] | None) -> DataFrame:
        rows = self.rows.filter((F.col("table_name") == table) & F.col("line").isNotNull())
        return (rows if days is None else rows.filter(F.col(FEED_DATE).isin(*days))).select(*_ROWS.names)


_STAGED = T.StructType([*_ROWS.fields, T.StructField("table_name", T.StringType())])
_registered: WeakSet[SparkSession] = WeakSet()


class MemberSource(DataSource):
    """Members of zip archives at known places, as ``(feed_date, header, line)``: a partition each, longest first."""

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> T.StructType:
        return _ROWS

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _MemberReader(json.loads(self.options["places"]))


class _MemberReader(DataSourceReader):
    def __init__(self, places: list[dict]) -> None:
        self.places = places

    def partitions(self) -> Sequence[InputPartition]:
        return [InputPartition(place) for place in sorted(self.places, key=lambda p: -p["packed"])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        place = partition.value
        with open_storage(place["archive"]) as file, _member_at(file, place) as stream:
            yield from map(_batch, _read_rows(place["archive"], place["member"], stream))


def _member_at(file, place: dict) -> zipfile.ZipExtFile:
    """A member's contents, with no look at the archive's directory: only the few bytes before the member say where it starts."""
    file.seek(place["offset"])
    mark, name, extra = struct.unpack("<4s22x2H", file.read(30))
    if mark != b"PK\x03\x04":
        raise ValueError(f"{place['archive']} has changed since it was opened")
    file.seek(name + extra, 1)
    info = zipfile.ZipInfo(place["member"])
    info.compress_type, info.compress_size, info.file_size, info.CRC = place["method"], place["packed"], place["size"], place["crc"]
    return zipfile.ZipExtFile(file, "r", info)


def _zip_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").options(pathGlobFilter="*.[zZ][iI][pP]", recursiveFileLookup=True).load(path)


def _streamed(spark: SparkSession, path: str | list[str]) -> bool:
    return all(can_open(spark, p) for p in ([path] if isinstance(path, str) else path))


def _from_content(unpack: Unpack):
    def run(batches: Batches) -> Batches:
        for path, archive in _loaded(batches):
            for member in _members(archive):
                yield from _unpack_member(archive, path, member, unpack)

    return run


def _loaded(batches: Batches) -> Iterator[tuple[str, zipfile.ZipFile]]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as archive:
                yield path.as_py(), archive


def _list_members(batches: Batches) -> Batches:
    for batch in batches:
        for path in batch["path"].to_pylist():
            with open_storage(path) as file, zipfile.ZipFile(file) as archive:
                members = _members(archive)
            yield _batch({"path": pa.repeat(path, len(members)), "member": pa.array(members, pa.string())})


def _find_members(tables: Sequence[str], optional: Collection[str]):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for path in batch["path"].to_pylist():
                with open_storage(path) as file, zipfile.ZipFile(file) as archive:
                    found = [_place(archive, path, table, entry) for table, entry in _tables_in(archive, path, tables, optional)]
                yield pa.RecordBatch.from_pylist(found, schema=_PLACES_ARROW)

    return run


def _place(archive: zipfile.ZipFile, path: str, table: str, entry: zipfile.ZipInfo) -> dict:
    if entry.flag_bits & 1:
        raise ValueError(f"{entry.filename} of {path} is encrypted")
    with archive.open(entry) as stream:
        header = next(lines_of(stream), None)
    return dict(zip(_PLACES.names, (table, path, entry.filename, header, entry.header_offset, entry.compress_type, entry.compress_size, entry.file_size, entry.CRC), strict=True))


_PLACES_ARROW = pa.schema([(f.name, pa.string() if isinstance(f.dataType, T.StringType) else pa.int64()) for f in _PLACES])


def _all_lines(tables: Sequence[str], optional: Collection[str]):
    def run(batches: Batches) -> Batches:
        for path, archive in _loaded(batches):
            day = pa.scalar(_archive_day(path), pa.date32())
            for table, entry in _tables_in(archive, path, tables, optional):
                with archive.open(entry) as stream:
                    header = next(lines_of(stream), None)
                first = {FEED_DATE: pa.repeat(day, 1), "header": pa.array([header], pa.string()), "line": pa.array([None], pa.string())}
                with archive.open(entry) as stream:
                    for rows in chain([first], _read_rows(path, entry.filename, stream)):
                        yield _batch(rows | {"table_name": pa.repeat(table, len(rows["line"]))})

    return run


def _from_storage(unpack: Unpack):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for row in batch.to_pylist():
                with open_storage(row["path"]) as file, zipfile.ZipFile(file) as archive:
                    yield from _unpack_member(archive, row["path"], row["member"], unpack)

    return run


def _members(archive: zipfile.ZipFile) -> list[str]:
    return [entry.filename for entry in archive.infolist() if not entry.is_dir()]


def _tables_in(archive: zipfile.ZipFile, path: str, tables: Sequence[str], optional: Collection[str]) -> list[tuple[str, zipfile.ZipInfo]]:
    files = {f"{table}.txt": table for table in tables}
    entries = [(entry.filename.rsplit("/", 1)[-1], entry) for entry in archive.infolist() if not entry.is_dir()]
    found = [(files[name], entry) for name, entry in entries if name in files]
    if missing := sorted(set(tables) - set(optional) - {table for table, _ in found}):
        raise ValueError(f"{path} has no {', '.join(f'{table}.txt' for table in missing)}")
    return found


def _unpack_member(archive: zipfile.ZipFile, path: str, member: str, unpack: Unpack) -> Batches:
    with archive.open(member) as stream:
        yield from map(_batch, unpack(path, member, stream))


def _batch(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _archive_day(path: str) -> date | None:
    digits = re.search(r"(\d{8})\.zip$", path, re.IGNORECASE)
    try:
        return digits and datetime.strptime(digits[1], "%Y%m%d").date()
    except ValueError:
        return None


def _read_lines(path: str, member: str, stream: zipfile.ZipExtFile) -> Iterator[dict[str, pa.Array]]:
    text = io.TextIOWrapper(stream, encoding="utf-8-sig", errors="replace")
    start = 0
    while lines := [line.removesuffix("\n") for line in islice(text, _LINES_AT_ONCE)]:
        yield {
            "archive": pa.repeat(path, len(lines)),
            "member": pa.repeat(member, len(lines)),
            "line_no": pa.array(range(start, start + len(lines)), pa.int64()),
            "line": pa.array(lines, pa.string()),
        }
        start += len(lines)


def _read_rows(path: str, member: str, stream: zipfile.ZipExtFile) -> Iterator[dict[str, pa.Array]]:
    # The day and the header are the same for a whole member: cheaper to repeat than to take from the path of each row.
    day, text = pa.scalar(_archive_day(path), pa.date32()), lines_of(stream)
    header = next(text, None)
    while lines := list(islice(text, _LINES_AT_ONCE)):
        yield {FEED_DATE: pa.repeat(day, len(lines)), "header": pa.repeat(header, len(lines)), "line": pa.array(lines, pa.string())}

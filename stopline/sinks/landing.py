"""Landing feed tables as Parquet, one directory per feed day."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from datetime import date
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopline.period import Period
from stopline.schemas import FEED_DATE
from stopline.sinks.snapshots import Landed, entries, exists, live_entries, publish

# Fixed value: Spark's directory of rows without a partition value.
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def dataset_path(base: str, month: date, part: str = "gtfs") -> str:
    """``{base}/2025-10/gtfs``: where the landed tables, analytics or curated data of a month live."""
    return f"{base.rstrip('/')}/{month:%Y-%m}/{part}"


def land(
    rows: DataFrame, path: str, landed_days: str = "keep", day_by_day: bool = False, sources: Mapping[date, str] | None = None
) -> None:
    """Write a table with a ``feed_date`` column under ``path``.

    ``landed_days`` says what happens to days that are already there: ``keep`` leaves them and writes the others,
    ``replace`` puts these rows in place of those days, ``fail`` refuses to write to a path in use. Files carry the name of
    their landing, and a landing counts from the moment its manifest is published, which comes last: until then, and for
    ever if it dies before, :func:`read_landed` reads what was there before. ``sources``: see :class:`Landed`.

    Rows in any order are shuffled by day. The rebalance hint gives each day few files of even size and lets adaptive
    execution split a day that is much larger than the others over several tasks. Rows that come from files of one day
    each (``day_by_day``) are written where they are read: a task has one day, or a few small ones.
    """
    spark, day = rows.sparkSession, F.coalesce(F.col(FEED_DATE).cast("string"), F.lit(""))
    if landed_days not in ("keep", "replace", "fail"):
        raise ValueError(f"landed_days: {landed_days!r}")
    if landed_days == "fail" and exists(spark, path):
        raise FileExistsError(f"[PATH_ALREADY_EXISTS] {path}")
    if landed_days == "keep" and (there := [(e.day,) for e in entries(spark, path) if e.live]):
        kept = spark.createDataFrame(there, "landed_day STRING")  # a row for each calendar day
        rows = rows.join(F.broadcast(kept), day == F.col("landed_day"), "left_anti")
    if not day_by_day:
        rows = rows.hint("rebalance", FEED_DATE)
    # Above the shuffle: adaptive execution would drop an observation below one that turns out to have no rows.
    written, landing = Observation(), f"r{uuid4().hex[:16]}"
    rows = rows.observe(written, F.collect_set(day).alias("days"))
    rows.write.partitionBy(FEED_DATE).mode("append").option("mapreduce.output.basename", f"part-{landing}").parquet(path)
    if days := written.get["days"]:
        counted = _files(spark.read.schema(f"unread INT, {FEED_DATE} STRING"), path, days, {landing}).groupBy(FEED_DATE).count()
        counts = {found or "": n for found, n in counted.collect()}  # from the footers of the files just written
        by_day = {d.isoformat(): source for d, source in (sources or {}).items()}
        publish(spark, path, landing, counts, landed_days == "replace", by_day)


def read_landed(
    spark: SparkSession, path: str, period: Period | None = None, schema: T.StructType | str | None = None
) -> DataFrame:
    """A landed table; with a period, only the directories of its days are read.

    What is read comes from the table's manifest: files of landings that have not finished, or whose day was replaced, are
    not. Name the columns in ``schema`` where there are many files: otherwise the footers of all of them are looked at, to
    find columns that only some days have.
    """
    known = entries(spark, path)
    rows = _read(spark, path, known, [e for e in known if period is None or (e.day and period.start <= e.date <= period.end)], schema)
    return rows if period is None else rows.filter(period.has_day(rows[FEED_DATE]))


def read_landed_days(spark: SparkSession, path: str, days: Collection[date], schema: T.StructType | str) -> DataFrame:
    """The same for days that need not follow each other."""
    known = entries(spark, path)
    return _read(spark, path, known, [e for e in known if e.date in days], schema)


def _read(spark: SparkSession, path: str, known: list[Landed], asked: list[Landed], schema: T.StructType | str | None) -> DataFrame:
    live = [e for e in asked if e.live]
    if not live:
        if schema is not None:
            return spark.createDataFrame([], schema)
        live = asked = [e for e in known if e.live]
    if not live:
        raise FileNotFoundError(f"nothing is landed under {path}")
    reader = spark.read.option("mergeSchema", True) if schema is None else spark.read.schema(schema)
    landings = {e.landing for e in live}
    rows = _files(reader, path, [e.day for e in live], landings)
    if replaced := [e for e in asked if not e.live and e.landing in landings]:  # their landing still counts for other days
        rows = rows.filter(~F.concat_ws(" ", F.col(FEED_DATE).cast("string"), _landing_of()).isin([f"{e.day} {e.landing}" for e in replaced]))
    return rows


def present_days(spark: SparkSession, path: str) -> set[date]:
    """The days that are landed under ``path``."""
    return set(live_entries(spark, path))


def landed_records(spark: SparkSession, path: str, period: Period) -> dict[date, int]:
    """The landed days of a period with their records, from the manifest alone."""
    return {day: e.n_records for day, e in live_entries(spark, path).items() if period.start <= day <= period.end}


def _files(reader, path: str, days: list[str], landings: set[str]) -> DataFrame:
    """What some landings wrote for some days."""
    folders = [f"{path}/{FEED_DATE}={day or _NO_DAY}" for day in sorted(days)]
    names = f"part-{{{','.join(sorted(landings))}}}-*"
    return reader.options(basePath=path, pathGlobFilter=names).parquet(*folders)


def _landing_of():
    return F.split_part(F.col("_metadata.file_name"), F.lit("-"), F.lit(2))

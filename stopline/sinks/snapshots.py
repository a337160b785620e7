"""What a landed table consists of: for each day the landing whose files count, and how many records it brought.

A table has one manifest, a small Parquet file with a row for each calendar day, under ``_landed`` beside the days. Every
landing writes a new one and publishes it under the next number by one rename, which fails if the number is taken; readers
take the newest. So a landing is seen whole or not at all, whenever it dies. Where a store has no atomic rename (object
stores without it), two landings of one table must not run at once.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import astuple, dataclass
from datetime import date
from multiprocessing.pool import ThreadPool
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession
from pyspark.sql import types as T

# Beside the days; readers of Parquet pass over names with an underscore.
_MANIFESTS = "_landed"

# Questions to a store that are under way at a time.
_AT_ONCE = 16

# Manifests that stay behind the newest, for readers that have begun with one of them.
_KEPT = 20

_MANIFEST = T.StructType(
    [
        T.StructField("day", T.StringType()),
        T.StructField("landing", T.StringType()),
        T.StructField("n_records", T.LongType()),
        T.StructField("live", T.BooleanType()),
        T.StructField("source", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Landed:
    """A day (empty text: rows without one) that a landing brought. Files of landings that are not ``live`` were replaced.

    ``source``: for tables that are made from another one, that table's landing of the day.
    """

    day: str
    landing: str
    n_records: int
    live: bool = True
    source: str | None = None

    @property
    def date(self) -> date | None:
        return date.fromisoformat(self.day) if self.day else None


def entries(spark: SparkSession, path: str) -> list[Landed]:
    """The newest manifest of the table at ``path``; nothing if there is none."""
    return _newest(spark, path)[1]


def live_entries(spark: SparkSession, path: str) -> dict[date, Landed]:
    """The live landing of each calendar day."""
    return {e.date: e for e in entries(spark, path) if e.live and e.day}


def publish(spark: SparkSession, path: str, landing: str, counts: Mapping[str, int], replace: bool, sources: Mapping[str, str]) -> None:
    """Make a landing's days visible. Days that are there already are kept as they are, or all replaced."""
    files = _FileSystem(spark, path)
    while True:
        version, known = _newest(spark, path)
        there = {e.day for e in known if e.live}
        new = [Landed(d, landing, n, True, sources.get(d)) for d, n in counts.items() if replace or d not in there]
        gone = {e.day for e in new}
        old = [Landed(e.day, e.landing, e.n_records, e.live and e.day not in gone, e.source) for e in known]
        writing = f"{path}/{_MANIFESTS}/.writing-{uuid4().hex}"
        spark.createDataFrame([astuple(e) for e in old + new], _MANIFEST).coalesce(1).write.parquet(writing)
        if files.rename(writing, f"{path}/{_MANIFESTS}/{version + 1:010d}"):
            break
        files.delete(writing)  # another landing has taken the number: begin anew from what it made
    for number in files.numbers(f"{path}/{_MANIFESTS}"):
        if number <= version - _KEPT:
            files.delete(f"{path}/{_MANIFESTS}/{number:010d}")


def exists(spark: SparkSession, path: str) -> bool:
    return _FileSystem(spark, path).exists(path)


def files_of(spark: SparkSession, paths: Collection[str]) -> dict[str, list[tuple[str, str]]]:
    """The files at or right below many paths of one store, as name and URI, without those whose names begin with ``_`` or ``.``.

    Paths that do not exist are left out. The driver asks the store, as Spark does for the tables it reads.
    """
    if not paths:
        return {}
    store = _FileSystem(spark, next(iter(paths)))
    with ThreadPool(_AT_ONCE) as pool:
        found = pool.map(store.files, paths)
    return {path: files for path, files in zip(paths, found, strict=True) if files is not None}


def _newest(spark: SparkSession, path: str) -> tuple[int, list[Landed]]:
    folder = f"{path}/{_MANIFESTS}"
    number = max(_FileSystem(spark, path).numbers(folder), default=0)
    if not number:
        return 0, []
    return number, [Landed(*row) for row in spark.read.schema(_MANIFEST).parquet(f"{folder}/{number:010d}").collect()]


class _FileSystem:
    """The few calls on a store that Spark has no DataFrame for."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.gateway = spark.sparkContext._gateway
        self.conf = spark._jsc.hadoopConfiguration()
        self.store = self._path(path).getFileSystem(self.conf)

    def _path(self, path: str):
        return self.hadoop.Path(path)

    def exists(self, path: str) -> bool:
        return self.store.exists(self._path(path))

    def files(self, path: str) -> list[tuple[str, str]] | None:
        try:
            listed = self.store.listStatus(self._path(path))
        except Py4JJavaError as error:
            if error.java_exception.getClass().getSimpleName() == "FileNotFoundException":
                return None
            raise
        named = [(p.toString(), p.toUri().toString()) for p in (s.getPath() for s in listed if s.isFile())]
        return [(name, uri) for name, uri in named if name.rpartition("/")[2][:1] not in "_."]

    def numbers(self, folder: str) -> list[int]:
        if not self.exists(folder):
            return []
        names = [status.getPath().getName() for status in self.store.listStatus(self._path(folder))]
        return [int(name) for name in names if name.isdecimal()]

    def delete(self, path: str) -> None:
        self.store.delete(self._path(path), True)

    def rename(self, old: str, new: str) -> bool:
        """False if the new name is taken."""
        kind = getattr(self.hadoop, "Options$Rename")
        source, target = (self.store.makeQualified(self._path(p)) for p in (old, new))
        context = self.hadoop.FileContext.getFileContext(source.toUri(), self.conf)
        try:
            context.rename(source, target, self.gateway.new_array(kind, 0))
        except Py4JJavaError as error:
            if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                return False
            raise
        return True

"""Zip archives: the same rows as from directories, however they are read."""

from __future__ import annotations

import zipfile

import minifeed
import pytest
from pyspark.sql import functions as F

from stopline.period import Period
from stopline.sinks.landing import land, read_landed
from stopline.sources import archives, storage
from stopline.sources.feed_csv import read_feed_period


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return minifeed.write_archives(tmp_path_factory.mktemp("archives") / "Åre 100% #1")


@pytest.fixture(params=["content", "storage"])
def way(request, monkeypatch):
    """Both ways of reading: archives loaded whole, and members read from storage."""
    if request.param == "content":
        monkeypatch.setattr(storage, "STREAMED", {})


def test_lines(spark, root, way):
    got = archives.archive_lines(spark, root).collect()
    lines = {(row.archive.rsplit("-", 1)[1][:8], row.member, row.line_no): row.line for row in got}
    want = {
        (day, f"{name}.txt", i): line
        for day, tables in minifeed.DAYS.items()
        for name, text in tables.items()
        for i, line in enumerate(text.splitlines())
    }
    assert lines == want


@pytest.mark.parametrize("table", ["stops", "trips", "stop_times"])
def test_same_rows_as_from_directories(spark, root, way, tmp_path, table):
    directories = read_feed_period(spark, minifeed.write_directories(tmp_path / "feed"), minifeed.PERIOD, table)
    columns = sorted(set(directories.columns) - {"feed_date"})
    want = directories.select("feed_date", *columns).collect()
    got = archives.archived_table(spark, root, table, columns).select("feed_date", *columns).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_pieces_number_lines_without_gaps(spark, tmp_path, monkeypatch, way):
    n = 2 * archives._LINES_AT_ONCE + 7
    with zipfile.ZipFile(tmp_path / "sweden-20251001.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("stop_times.txt", "stop_id\r\n" + "".join(f"s{i}\r\n" for i in range(n - 1)))
    lines = archives.archive_lines(spark, str(tmp_path))
    assert lines.count() == lines.select("line_no").distinct().count() == n
    assert lines.selectExpr("min(line_no)", "max(line_no)").first()[:] == (0, n - 1)
    assert lines.filter(f"line = 's{n - 2}' and line_no = {n - 1}").count() == 1
    table = archives.archived_table(spark, str(tmp_path), "stop_times", ["stop_id"])
    assert table.select("stop_id").distinct().count() == n - 1


def test_members_of_an_archive_are_spread_over_tasks(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "sweden-20251001.zip", "w") as archive:
        for i in range(16):
            archive.writestr(f"{i}.txt", "line\n")
    lines = archives.archive_lines(spark, str(tmp_path)).withColumn("task", F.spark_partition_id())
    assert lines.count() == 16
    assert lines.select("task").distinct().count() >= 6


def test_quoted_fields_and_ragged_rows(spark, tmp_path, way):
    text = b'\xef\xbb\xbfstop_id,stop_name,zone\r\n1,"Torget, ""stora""",z\r\n2\r\n3,Ny,z,extra\r\n\r\n4,\xe5,"z"\r\n'
    with zipfile.ZipFile(tmp_path / "sweden-20251001.zip", "w") as archive:
        archive.writestr("feed/stops.txt", text)
    for day, text in ((2, ""), (3, "stop_id,stop_name"), (4, "stop_id,stop_name\n")):
        with zipfile.ZipFile(tmp_path / f"sweden-2025100{day}.zip", "w") as archive:
            archive.writestr("stops.txt", text)
    got = archives.archived_table(spark, str(tmp_path), "stops", ["stop_id", "stop_name"]).orderBy("stop_id").collect()
    assert [(row.stop_id, row.stop_name) for row in got] == [
        ("1", 'Torget, "stora"'), ("2", None), ("3", "Ny"), ("4", "\ufffd")
    ]
    assert str(got[0].feed_date) == "2025-10-01"


def test_as_the_csv_source_reads_it(spark, tmp_path):
    """Many odd rows among many regular ones, over several pieces."""
    rows = [f'{i},"n ""{i}""",{"z" * (i % 50)}' if i % 7 else f"{i}" if i % 2 else f"{i},a,b,c,d" for i in range(300_000)]
    text = "stop_id,stop_name,zone\n" + "\n".join(rows) + "\n"
    with zipfile.ZipFile(tmp_path / "sweden-20251001.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("stops.txt", text)
    (tmp_path / "sweden-20251001").mkdir()
    (tmp_path / "sweden-20251001/stops.txt").write_text(text)
    columns = ["zone", "stop_id", "stop_name"]
    got = archives.archived_table(spark, str(tmp_path), "stops", columns).select(columns)
    want = read_feed_period(spark, str(tmp_path), Period.parse("2025-10-01", "2025-10-01"), "stops").select(columns)
    assert got.count() == 300_000
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


@pytest.mark.parametrize(
    "text",
    [
        "a,b\n1,2\n   \n3,4\n",
        'a,b\n1,"two\nlines"\n3,4\n',
        'a,b\n"1,2\n' + "".join(f"{i},x\n" for i in range(1000)),
        'a,b\n1,"2\n' + "".join(f"{i},x{'y' * 20}\n" for i in range(300_000)),
        'b,a\r\n"",\r\n"q""q", x \r\n1,2,3\r\n1',
    ],
    ids=["blanks", "quoted line feed", "unclosed quote", "unclosed quote, long", "empty, spaces, ragged"],
)
def test_odd_text_is_read_as_from_a_directory(spark, tmp_path, way, text):
    with zipfile.ZipFile(tmp_path / "sweden-20251001.ZIP", "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("stops.txt", text)
    (tmp_path / "sweden-20251001").mkdir()
    (tmp_path / "sweden-20251001/stops.txt").write_bytes(text.encode())
    got = archives.archived_table(spark, str(tmp_path), "stops")
    want = read_feed_period(spark, str(tmp_path), Period.parse("2025-10-01", "2025-10-01"), "stops")
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_an_archive_without_the_table_is_an_error(spark, tmp_path, way):
    for day, member in ((1, "stops.txt"), (2, "other.txt")):
        with zipfile.ZipFile(tmp_path / f"sweden-2025100{day}.zip", "w") as archive:
            archive.writestr(member, "a\n1\n")
    with pytest.raises(Exception, match="has no stops.txt"):
        archives.archived_table(spark, str(tmp_path), "stops").count()
    assert archives.archived_table(spark, str(tmp_path), "stops", optional=True).count() == 1
    assert archives.archived_table(spark, str(tmp_path), "shapes", ["x"], optional=True).collect() == []


def test_an_archive_is_written_by_several_tasks(spark, tmp_path):
    for day, n in ((1, 200_000), (2, 100)):
        with zipfile.ZipFile(tmp_path / f"sweden-2025100{day}.zip", "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("stop_times.txt", "stop_id\n" + "".join(f"{i * 7919 % 1000003}\n" for i in range(n)))
    sizes = ["spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize"]
    for size in sizes:
        spark.conf.set(size, "200k")
    try:
        rows = archives.archived_table(spark, str(tmp_path), "stop_times", ["stop_id"]).hint("rebalance")
        land(rows, str(tmp_path / "landed"), day_by_day=True)
    finally:
        for size in sizes:
            spark.conf.unset(size)
    landed = read_landed(spark, str(tmp_path / "landed"))
    files = landed.groupBy("feed_date").agg(F.count_distinct("_metadata.file_path").alias("f"), F.count("*").alias("n"))
    assert {row.feed_date.day: row.n for row in files.collect()} == {1: 200_000, 2: 100}
    assert {row.feed_date.day: row.f > 1 for row in files.collect()}[1]


def test_an_archive_is_opened_once_for_all_tables(root, monkeypatch):
    """The tasks' functions, run here: one look finds all members, and reading them does not open the archive again."""
    import pyarrow as pa

    opened = []
    real, zip_file = archives.open_storage, zipfile.ZipFile
    monkeypatch.setattr(archives, "open_storage", lambda path: opened.append(path) or real(path))
    paths = [f"file:{root}/sweden-{day}.zip" for day in minifeed.DAYS]
    batch = pa.RecordBatch.from_pydict({"path": paths})
    tables = ["agency", "routes", "stops", "trips", "stop_times", "calendar"]
    places = [p for found in archives._find_members(tables, ["calendar"])(iter([batch])) for p in found.to_pylist()]
    assert opened == paths and len(places) == 10

    def refuse(*_):
        raise AssertionError("opened again")

    monkeypatch.setattr(zipfile, "ZipFile", refuse)
    reader = archives._MemberReader(places)
    assert len(reader.partitions()) == 10
    for partition in reader.partitions():
        place = partition.value
        lines = [line for rows in reader.read(partition) for line in rows["line"].to_pylist()]
        day = place["archive"][-12:-4]
        assert [place["header"], *lines] == minifeed.DAYS[day][place["table_name"]].splitlines()
    monkeypatch.setattr(zipfile, "ZipFile", zip_file)


def test_landing_all_tables_opens_the_archives_once(spark, root, tmp_path, way, monkeypatch):
    from stopline.plans import summary

    calls = []
    real = summary.open_archives
    monkeypatch.setattr(summary, "open_archives", lambda *given: calls.append(given) or real(*given))
    for _ in range(2):
        summary.land_archives(spark, root, str(tmp_path / "lake"), minifeed.PERIOD)
    assert [(len(paths), len(tables)) for _, paths, tables, _ in calls] == [(2, 9), (2, 4)]  # then only tables that no archive had
    for table, n in minifeed.COUNTS.items():
        assert read_landed(spark, str(tmp_path / "lake" / table)).count() == n


def test_stored_changed_and_broken_members(spark, tmp_path):
    file = tmp_path / "sweden-20251001.zip"
    with zipfile.ZipFile(file, "w", zipfile.ZIP_STORED) as archive:
        archive.writestr("feed/stops.txt", "a\n1\n2\n")
    opened = archives.open_archives(spark, str(tmp_path), ["stops"])
    assert sorted(r.a for r in opened.table("stops").collect()) == ["1", "2"]
    content = file.read_bytes()
    file.write_bytes(content.replace(b"a\n1\n2\n", b"a\n1\n3\n"))
    with pytest.raises(Exception, match="CRC"):
        opened.table("stops").collect()
    file.write_bytes(b"x" * len(content))
    with pytest.raises(Exception, match="has changed since"):
        opened.table("stops").collect()


def test_only_the_archives_of_some_days(spark, root, way):
    opened = archives.open_archives(spark, root, ["trips", "stops"])
    days = [minifeed.PERIOD.end]
    assert {str(r.feed_date) for r in opened.table("trips", days=days).collect()} == {"2025-10-02"}
    assert opened.table("trips", days=[]).count() == 0 and opened.table("trips").count() == 6

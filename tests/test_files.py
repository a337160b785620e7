"""Landing, inventory, CSV headers and where scratch data goes."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from stopline import scratch
from stopline.period import Period
from stopline.sinks.landing import dataset_path, land, read_landed
from stopline.sources import feed_csv
from stopline.sources.inventory import dataset_totals, file_inventory

DAY = Period.parse("2025-10-01", "2025-10-01")


def day_file(root, text, name="stops.txt", day="20251001"):
    folder = root / f"sweden-{day}"
    folder.mkdir(exist_ok=True, parents=True)
    (folder / name).parent.mkdir(exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


def test_inventory_lists_names_sizes_and_records(spark, tmp_path):
    lake = str(tmp_path / "lake")
    path = f"{lake}/2025-10/gtfs/trips"
    rows = spark.range(1000).withColumn("feed_date", F.date_add(F.lit("2025-10-01").cast("date"), (F.col("id") % 3).cast("int")))
    land(rows, path)
    spark.createDataFrame([], "id BIGINT").coalesce(1).write.parquet(f"{path}/feed_date=2025-10-09")
    files = {(str(row.feed_date), row.n_records): row for row in file_inventory(spark, lake).collect()}
    assert set(files) == {("2025-10-01", 334), ("2025-10-02", 333), ("2025-10-03", 333), ("2025-10-09", 0)}
    for row in files.values():
        on_disk = tmp_path / "lake/2025-10/gtfs/trips" / f"feed_date={row.feed_date}" / row.file_name
        assert on_disk.stat().st_size == row.length
        size = row.length
        assert row.size_label == (f"{size} B" if size < 1024 else f"{size / 1024:.1f} KB")
    totals = dataset_totals(file_inventory(spark, lake)).first()
    assert (totals.dataset, totals.n_files, totals.n_records) == ("2025-10", 4, 1000)
    assert totals.n_bytes == sum(row.length for row in files.values())


def test_inventory_of_all_kinds_of_files(spark, tmp_path):
    lake = str(tmp_path / "lake åre 100%")
    spark.range(5).write.parquet(f"{lake}/2025-09/gtfs/stops")
    spark.range(7).selectExpr("CAST(id AS STRING) AS name").coalesce(1).write.parquet(f"{lake}/2025-10/gtfs/routes")
    spark.range(3).selectExpr("'line'").coalesce(1).write.text(f"{lake}/2025-10/analytics")
    totals = {row.dataset: row for row in dataset_totals(file_inventory(spark, f"file:{lake}/")).collect()}
    assert {name: row.n_records for name, row in totals.items()} == {"2025-09": 5, "2025-10": 7}
    assert totals["2025-10"].n_files == 2
    texts = file_inventory(spark, f"{lake}/2025-10/analytics").collect()
    assert [(row.dataset, row.length, row.n_records) for row in texts] == [(None, 15, None)]


def test_rows_of_one_day_are_not_shuffled(spark, tmp_path):
    day_file(tmp_path, "stop_id\n1\n2\n")
    frame = feed_csv.read_feed_period(spark, str(tmp_path), DAY, "stops")
    land(frame, str(tmp_path / "landed"), day_by_day=True)
    assert read_landed(spark, str(tmp_path / "landed"), DAY).count() == 2


def test_a_day_with_most_of_the_rows_is_written_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "landed")
    hot = F.when(F.col("id") % 10 < 8, F.lit("2025-10-01")).otherwise(F.lit("2025-10-02")).cast("date")
    rows = spark.range(0, 400_000, 1, 8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), hot.alias("feed_date"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        land(rows, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = file_inventory(spark, path).groupBy("feed_date").agg(F.count("*").alias("n"), F.sum("n_records").alias("r"))
    got = {str(row.feed_date): (row.n, row.r) for row in files.collect()}
    assert got["2025-10-01"][0] > 3 and got["2025-10-01"][1] == 320_000
    assert got["2025-10-02"][1] == 80_000


def test_only_the_days_of_the_period_are_read(spark, tmp_path):
    path = str(tmp_path / "landed")
    land(spark.range(100).withColumn("feed_date", F.date_add(F.lit("2025-10-01").cast("date"), (F.col("id") % 5).cast("int"))), path)
    two = read_landed(spark, path, Period.parse("2025-10-02", "2025-10-03"), "id BIGINT, feed_date DATE")
    assert two.count() == 40
    plan = two._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(feed_date" in plan and ">= 2025-10-02" in plan
    assert "PushedFilters: []" in plan


def test_columns_of_some_days_survive_landing(spark, tmp_path):
    path = str(tmp_path / "landed")
    land(spark.sql("SELECT 'a' AS x, DATE'2025-10-01' AS feed_date"), path)
    land(spark.sql("SELECT 'b' AS y, 'c' AS x, DATE'2025-10-02' AS feed_date"), path)
    rows = read_landed(spark, path).orderBy("feed_date").select("x", "y").collect()
    assert [tuple(row) for row in rows] == [("a", None), ("c", "b")]


def test_each_day_has_its_own_header_and_a_constant_day(spark, tmp_path):
    for i in range(6):
        header = "stop_id,stop_name" if i < 4 else "stop_name,stop_id"
        day_file(tmp_path, f"{header}\n{i},x\n" if i < 4 else f"{header}\nx,{i}\n", day=f"2025100{i + 1}")
    frame = feed_csv.read_feed_period(spark, str(tmp_path), Period.parse("2025-10-01", "2025-10-06"), "stops")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "2025-10-03 AS feed_date" in plan and "file_path" not in plan
    rows = frame.orderBy("feed_date").collect()
    assert [(row.stop_id, row.stop_name, row.feed_date.day) for row in rows] == [(str(i), "x", i + 1) for i in range(6)]


def test_parts_with_another_header_fail(spark, tmp_path):
    day_file(tmp_path, "stop_id,stop_name\n1,x\n", "stops.txt/part-0.csv")
    day_file(tmp_path, "stop_name,stop_id\nx,2\n", "stops.txt/part-1.csv")
    frame = feed_csv.read_feed_period(spark, str(tmp_path), DAY, "stops")
    with pytest.raises(Exception, match="CSV header does not conform"):
        frame.collect()
    with pytest.raises(Exception, match="CSV header does not conform"):
        frame.select("stop_id").collect()


def test_byte_order_mark_quotes_blanks_and_unnamed_columns(spark, tmp_path):
    day_file(tmp_path, '﻿stop_id,stop_name,\n1,"Torget, ""stora""",\n 2 ,Ny\n')
    frame = feed_csv.read_feed_period(spark, str(tmp_path), DAY, "stops")
    rows = [(row.stop_id, row.stop_name) for row in frame.orderBy("stop_name").collect()]
    assert rows == [(" 2 ", "Ny"), ("1", 'Torget, "stora"')]
    assert frame.select("stop_id").count() == frame.count() == 2


@pytest.mark.parametrize("name", ["feed", "Åre 100% #1"])
def test_days_of_one_header_are_scanned_together(spark, tmp_path, name):
    root = tmp_path / name
    for i in range(12):
        header, row = (("stop_id,stop_name", f"{i},x"), ("stop_name,stop_id,zone", f'"x, ""y""",{i},z'))[i % 2]
        day_file(root, f"\ufeff{header}\n{row}\n\n" if i % 3 else f"\n{header}\n{row}\n", day=f"202510{i + 1:02d}")
    day_file(root, "", day="20251013")
    day_file(root, "stop_id,stop_name\n", day="20251014")
    for part in range(3):
        day_file(root, f"stop_id,stop_name\n15-{part},x\n", f"stops.txt/part-{part}.csv", day="20251015")
    (root / "sweden-20251015/stops.txt/_SUCCESS").write_text("")
    period = Period.parse("2025-10-01", "2025-10-15")
    history, each = (read(spark, str(root), period, "stops") for read in (feed_csv.read_feed_history, feed_csv.read_feed_period))
    plan = history._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 2 and set(history.columns) == set(each.columns)
    each = each.select(history.columns)
    assert history.count() == 15 and history.exceptAll(each).count() == each.exceptAll(history).count() == 0
    longer = Period.parse("2025-10-10", "2025-10-16")
    with pytest.raises(FileNotFoundError, match="PATH_NOT_FOUND"):
        feed_csv.read_feed_history(spark, str(root), longer, "stops")
    assert feed_csv.read_feed_history(spark, str(root), longer, "stops", optional=True).count() == 6
    assert feed_csv.read_feed_history(spark, str(root), longer, "shapes", optional=True) is None


def test_history_with_parts_of_another_header_fails_and_unnamed_columns_are_read(spark, tmp_path):
    day_file(tmp_path, "stop_id,stop_name\n1,x\n", "stops.txt/part-0.csv")
    day_file(tmp_path, "stop_name,stop_id\nx,2\n", "stops.txt/part-1.csv")
    with pytest.raises(Exception, match="CSV header does not conform"):
        feed_csv.read_feed_history(spark, str(tmp_path), DAY, "stops").collect()
    day_file(tmp_path, "stop_id,,stop_id\n1,2,3\n", "trips.txt")
    assert sorted(feed_csv.read_feed_history(spark, str(tmp_path), DAY, "trips").columns) == sorted(feed_csv.read_feed_period(spark, str(tmp_path), DAY, "trips").columns)


def test_two_years_of_days_are_planned_quickly(spark, tmp_path):
    period = Period.parse("2024-01-01", "2025-12-30")
    for day in period:
        day_file(tmp_path, "trip_id,stop_id\n1,2\n" if day.day % 2 else "stop_id,trip_id\n2,1\n", day=f"{day:%Y%m%d}")
    feed_csv.read_feed_history(spark, str(tmp_path), DAY, "stops")  # workers are there
    start = time.perf_counter()
    rows = feed_csv.read_feed_history(spark, str(tmp_path), period, "stops")
    assert time.perf_counter() - start < 20  # 3 to 5 seconds where nothing else runs
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 2
    assert rows.groupBy("trip_id", "stop_id").count().collect() == [("1", "2", 730)]


def test_dataset_path():
    assert dataset_path("/data/", DAY.start) == "/data/2025-10/gtfs"
    assert dataset_path("/data", DAY.start, "analytics") == "/data/2025-10/analytics"


def test_run_folder_is_in_the_shared_folder_and_new(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch.run_folder(spark, "x"), scratch.run_folder(spark, "x")
    assert one != two and one.startswith(f"{shared}/x-")

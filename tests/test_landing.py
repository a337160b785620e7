"""What readers see of landings that die, race or are replaced, and counts kept by day."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import minifeed
import pytest
from pyspark.sql import functions as F

from stopline.operators.dimensions import latest_snapshot
from stopline.period import Period
from stopline.plans import rolling
from stopline.plans.summary import lake_completeness, lake_document, land_feeds, landed_tables, run_summary, summary_document
from stopline.schemas import SUMMARY_TABLES
from stopline.sinks import landing, snapshots
from stopline.sinks.landing import land, landed_records, present_days, read_landed, read_landed_days
from stopline.sinks.reports import report_lines

FIRST = date(2025, 10, 1)
WEEK = Period(FIRST, FIRST + timedelta(days=6))


def days_of(spark, n, value, days=(0, 1, 2)):
    rows = [(f"{value}{i}", FIRST + timedelta(days=d)) for d in days for i in range(n)]
    return spark.createDataFrame(rows, "stop_id STRING, feed_date DATE")


def seen(spark, path):
    return {(r.feed_date.day, r.stop_id) for r in read_landed(spark, path, WEEK, "stop_id STRING, feed_date DATE").collect()}


def die(*_):
    raise KeyboardInterrupt("killed")


def test_a_landing_that_dies_before_it_is_published_is_invisible(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "stops")
    land(days_of(spark, 2, "a", (0, 1)), path)
    before = seen(spark, path)
    for mode, rows in (("keep", days_of(spark, 3, "b", (2,))), ("replace", days_of(spark, 3, "c", (0, 1, 2)))):
        with monkeypatch.context() as patch:
            patch.setattr(landing, "publish", die)
            with pytest.raises(KeyboardInterrupt):
                land(rows, path, mode)
        assert seen(spark, path) == before and len(present_days(spark, path)) == 2
        assert read_landed(spark, path).count() == 4 and landed_records(spark, path, WEEK) == {FIRST: 2, FIRST + timedelta(days=1): 2}
    land(days_of(spark, 1, "d", (0, 2)), path, "replace")  # run again, with what is in the way lying in the same directories
    assert seen(spark, path) == {(1, "d0"), (3, "d0"), (2, "a0"), (2, "a1")}


def test_a_landing_whose_tasks_fail_is_invisible(spark, tmp_path):
    path = str(tmp_path / "stops")
    land(days_of(spark, 2, "a", (0,)), path)
    bad = days_of(spark, 500, "b", (0, 1)).withColumn("stop_id", F.when(F.col("stop_id") == "b499", F.raise_error(F.lit("lost"))).otherwise(F.col("stop_id")))
    with pytest.raises(Exception, match="lost"):
        land(bad, path, "replace")
    assert seen(spark, path) == {(1, "a0"), (1, "a1")}


def test_unfinished_days_are_not_counted(spark, tmp_path, monkeypatch):
    lake, root = str(tmp_path / "lake"), minifeed.write_directories(tmp_path / "feed")
    land_feeds(spark, root, lake, Period(minifeed.PERIOD.start, minifeed.PERIOD.start))
    with monkeypatch.context() as patch:
        patch.setattr(landing, "publish", die)
        with pytest.raises(KeyboardInterrupt):
            land_feeds(spark, root, lake, minifeed.PERIOD)
    document = run_summary(spark, lake, minifeed.PERIOD, str(tmp_path / "out"), datetime(2025, 10, 3), allow_gaps=True).first()
    assert document.counts.stop_times == 6 and set(document.days_loaded) == {1}


def test_replaced_days_leave_the_other_days_of_their_landing(spark, tmp_path):
    path = str(tmp_path / "stops")
    land(days_of(spark, 3, "a"), path)
    for value in "bc":
        land(days_of(spark, 1, value, (1,)), path, "replace")
    assert seen(spark, path) == {(1, f"a{i}") for i in range(3)} | {(3, f"a{i}") for i in range(3)} | {(2, "c0")}
    assert read_landed(spark, path).count() == 7 and landed_records(spark, path, WEEK)[FIRST + timedelta(days=1)] == 1
    some = read_landed_days(spark, path, [FIRST + timedelta(days=1), FIRST], "stop_id STRING, feed_date DATE")
    assert some.count() == 4 and [e.live for e in snapshots.entries(spark, path)].count(False) == 2


def test_a_number_that_is_taken_is_not_overwritten(spark, tmp_path, monkeypatch):
    path, newest, raced = str(tmp_path / "stops"), snapshots._newest, []
    land(days_of(spark, 1, "a", (0,)), path)

    def another_lands_first(*given):
        found = newest(*given)
        if not raced:
            raced.append(True)
            snapshots.publish(spark, path, "r0", {"2025-10-02": 5, "2025-10-03": 6}, False, {})
        return found

    monkeypatch.setattr(snapshots, "_newest", another_lands_first)
    snapshots.publish(spark, path, "r1", {"2025-10-03": 7, "2025-10-04": 8}, False, {})
    got = {day.day: (e.landing if day != FIRST else "first", e.n_records) for day, e in snapshots.live_entries(spark, path).items()}
    assert got == {1: ("first", 1), 2: ("r0", 5), 3: ("r0", 6), 4: ("r1", 8)}
    monkeypatch.setattr(snapshots, "_KEPT", 1)
    snapshots.publish(spark, path, "r2", {"2025-10-05": 1}, False, {})
    assert len(list((tmp_path / "stops/_landed").iterdir())) <= 3 and len(present_days(spark, path)) == 5


def test_rows_without_a_day_and_nothing_landed(spark, tmp_path):
    path = str(tmp_path / "stops")
    rows = days_of(spark, 2, "a", (0,)).unionByName(spark.sql("SELECT 'x' AS stop_id, CAST(NULL AS DATE) AS feed_date"))
    land(rows, path)
    land(rows, path)
    assert read_landed(spark, path).count() == 3 and present_days(spark, path) == {FIRST} and len(seen(spark, path)) == 2
    assert seen(spark, str(tmp_path / "none")) == set()
    with pytest.raises(FileNotFoundError):
        read_landed(spark, str(tmp_path / "none"))


def test_completeness_reads_no_data(spark, tmp_path):
    lake = str(tmp_path / "lake")
    land(days_of(spark, 2, "a", (0, 1)), f"{lake}/stops")
    complete = lake_completeness(spark, lake, WEEK, [("stops", True), ("trips", False)])
    assert complete.inputFiles() == [] and "FileScan" not in complete._jdf.queryExecution().executedPlan().toString()
    assert complete.filter("found").count() == 2 and complete.count() == 14


def test_a_period_that_moves_on_reads_one_new_day(spark, tmp_path, monkeypatch):
    lake, read = str(tmp_path / "lake"), []
    facts = days_of(spark, 5, "s", range(7)).unionByName(days_of(spark, 900, "", (3,)).withColumn("stop_id", F.lit("hot")))
    facts = facts.unionByName(days_of(spark, 2, "", (1,)).withColumn("stop_id", F.lit(None).cast("string")))
    land(facts, f"{lake}/stop_times")
    land(facts.select(F.col("stop_id").alias("route_id"), "feed_date"), f"{lake}/trips")

    def reading(*given):
        rows = read_landed_days(*given)
        read.append(sorted({f.split("feed_date=")[1][:10] for f in rows.inputFiles()}))
        return rows

    monkeypatch.setattr(rolling, "read_landed_days", reading)
    week, moved = Period(FIRST, FIRST + timedelta(days=5)), Period(FIRST + timedelta(days=1), FIRST + timedelta(days=6))
    assert {t: len(d) for t, d in rolling.keep_day_counts(spark, lake, week).items()} == {"stop_times": 6, "trips": 6}
    rolling.keep_day_counts(spark, lake, week)
    read.clear()
    rolling.keep_day_counts(spark, lake, moved)
    assert read == [["2025-10-07"], ["2025-10-07"]]  # one day of each fact table
    per_day = rolling.day_counts(spark, lake, "stop_times", moved)
    assert all("_day_counts/" in f for f in per_day.inputFiles())
    from stopline.operators.counts import merged_days, visits_from_days, visits_per_stop

    merged = {r.stop_id: r.n for r in merged_days(per_day, "stop_id", "n").collect()}
    assert merged == {f"s{i}": 6 for i in range(5)} | {"hot": 900, None: 2}
    whole = visits_per_stop(facts.filter(moved.has_day(F.col("feed_date"))), 6)
    rolled = visits_from_days(per_day, 6)
    assert rolled.exceptAll(whole).count() == whole.exceptAll(rolled).count() == 0 and rolled.columns == whole.columns
    land(days_of(spark, 1, "new", (3,)), f"{lake}/stop_times", "replace")  # its counts no longer fit
    read.clear()
    assert rolling.keep_day_counts(spark, lake, moved) == {"stop_times": [FIRST + timedelta(days=3)], "trips": []}
    assert read == [["2025-10-04"]]
    merged = {r.stop_id: r.n for r in merged_days(rolling.day_counts(spark, lake, "stop_times", moved), "stop_id", "n").collect()}
    assert merged == {f"s{i}": 5 for i in range(5)} | {"new0": 1, None: 2}


def test_the_document_of_a_lake_equals_the_full_scan_and_says_its_days(spark, tmp_path):
    lake, longer = str(tmp_path / "lake"), Period.parse("2025-10-01", "2025-10-03")
    land_feeds(spark, minifeed.write_directories(tmp_path / "feed"), lake, minifeed.PERIOD)
    rolled, scanned = lake_document(spark, lake, longer), summary_document(landed_tables(spark, lake, longer), longer)
    one, other = rolled.first().asDict(recursive=True), scanned.first().asDict(recursive=True)
    assert one.pop("days_loaded") == dict.fromkeys(SUMMARY_TABLES, 2) and other.pop("days_loaded") is None
    assert one == other and rolled.dtypes == scanned.dtypes
    plan = rolled._jdf.queryExecution().executedPlan().toString()
    assert "/lake/stop_times" not in plan and "/lake/trips" not in plan
    lines = [r.line for r in report_lines(rolled, datetime(2025, 10, 4), with_days=True).orderBy("line_no").collect()]
    assert lines[-7:] == ["Days Loaded:", "-" * 30, "- Agency: 2", "- Routes: 2", "- Stops: 2", "- Trips: 2", "- Stop times: 2"]
    assert lines[-8] == "" and [r.line for r in report_lines(scanned, datetime(2025, 10, 4), with_days=True).orderBy("line_no").collect()][-1] == "- Stop times: n/a"


def test_newest_snapshots_sort_no_rows_before_the_newest_day_is_known(spark):
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 400)).alias("stop_id"),
        F.when(F.col("id") % 41 != 2, F.date_add(F.lit(FIRST), (F.col("id") % 37).cast("int"))).alias("feed_date"),
        F.concat(F.lit("n"), F.col("id") % 11).alias("stop_name"),
    )
    got = {r.stop_id: r.stop_name for r in latest_snapshot(rows, "stop_id", ["stop_name"], ["feed_date", "stop_name"]).collect()}
    want = {}
    for r in rows.collect():
        rank = (r.feed_date is not None, r.feed_date or FIRST, r.stop_name)
        want[r.stop_id] = max(rank, want.get(r.stop_id, rank))
    assert got == {k: v[2] for k, v in want.items()}
    plan = latest_snapshot(rows, "stop_id", ["stop_name"], ["feed_date", "stop_name"])._jdf.queryExecution().sparkPlan().toString()
    below_the_join = plan[plan.index("Join"):]
    assert "HashAggregate" in below_the_join and "SortAggregate" not in below_the_join and "Sort [" not in below_the_join

"""The whole way from feed files to report and document, on two small days."""

from __future__ import annotations

import json
import time
import zipfile
from datetime import datetime
from pathlib import Path

import minifeed
import pytest

from stopline.operators import counts, quality, ranking
from stopline.operators.snapshots import union_days
from stopline.period import Period
from stopline.plans.summary import _to_land, lake_completeness, land_archives, land_feeds, landed_tables, run_summary, summary_document
from stopline.schemas import SUMMARY_TABLES
from stopline.sinks import reports
from stopline.sinks.landing import land, present_days, read_landed
from stopline.sources import documents
from stopline.sources.feed_csv import read_feed_day, read_feed_period

MADE_AT = datetime(2025, 10, 18, 9, 55)


@pytest.fixture(scope="module")
def feed_root(tmp_path_factory):
    return minifeed.write_directories(tmp_path_factory.mktemp("feed"))


@pytest.fixture(scope="module")
def tables(spark, feed_root):
    return {name: read_feed_period(spark, feed_root, minifeed.PERIOD, name) for name in SUMMARY_TABLES}


@pytest.fixture(scope="module")
def per_stop(tables):
    return counts.visits_per_stop(tables["stop_times"], minifeed.PERIOD.num_days)


def rows(frame):
    return [tuple(row) for row in frame.collect()]


def test_every_column_is_a_string_and_the_day_a_date(tables):
    types = dict(tables["stop_times"].dtypes)
    assert types.pop("feed_date") == "date"
    assert set(types.values()) == {"string"}


def test_reordered_header_is_matched_by_name(tables):
    got = set(rows(tables["stops"].select("feed_date", "stop_id", "stop_name")))
    names = {(str(day), stop): name for day, stop, name in got}
    assert names["2025-10-01", "A"] == "Åre"
    assert names["2025-10-02", "A"] == "Åre Station"
    assert names["2025-10-01", "C"] is None
    assert names["2025-10-01", "E"] is None


def test_a_column_of_one_day_is_null_on_the_other(tables):
    got = rows(tables["stop_times"].groupBy("feed_date", "pickup_type").count())
    assert {(str(day), kind): n for day, kind, n in got} == {("2025-10-01", None): 6, ("2025-10-02", "0"): 6}


def test_one_day(spark, feed_root):
    day = read_feed_day(spark, feed_root, minifeed.PERIOD.end, "trips")
    assert sorted(map(str, rows(day.select("trip_id", "route_id")))) == ["('t1', 'r1')", "('t4', 'r3')", "('t5', None)"]


def test_a_day_without_the_file_is_an_error(spark, feed_root):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_feed_period(spark, feed_root, Period.parse("2025-10-01", "2025-10-03"), "stops")


def test_table_counts(tables):
    assert dict(rows(counts.table_counts(tables))) == minifeed.COUNTS


def test_top_and_least(per_stop, tables):
    assert rows(ranking.named_list(per_stop, tables["stops"], 30)) == minifeed.TOP
    assert rows(ranking.named_list(per_stop, tables["stops"], 30, ascending=True)) == minifeed.LEAST


@pytest.mark.parametrize("k", [1, 2, 4])
def test_short_lists_are_prefixes(per_stop, tables, k):
    assert rows(ranking.named_list(per_stop, tables["stops"], k)) == minifeed.TOP[:k]
    assert rows(ranking.named_list(per_stop, tables["stops"], k, ascending=True)) == minifeed.LEAST[:k]


def test_lists_too_long_to_broadcast(per_stop, tables):
    assert rows(ranking.named_list(per_stop, tables["stops"], 1_000_000)) == minifeed.TOP


def test_both_lists_at_once(per_stop, tables):
    both = ranking.named_lists(per_stop, tables["stops"], 30).orderBy("list_name", "rank")
    got = rows(both)
    assert [row[2:] for row in got if row[0] == "top_stops"] == minifeed.TOP
    assert [row[2:] for row in got if row[0] == "least_stops"] == minifeed.LEAST
    assert [row[1] for row in got] == [1, 2, 3, 4, 5, 6] * 2


def test_route_statistics(tables):
    per_route = counts.trips_per_route(tables["trips"])
    assert dict(rows(per_route)) == minifeed.ROUTES
    assert rows(counts.route_stats(per_route)) == [(4, 1.5, 3)]
    assert {route for route, _ in rows(counts.single_trip_routes(per_route))} == {"r2", "r3", None}


def test_route_statistics_of_nothing(tables):
    nothing = counts.trips_per_route(tables["trips"].filter("false"))
    assert rows(counts.route_stats(nothing)) == [(0, None, 0)]


def test_completeness(spark, tables):
    from functools import reduce

    from pyspark.sql import DataFrame
    from pyspark.sql import functions as F

    content = reduce(
        DataFrame.unionByName, [t.select("feed_date", F.lit(name).alias("table_name")) for name, t in tables.items()]
    )
    expected = quality.expected_tables(minifeed.PERIOD.days(spark))
    observed = quality.observed_tables(content)
    complete = quality.completeness(expected, observed)
    assert complete.count() == 2 * 11
    assert [row[1:] for row in rows(quality.verdicts(complete))] == [(6, 5, 0, False)] * 2
    assert {row[1] for row in rows(quality.missing_tables(expected, observed))} == {"calendar"}
    assert quality.found_tables(expected, observed).count() == 10
    needed = [entry for entry in quality.FEED_MANIFEST if entry[0] != "calendar"]
    again = quality.completeness(quality.expected_tables(minifeed.PERIOD.days(spark), needed), observed)
    assert all(row[-1] for row in rows(quality.verdicts(again)))


def test_completeness_of_a_lake(spark, tmp_path):
    root, lake = minifeed.write_directories(tmp_path / "feed"), str(tmp_path / "lake")
    (tmp_path / "feed/sweden-20251002/calendar.txt").write_text("service_id,monday\ns1,1\n")
    land_feeds(spark, root, lake, minifeed.PERIOD)
    longer = Period.parse("2025-10-01", "2025-10-03")
    complete = lake_completeness(spark, lake, longer)
    assert complete.count() == 3 * 11
    assert [row[1:] for row in sorted(rows(quality.verdicts(complete)))] == [(6, 5, 0, False), (6, 6, 0, True), (6, 0, 0, False)]
    assert complete.agg({"n_records": "sum"}).first()[0] == sum(minifeed.COUNTS.values()) + 1
    assert lake_completeness(spark, str(tmp_path / "nothing"), longer).filter("found").count() == 0


def test_run(spark, feed_root, tmp_path):
    lake, output = str(tmp_path / "lake"), str(tmp_path / "out")
    land_feeds(spark, feed_root, lake, minifeed.PERIOD)
    land_feeds(spark, feed_root, lake, minifeed.PERIOD)  # days that are there are kept, not doubled
    document = run_summary(spark, lake, minifeed.PERIOD, output, MADE_AT)

    (text,) = Path(output, "gtfs_summary_20251018_095500.txt").glob("part-*")
    assert text.read_text(encoding="utf-8") == minifeed.REPORT
    (saved,) = Path(output, "gtfs_summary_20251018_095500.json").glob("part-*")
    raw = saved.read_text(encoding="utf-8")
    assert "Åre Station" in raw and raw.count("\n") > 50
    result = json.loads(raw)
    assert result["period"] == {"start_date": "2025-10-01", "end_date": "2025-10-02", "num_days": 2}
    assert result["counts"] == minifeed.COUNTS
    assert [tuple(stop.values()) for stop in result["top_stops"]] == minifeed.TOP
    assert [tuple(stop.values()) for stop in result["least_stops"]] == minifeed.LEAST
    assert result["route_stats"] == {"total_routes": 4, "avg_trips_per_route": 1.5, "single_trip_routes": 3}

    assert [row.stop_id for row in documents.document_lists(document, 2).orderBy("list_name", "position").collect()] == [
        "E", "X", "A", "B"
    ]
    series = {row.list_name: row for row in documents.chart_series(document, 3).collect()}
    assert series["top_stops"].stop_names == ["Åre Station", "Borås", "Unknown"]
    assert series["least_stops"].avg_visits == [0.5, 0.5, 0.5]


def test_archives_give_the_same_summary(spark, tmp_path):
    root = minifeed.write_archives(tmp_path / "zips")
    (tmp_path / "zips/sweden-20251003.zip").write_text("no archive, and not of the period")
    lake = str(tmp_path / "lake")
    land_archives(spark, root, lake, minifeed.PERIOD)
    row = summary_document(landed_tables(spark, lake, minifeed.PERIOD), minifeed.PERIOD).first()
    assert row.counts.asDict() == minifeed.COUNTS
    assert [tuple(stop) for stop in row.top_stops] == minifeed.TOP
    assert [tuple(stop) for stop in row.least_stops] == minifeed.LEAST
    assert tuple(row.route_stats) == (4, 1.5, 3)


def test_all_tables_are_landed_and_landed_days_are_not_read_again(spark, tmp_path):
    roots = {land_feeds: minifeed.write_directories(tmp_path / "feed"), land_archives: minifeed.write_archives(tmp_path / "zips")}
    calendar = "service_id,monday\ns1,1\n"
    (tmp_path / "feed/sweden-20251002/calendar.txt").write_text(calendar)
    with zipfile.ZipFile(tmp_path / "zips/sweden-20251002.zip", "a") as archive:
        archive.writestr("calendar.txt", calendar)
    landed = []
    for way, root in roots.items():
        lake = tmp_path / way.__name__
        way(spark, root, str(lake), minifeed.PERIOD)
        landed.append({d.name: read_landed(spark, str(d)) for d in sorted(lake.iterdir())})
    assert set(landed[0]) == set(landed[1]) == {*SUMMARY_TABLES, "calendar"}
    for name, rows in landed[0].items():
        other = landed[1][name].select(*rows.columns)
        assert set(landed[1][name].columns) == set(rows.columns) and rows.count() == other.count()
        assert rows.exceptAll(other).count() == other.exceptAll(rows).count() == 0
    for file in (tmp_path / "zips").iterdir():
        file.write_text("no archive any more")
    needed = minifeed.PERIOD
    before = {t: read_landed(spark, str(tmp_path / "land_archives" / t)).count() for t in SUMMARY_TABLES}
    for table, path, days in _to_land(spark, str(tmp_path / "land_archives"), needed, "keep"):
        assert table not in before, (path, days)


def test_a_gap_is_an_error(spark, feed_root, tmp_path):
    lake, output = str(tmp_path / "lake"), str(tmp_path / "out")
    land_feeds(spark, feed_root, lake, minifeed.PERIOD)
    longer = Period.parse("2025-10-01", "2025-10-03")
    with pytest.raises(ValueError, match="2025-10-03"):
        run_summary(spark, lake, longer, output, MADE_AT)
    assert run_summary(spark, lake, longer, output, MADE_AT, allow_gaps=True).count() == 1


def test_years_of_days_are_put_together_quickly(spark):
    start = time.perf_counter()
    both = union_days(spark.sql(f"SELECT {i} AS {'a' if i % 2 else 'b'}") for i in range(730))
    assert set(both.columns) == {"a", "b"} and time.perf_counter() - start < 30


def test_summary_of_an_empty_day(spark, feed_root, tmp_path):
    lake = str(tmp_path / "lake")
    land_feeds(spark, feed_root, lake, minifeed.PERIOD)
    nothing = Period.parse("2025-11-01", "2025-11-01")
    document = summary_document(landed_tables(spark, lake, nothing), nothing)
    row = document.first()
    assert row.counts.asDict() == dict.fromkeys(SUMMARY_TABLES, 0)
    assert row.top_stops == [] and row.least_stops == []
    assert tuple(row.route_stats) == (0, None, 0)
    assert documents.chart_series(document).count() == 0
    assert documents.document_lists(document).count() == 0
    lines = [row.line for row in reports.report_lines(document, MADE_AT).orderBy("line_no").collect()]
    assert lines[-2:] == ["- Total unique routes: 0", "- Average trips per route: n/a"]


def test_landing_replaces_or_refuses(spark, tables, tmp_path):
    path = str(tmp_path / "trips")
    trips = tables["trips"]
    land(trips, path, "fail")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        land(trips, path, "fail")
    land(trips.filter("feed_date = '2025-10-02'").limit(1), path, "replace")
    assert {(str(d), n) for d, n in rows(read_landed(spark, path).groupBy("feed_date").count())} == {
        ("2025-10-01", 3),
        ("2025-10-02", 1),
    }
    with pytest.raises(ValueError):
        land(trips, path, "other")


@pytest.mark.parametrize("day_by_day", [False, True])
def test_landing_nothing_new(spark, tables, tmp_path, day_by_day):
    path = str(tmp_path / "trips")
    trips = tables["trips"]
    land(trips.filter("trip_id = 'none such'"), path, day_by_day=day_by_day)
    assert present_days(spark, path) == set()
    for _ in range(2):
        land(trips, path, day_by_day=day_by_day)
        assert read_landed(spark, path).count() == trips.count()
    assert present_days(spark, path) == set(minifeed.PERIOD)


def test_a_day_without_its_mark_is_written_again(spark, tables, tmp_path):
    path = str(tmp_path / "trips")
    trips = tables["trips"]
    first = trips.filter("feed_date = '2025-10-01'")
    first.limit(1).write.partitionBy("feed_date").parquet(path)  # what a run left that died before it marked the day
    assert present_days(spark, path) == set()
    land(first, path)
    assert present_days(spark, path) == {minifeed.PERIOD.start}
    land(trips.unionByName(first), path)  # the first day is kept, the second is new
    got = rows(read_landed(spark, path).groupBy("feed_date").count())
    assert {(str(d), n) for d, n in got} == {("2025-10-01", 3), ("2025-10-02", 3)}

"""Column functions against plain Python on many values."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stopline.functions import dates, paths, text
from stopline.operators import lines
from stopline.period import Period

SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))

# Without surrogates, and without letters whose case changes their number.
letters = st.text(st.sampled_from("abzABZåÄö059 _-/.\t\n\x0b\x1c\x85  　​'"), max_size=40)
texts = st.lists(letters, min_size=1, max_size=50)


def apply(spark, values, kind, column):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, x {kind}")
    return [row[0] for row in frame.orderBy("i").select(column(F.col("x"))).collect()]


@SETTINGS
@given(st.lists(st.floats(0, 1e7) | st.integers(0, 10**6).map(lambda n: n / 20), min_size=1, max_size=200))
def test_one_decimal(spark, values):
    assert apply(spark, values, "DOUBLE", text.one_decimal) == [f"{v:.1f}" for v in values]


def test_one_decimal_near_ties(spark):
    values = [k / 20 for k in range(5000)] + [k / 1024 for k in range(3000)] + [k / 7 for k in range(3000)]
    assert apply(spark, values, "DOUBLE", text.one_decimal) == [f"{v:.1f}" for v in values]


@SETTINGS
@given(st.lists(st.integers(0, 2**50), min_size=1, max_size=100))
def test_numbers(spark, values):
    assert apply(spark, values, "BIGINT", text.with_thousands) == [f"{v:,}" for v in values]
    assert apply(spark, [v % 200 for v in values], "BIGINT", text.rank_label) == [f"{v % 200:2d}" for v in values]
    assert apply(spark, [str(v) for v in values], "STRING", paths.to_bytes) == values


@SETTINGS
@given(texts)
def test_names_and_paths(spark, values):
    values = [*values, None]
    some = values[:-1]
    assert apply(spark, values, "STRING", text.name_or_unknown) == [v or "Unknown" for v in values]
    assert apply(spark, some, "STRING", lambda c: text.clip(c, 5)) == [v[:5] for v in some]
    assert apply(spark, some, "STRING", text.title_case) == [v.title() for v in some]
    assert apply(spark, some, "STRING", paths.base_name) == [v.split("/")[-1] for v in some]
    assert apply(spark, some, "STRING", paths.parent_path) == ["/".join(v.split("/")[:-1]) for v in some]
    assert apply(spark, some, "STRING", lambda c: paths.without_prefix(c, "ab")) == [v.replace("ab", "") for v in some]


@SETTINGS
@given(texts)
def test_lines(spark, values):
    for keep, plain in (
        (None, lambda line: True),
        (lines.has_content, lambda line: bool(line.strip())),
        (lines.lacks_prefix("a"), lambda line: bool(line.strip()) and not line.startswith("a")),
        (lines.has_fields(2), lambda line: len(line.split()) >= 2),
    ):
        got = apply(spark, values, "STRING", lambda c, keep=keep: lines.count_lines(c, keep))
        assert got == [sum(plain(line) for line in v.split("\n")) for v in values]


def test_lines_of_no_text(spark):
    assert apply(spark, [None], "STRING", lines.count_lines) == [0]


def test_size_labels(spark):
    cases = {
        0: "0 B",
        1023: "1023 B",
        1024: "1.0 KB",
        1280: "1.2 KB",
        1792: "1.8 KB",
        1048575: "1024.0 KB",
        1048576: "1.0 MB",
        5 * 2**30: "5120.0 MB",
        None: None,
    }
    assert apply(spark, list(cases), "BIGINT", paths.size_label) == list(cases.values())


def test_text_that_is_no_number_or_date(spark):
    assert apply(spark, ["12", "x", "", None], "STRING", paths.to_bytes) == [12, None, None, None]
    assert apply(spark, ["2025-10-01", "1 Oct", None], "STRING", dates.parse_day) == [date(2025, 10, 1), None, None]


@SETTINGS
@given(st.dates(date(1990, 1, 1), date(2050, 1, 1)), st.integers(0, 400))
def test_period(spark, start, length):
    period = Period(start, start + timedelta(days=length))
    days = [row[0] for row in period.days(spark).orderBy("feed_date").collect()]
    assert days == list(period)
    assert len(days) == period.num_days == length + 1
    row = spark.createDataFrame([(start, period.end)], "a DATE, b DATE").select(
        dates.day_count(F.col("a"), F.col("b")),
        dates.feed_key(F.col("a")),
        dates.month_key(F.col("a")),
        dates.next_day(F.col("a")),
        F.size(dates.days_between(F.col("b"), F.col("a"))),
    )
    assert tuple(row.first()) == (
        length + 1,
        start.strftime("%Y%m%d"),
        start.strftime("%Y-%m"),
        start + timedelta(days=1),
        0 if length else 1,
    )


def test_period_is_never_empty():
    with pytest.raises(ValueError, match="empty period"):
        Period.parse("2025-10-02", "2025-10-01")


def test_period_of_times_takes_whole_days(spark):
    moments = ["2025-09-30 23:59:59.999999", "2025-10-01 00:00:00", "2025-10-02 23:59:59.999999", "2025-10-03 00:00:00"]
    frame = spark.createDataFrame([(m,) for m in moments], "m STRING").select(F.col("m").cast("timestamp_ntz").alias("m"))
    inside = frame.select(Period.parse("2025-10-01", "2025-10-02").has_time(F.col("m"))).collect()
    assert [row[0] for row in inside] == [False, True, True, False]


def test_day_paths_are_those_of_the_sources(spark):
    from stopline.sources import archives, feed_csv

    days = [date(2024, 2, 29), date(1999, 12, 1), None]
    got = apply(spark, days, "DATE", lambda d: paths.day_path(d, f"/a b/q/{archives.ARCHIVE_FILE}"))
    assert got == [d and archives.archive_path("/a b/q", d) for d in days]
    got = apply(spark, days, "DATE", lambda d: paths.day_path(d, f"/x/{feed_csv.DAY_DIRECTORY}/{feed_csv.TABLE_FILE.format(table='stops')}"))
    assert got == [d and feed_csv.table_path("/x", d, "stops") for d in days]

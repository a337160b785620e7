"""The text report and the JSON document of a summary."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopline.functions.text import clip, name_or_unknown, one_decimal, rank_label, with_thousands
from stopline.schemas import LIST_SIZE

# The wording of the report.
TITLE = "GTFS Analytics Summary - "
PERIOD = "Analysis Period: "
PERIOD_TO = " to "
NUM_DAYS = "Number of days: "
COUNTS = "Dataset Summary:"
COUNT_LABELS = {
    "agency": "- Agency records: ",
    "routes": "- Routes records: ",
    "stops": "- Stops records: ",
    "trips": "- Trips records: ",
    "stop_times": "- Stop times records: ",
}
TOP_STOPS = "Top {k} Most Visited Stops (Average per Day):"
LEAST_STOPS = "Top {k} Least Visited Stops (Average per Day):"
STOP_UNIT = " avg visits/day)"
ROUTES = "Route Statistics:"
TOTAL_ROUTES = "- Total unique routes: "
AVERAGE_TRIPS = "- Average trips per route: "
NO_AVERAGE = "n/a"
DAYS_LOADED = "Days Loaded:"
DAY_LABELS = {
    "agency": "- Agency: ",
    "routes": "- Routes: ",
    "stops": "- Stops: ",
    "trips": "- Trips: ",
    "stop_times": "- Stop times: ",
}
WIDE_RULE = "=" * 50
LIST_RULE = "-" * 50
ROUTE_RULE = "-" * 30
TIME_FORMAT = "%Y-%m-%d %H:%M:%S"
FILE_TIME_FORMAT = "%Y%m%d_%H%M%S"
FILE_STEM = "gtfs_summary_"


def report_lines(document: DataFrame, made_at: datetime, k: int = LIST_SIZE, with_days: bool = False) -> DataFrame:
    """``(line_no, section, line)`` of the text report, from the one-row result document.

    ``with_days`` adds a last section with the days that each table has.
    """
    sections = {
        "title": [F.lit(TITLE + made_at.strftime(TIME_FORMAT)), F.lit(WIDE_RULE)],
        "period": [
            F.concat(F.lit(PERIOD), F.col("period.start_date"), F.lit(PERIOD_TO), F.col("period.end_date")),
            F.concat(F.lit(NUM_DAYS), F.col("period.num_days").cast("string")),
        ],
        "counts": [F.lit(COUNTS)]
        + [F.concat(F.lit(text), with_thousands(F.col(f"counts.{name}"))) for name, text in COUNT_LABELS.items()],
        "top_stops": [F.lit(TOP_STOPS.format(k=k)), F.lit(LIST_RULE), F.col("top_stops")],
        "least_stops": [F.lit(LEAST_STOPS.format(k=k)), F.lit(LIST_RULE), F.col("least_stops")],
        "routes": [
            F.lit(ROUTES),
            F.lit(ROUTE_RULE),
            F.concat(F.lit(TOTAL_ROUTES), with_thousands(F.col("route_stats.total_routes"))),
            F.concat(
                F.lit(AVERAGE_TRIPS),
                F.coalesce(one_decimal(F.col("route_stats.avg_trips_per_route")), F.lit(NO_AVERAGE)),
            ),
        ],
    }
    if with_days:
        known = [
            F.concat(F.lit(label), F.coalesce(F.col(f"days_loaded.{name}").cast("string"), F.lit(NO_AVERAGE)))
            for name, label in DAY_LABELS.items()
        ]
        sections["days"] = [F.lit(DAYS_LOADED), F.lit(ROUTE_RULE), *known]
    parts = []
    for at, (section, lines) in enumerate(sections.items()):
        if section.endswith("_stops"):
            *head, stops = lines
            text = F.concat(F.array(*head), F.transform(stops, _stop_line))
        else:
            text = F.array(*lines)
        if at < len(sections) - 1:
            text = F.concat(text, F.array(F.lit("")))
        parts.append(_in_section(text, section))
    return document.select(F.posexplode(F.concat(*parts)).alias("_at", "_line")).select(
        (F.col("_at") + 1).cast("bigint").alias("line_no"), "_line.*"
    )


def _in_section(lines: Column, section: str) -> Column:
    return F.transform(lines, lambda line: F.struct(F.lit(section).alias("section"), line.alias("line")))


def _stop_line(stop: Column, at: Column) -> Column:
    return F.concat(
        rank_label(at + 1),
        F.lit(". "),
        clip(name_or_unknown(stop["stop_name"])),
        F.lit(" ("),
        one_decimal(stop["avg_visits_per_day"]),
        F.lit(STOP_UNIT),
    )


def result_path(output: str, made_at: datetime, suffix: str) -> str:
    return f"{output.rstrip('/')}/{FILE_STEM}{made_at.strftime(FILE_TIME_FORMAT)}.{suffix}"


def write_report(lines: DataFrame, path: str) -> None:
    """The report as one text file. It has a hundred lines at most, so one task is enough."""
    lines.orderBy("line_no").select("line").coalesce(1).write.text(path)


def write_document(document: DataFrame, path: str) -> None:
    """The result document as one indented JSON file; characters outside ASCII are kept as they are."""
    columns = F.struct(*[F.col(name) for name in document.columns])
    text = F.to_json(columns, {"pretty": "true", "ignoreNullFields": "false"})
    document.select(text.alias("value")).coalesce(1).write.text(path)

"""Which tables each day's feed has."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopline.functions.text import required_mark
from stopline.schemas import FEED_DATE, FEED_MANIFEST

_KEY = [FEED_DATE, "table_name"]


def expected_tables(days: DataFrame, manifest: Sequence[tuple[str, bool]] = FEED_MANIFEST) -> DataFrame:
    """``(feed_date, table_name, required)``: the manifest written out for each day."""
    entries = F.array(*[F.struct(F.lit(name).alias("table_name"), F.lit(need).alias("required")) for name, need in manifest])
    return days.select(FEED_DATE, F.inline(entries))


def observed_tables(rows: DataFrame) -> DataFrame:
    """``(feed_date, table_name, n_records)`` from rows that carry day and table name; a table is found if it has a row."""
    return rows.groupBy(*_KEY).agg(F.count("*").alias("n_records"))


def found_tables(expected: DataFrame, observed: DataFrame) -> DataFrame:
    return expected.join(observed, _KEY, "left_semi")


def missing_tables(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """Required tables that a day lacks; a missing optional table is no fault."""
    return expected.filter("required").join(observed, _KEY, "left_anti").select(*_KEY)


def completeness(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """``(feed_date, table_name, marker, required, found, n_records)`` for each day and expected table."""
    return expected.join(observed, _KEY, "left").select(
        *_KEY,
        required_mark(F.col("required")).alias("marker"),
        "required",
        F.col("n_records").isNotNull().alias("found"),
        F.coalesce("n_records", F.lit(0)).alias("n_records"),
    )


def verdicts(complete: DataFrame) -> DataFrame:
    """Per day, from :func:`completeness`: how many tables were found, and whether all required ones were."""
    required, found = F.col("required"), F.col("found")
    return complete.groupBy(FEED_DATE).agg(
        F.count_if(required).alias("required_tables"),
        F.count_if(required & found).alias("required_found"),
        F.count_if(~required & found).alias("optional_found"),
        F.bool_and(~required | found).alias("complete"),
    )

"""Saved result documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopline.schemas import DOCUMENT_SCHEMA, LIST_SIZE


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """A result document as one nested row."""
    return spark.read.schema(DOCUMENT_SCHEMA).json(path, multiLine=True)


def document_lists(document: DataFrame, k: int = LIST_SIZE) -> DataFrame:
    """The first ``k`` entries of both stop lists as rows: ``(list_name, position, stop_id, ..., avg_visits_per_day)``.

    An empty list contributes no rows.
    """
    parts = [
        document.select(F.lit(name).alias("list_name"), F.posexplode(_head(name, k)).alias("_at", "_stop"))
        for name in ("top_stops", "least_stops")
    ]
    return parts[0].unionByName(parts[1]).select(
        "list_name", (F.col("_at") + 1).cast("bigint").alias("position"), "_stop.*"
    )


def chart_series(document: DataFrame, k: int = LIST_SIZE) -> DataFrame:
    """What a bar chart of each list needs: ``(list_name, stop_names, avg_visits)``, two arrays of equal length.

    A list without entries has no chart, hence no row.
    """
    parts = [
        document.filter(F.size(name) > 0).select(
            F.lit(name).alias("list_name"),
            _head(name, k)["stop_name"].alias("stop_names"),
            _head(name, k)["avg_visits_per_day"].alias("avg_visits"),
        )
        for name in ("top_stops", "least_stops")
    ]
    return parts[0].unionByName(parts[1])


def _head(name: str, k: int):
    return F.slice(F.col(name), 1, k)

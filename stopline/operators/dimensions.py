"""One row per key from many snapshots of a dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopline.schemas import FEED_DATE


def latest_snapshot(
    rows: DataFrame, key: str, values: Sequence[str], newest: Sequence[str | Column] = (FEED_DATE,), few_keys: bool = False
) -> DataFrame:
    """``(key, *values)`` of the newest row of each key.

    ``newest`` orders the rows of a key, the day first; give enough columns to make the choice unique. The newest day of each
    key is a hash aggregate over two columns of fixed width, which keeps one candidate per key and task before the shuffle.
    Only rows of that day then meet the rest of the order and the values: by a join with one row per key, which adaptive
    execution broadcasts if it turns out small, and whose other side spreads a key of many snapshots over its days.
    Rows of ``few_keys`` are read once and aggregated as they are, one candidate per key and task, which sorts them.
    """
    if few_keys:
        best = F.max_by(F.struct(*values), F.struct(*newest))
        return rows.groupBy(key).agg(best.alias("_row")).select(key, *[F.col(f"_row.{v}").alias(v) for v in values])
    day, *rest = [F.col(c) if isinstance(c, str) else c for c in newest]
    days = rows.groupBy(key).agg(F.max(day).alias("_newest")).withColumnRenamed(key, "_key")
    of_day = rows.withColumn("_day", day).join(days, F.col(key).eqNullSafe(F.col("_key")) & F.col("_day").eqNullSafe(F.col("_newest")))
    order = F.struct(*rest) if rest else F.struct(*values)
    best = F.max_by(F.struct(*values), order)
    return of_day.groupBy(key).agg(best.alias("_row")).select(key, *[F.col(f"_row.{v}").alias(v) for v in values])


def latest_stops(stops: DataFrame, few_keys: bool = False) -> DataFrame:
    """``(stop_id, stop_name)`` as of the newest snapshot; among several names of that day the greatest."""
    name = F.coalesce("stop_name", F.lit(""))
    return latest_snapshot(stops, "stop_id", ["stop_name"], [FEED_DATE, name], few_keys)

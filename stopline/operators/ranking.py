"""Most and least visited stops."""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopline.functions.text import name_or_unknown
from stopline.operators.dimensions import latest_stops
from stopline.scratch import run_folder

# Up to this many ranked stops (some numbers each, so about 1 MiB) may be sent to all executors.
_SMALL_LIST = 10_000

# Fixed value: the low bits of monotonically_increasing_id, which count inside a partition.
_PART_BITS = 33

_COLUMNS = ("stop_id", "stop_name", "total_visits", "avg_visits_per_day")


def list_order(ascending: bool) -> list[Column]:
    """By total; equal totals by stop, a missing stop last."""
    total = F.col("total_visits")
    return [total.asc() if ascending else total.desc(), F.col("stop_id").asc_nulls_last()]


def extreme_stops(per_stop: DataFrame, k: int, ascending: bool = False) -> DataFrame:
    """The ``k`` most (or least) visited stops. Stops that are never visited are not in ``per_stop``, hence not here."""
    return per_stop.orderBy(*list_order(ascending)).limit(k)


def with_names(per_stop: DataFrame, stops: DataFrame, few: bool = False) -> DataFrame:
    """Every counted stop with its newest name; ``Unknown`` where there is none.

    Both sides are one row per stop and hashed on ``stop_id`` by their aggregates, so the join adds no shuffle and no key
    can be hot in it.
    """
    named = per_stop.join(latest_stops(stops, few), "stop_id", "left")
    return named.withColumn("stop_name", name_or_unknown(F.col("stop_name"))).select(*_COLUMNS)


def ranked_stops(per_stop: DataFrame, ascending: bool = False) -> DataFrame:
    """Every stop with its 1-based ``rank`` in a list of all of them, however many there are.

    Stops are sorted by ranges, and each range is written once, in order, to the shared folder; a stop's rank is its place in
    its range after the sizes of the ranges before, of which the driver gets one number each. No task sees more than a range.
    """
    spark, order = per_stop.sparkSession, list_order(ascending)
    folder = run_folder(spark, "ranked-stops")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = per_stop.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed.write.parquet(folder)
    part, inside = F.shiftright("_at", _PART_BITS), F.col("_at").bitwiseAND(F.lit((1 << _PART_BITS) - 1))
    rows = spark.read.schema(placed.schema).parquet(folder).withColumns({"_part": part, "_inside": inside})
    sizes = sorted(tuple(r) for r in rows.groupBy("_part").count().collect())
    before = accumulate((n for _, n in sizes), initial=0)
    starts = spark.createDataFrame([(p, b) for (p, _), b in zip(sizes, before)], "_part BIGINT, _before BIGINT")  # noqa: B905
    ranked = rows.join(F.broadcast(starts), "_part")
    return ranked.select(*per_stop.columns, (F.col("_before") + F.col("_inside") + 1).alias("rank"))


def named_list(per_stop: DataFrame, stops: DataFrame, k: int, ascending: bool = False) -> DataFrame:
    """The ``k`` most (or least) visited stops with names, in order.

    The order needs no names, so the list is cut first and only the snapshots of its stops are looked at. Spark does not
    move a limit below a left join by itself.
    """
    if k > _SMALL_LIST:  # cut where the ranges of all stops are known, named by a join, sorted by ranges again
        chosen = ranked_stops(per_stop, ascending).filter(F.col("rank") <= k).drop("rank")
        return with_names(chosen, stops).orderBy(*list_order(ascending))
    chosen = _computed_once(extreme_stops(per_stop, k, ascending))
    return with_names(chosen, _snapshots_of(chosen, stops), few=True).orderBy(*list_order(ascending)).limit(k)


def named_lists(per_stop: DataFrame, stops: DataFrame, k: int) -> DataFrame:
    """Both lists at once: ``(list_name, rank, stop_id, stop_name, total_visits, avg_visits_per_day)``."""
    lists = [(name, _first_ranks(per_stop, k, ascending)) for name, ascending in (("top_stops", False), ("least_stops", True))]
    both = reduce(DataFrame.unionByName, (chosen.withColumn("list_name", F.lit(name)) for name, chosen in lists))
    few = 2 * k <= _SMALL_LIST
    if few:
        both = _computed_once(both)
        stops = _snapshots_of(both, stops)
    named = both.join(latest_stops(stops, few), "stop_id", "left")
    named = named.withColumn("stop_name", name_or_unknown(F.col("stop_name")))
    return named.select("list_name", "rank", *_COLUMNS)


def _first_ranks(per_stop: DataFrame, k: int, ascending: bool) -> DataFrame:
    if 2 * k > _SMALL_LIST:
        return ranked_stops(per_stop, ascending).filter(F.col("rank") <= k)
    return with_rank(extreme_stops(per_stop, k, ascending), ascending)


def with_rank(chosen: DataFrame, ascending: bool = False) -> DataFrame:
    """A 1-based ``rank`` of a short list. The window is one task; :func:`ranked_stops` is for whole tables."""
    place = F.row_number().over(Window.orderBy(*list_order(ascending)))
    return chosen.withColumn("rank", place.cast("bigint"))


def _computed_once(few: DataFrame) -> DataFrame:
    """The same few rows, from a scalar subquery: used twice in a query, they are computed once.

    Without it the reduce side of the counts would be read again for each use.
    """
    rows = few.agg(F.collect_list(F.struct("*")).alias("rows"))
    return few.sparkSession.range(0, 1, 1, 1).select(F.inline(rows.scalar()))


def _snapshots_of(few: DataFrame, stops: DataFrame) -> DataFrame:
    return stops.join(F.broadcast(few.select("stop_id")), "stop_id", "left_semi")

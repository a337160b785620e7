"""Helpers of the text operators: words, row keys, running totals, size-checked broadcasts, connected components."""

from __future__ import annotations

import string
import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: The six ASCII blanks, as a character class for Java's and DuckDB's patterns.
BLANKS = r"\x20\x09-\x0D"
#: Rows up to which a table of a few numbers a row is broadcast; it is counted first.
BROADCAST_ROWS = 200_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words_of(text: Column, pattern: str = f"[^{BLANKS}]+") -> Column:
    """The words of a text; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({pattern})"), F.lit(1))


def text_key(text: Column) -> Column:
    """With doc_id it tells rows apart; rows that agree in both are the same document and get the same answer."""
    return F.xxhash64(text)


def cut(frame: DataFrame) -> DataFrame:
    """The rows, saved in the folder all executors share, so that lost executors cost no recomputation."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        named = frame.sparkSession.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="stopline-"))
    return frame.checkpoint()


def carrying(documents: DataFrame, run: Callable[[DataFrame], DataFrame], *added: str) -> DataFrame:
    """``run`` of documents whose columns that begin with ``_`` have other names meanwhile: helper columns begin so.

    Documents that already have a column which ``run`` is there to add are refused.
    """
    own = [c for c in documents.columns if c.startswith("_")]
    if clash := sorted(set(map(str.lower, own)) & set(added)):
        raise ValueError(f"the documents already have columns named {', '.join(clash)}")
    free = (n for i in range(10**6) if (n := f"carried {i}") not in documents.columns)
    names = dict(zip(own, free, strict=False))
    return run(documents.withColumnsRenamed(names)).withColumnsRenamed({n: c for c, n in names.items()})


def small(saved: DataFrame, held: str | None = None) -> DataFrame:
    """Marks a saved table for broadcast if it has been counted to be small; otherwise a join shuffles it.

    ``held``: a column of arrays, whose elements are counted instead of rows.
    """
    if held is None:
        few = saved.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    else:
        few = (saved.agg(F.sum(F.size(held) + 1)).first()[0] or 0) <= BROADCAST_ROWS
    return F.broadcast(saved) if few else saved


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running(frame: DataFrame, order: list[str], sums: dict[str, str], within: list[str] | None = None) -> DataFrame:
    """Adds for each ``name: column`` of ``sums`` the column's sum over the rows before, and as ``name_total`` over all.

    Rows are dealt out by ranges of ``within`` and ``order``, summed in each part, and each part gets the totals of the
    parts before it, so that no task sees more than a part, however large a group is. ``within`` must not be null.
    """
    within = within or []
    keys = ["_part", *within]
    ranged = frame.repartitionByRange(partitions(frame.sparkSession), *within, *order)
    dealt = cut(ranged.withColumn("_part", F.spark_partition_id()))
    parts = dealt.groupBy(*keys).agg(*(F.sum(c).alias(f"_sum_{n}") for n, c in sums.items()))
    earlier = W.partitionBy(*within).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*within)
    parts = parts.select(
        *keys,
        *(F.coalesce(F.sum(f"_sum_{n}").over(earlier), F.lit(0)).alias(f"_before_{n}") for n in sums),
        *(F.sum(f"_sum_{n}").over(whole).alias(f"{n}_total") for n in sums),
    )
    mine = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    inside = dealt.withColumns({f"_in_{n}": F.coalesce(F.sum(c).over(mine), F.lit(0)) for n, c in sums.items()})
    return (
        inside.join(parts, keys)
        .withColumns({n: F.col(f"_before_{n}") + F.col(f"_in_{n}") for n in sums})
        .drop("_part", *(f"_before_{n}" for n in sums), *(f"_in_{n}" for n in sums))
    )


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` of the graph with links ``(a, b)``: the smallest node that can be reached.

    Each round takes the smallest label of the neighbours, then the label's own label, so that the rounds grow with the
    logarithm of a component's diameter. Only nodes with a link appear.
    """
    links = links.filter("a <> b")
    both = cut(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")))
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("near"))
        hooked = labels.join(near, F.col("node") == F.col("a")).select("node", "root", F.least("root", "near").alias("low"))
        upper = labels.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
        new = cut(
            hooked.join(upper, F.col("low") == F.col("_node")).select(
                "node", F.least("low", "_root").alias("root"), (F.least("low", "_root") < F.col("root")).alias("moved")
            )
        )
        labels = new.select("node", "root")
        if new.filter("moved").isEmpty():
            return labels

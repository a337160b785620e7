"""Sharding: contiguous shards of nearly equal bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopline.llm.common import carrying, running

SHARDS = 16


def sharded(documents: DataFrame, count: int = SHARDS) -> DataFrame:
    """The documents with all their columns and ``_size``, ``_text_crc32``, ``_shard``, ``_slot``, cut by bytes.

    In order of doc_id they are cut where the bytes so far pass a target. Size is the UTF-8 bytes of the text plus 1 (null
    text: no bytes). The order is doc_id with null first, then checksum and size; a document belongs to the shard its
    middle byte falls into, so a shard misses its target by half a document at each end at most. ``_slot`` counts the
    documents of a shard from 0. Rows that agree in id, checksum and size follow each other in any order; a number that
    tells them apart lets them spread over tasks. No rows give no shards.
    """
    added = "_size", "_text_crc32", "_shard", "_slot"
    return carrying(documents, lambda rows: _placed(_sized(rows), count).select(*(f"`{c}`" for c in rows.columns), *added), *added)


def shards(documents: DataFrame, count: int = SHARDS) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)`` of ``sharded`` documents, for which no texts travel."""
    placed = _placed(_sized(documents.select("doc_id", "text")).select("doc_id", "_order", "_size", "_text_crc32"), count)
    return placed.select("doc_id", *(F.col(f"_{c}").alias(c) for c in ("size", "text_crc32", "shard", "slot")))


def _sized(documents: DataFrame) -> DataFrame:
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")
    return documents.withColumns({"_order": F.col("doc_id"), "_size": size, "_text_crc32": F.crc32(F.coalesce("text", F.lit("")))})


def _placed(rows: DataFrame, count: int) -> DataFrame:
    told = rows.withColumns({"_one": F.lit(1).cast("long"), "_tie": F.monotonically_increasing_id()})
    summed = running(told, ["_order", "_text_crc32", "_size", "_tie"], {"_start": "_size", "_row": "_one"})
    each = summed.withColumn("_middle", 2 * F.col("_start") + F.col("_size"))
    each = each.withColumn("_shard", F.expr(f"cast((_middle * {count}) div (2 * _start_total) as int)"))
    firsts = each.groupBy(F.col("_shard").alias("_of")).agg(F.min("_row").alias("_first"))
    return each.join(F.broadcast(firsts), F.col("_shard") == F.col("_of")).withColumn("_slot", F.col("_row") - F.col("_first"))

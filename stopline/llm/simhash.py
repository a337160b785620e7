"""Near-duplicates by SimHash fingerprints, linked by multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stopline.llm.common import carrying, components, cut

SHINGLE = 3
SEED = 42
#: Differing bits up to which fingerprints link: what the two segments and the radii of their balls are made for.
DISTANCE = 2
#: The bits of the lower segment.
LOWER = (1 << 32) - 1
#: Fingerprints with one value of a segment, above which they are not compared pair by pair.
CROWD = 64
_CHUNK = 1 << 15


def fingerprint(text: str) -> np.int64:
    """A bit is set if it is set in over half the hashes of the text's shingles; 0 for a text without words."""
    words = text.encode().lower().split()  # of bytes: both know ASCII only
    if not words:
        return np.int64(0)
    if len(words) < SHINGLE:
        shingles, n = [b" ".join(words)], 1
    else:
        shingles, n = map(b" ".join, zip(words, words[1:], words[2:], strict=False)), len(words) - SHINGLE + 1
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64, n)
    set_bits = sum(
        np.unpackbits(hashes[i : i + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64) for i in range(0, n, _CHUNK)
    )
    return np.packbits(2 * set_bits > n).view(np.int64)[0]


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [fingerprint(t or "") for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "text_key": batch["text_key"], "print": pa.array(prints, pa.int64())})


def _half(print_: Column, segment: Column) -> Column:
    """A segment of a fingerprint: 0 its upper 32 bits, 1 its lower."""
    return F.when(segment == 0, F.shiftrightunsigned(print_, 32)).otherwise(print_.bitwiseAND(F.lit(LOWER)))


def _index(prints: DataFrame) -> DataFrame:
    """``(segment, value, print, held)``: every fingerprint under the value of each segment, and how many are there."""
    each = prints.select(F.explode(F.array(F.lit(0), F.lit(1))).alias("segment"), "print")
    index = each.select("segment", _half(F.col("print"), F.col("segment")).alias("value"), "print")
    sizes = index.groupBy("segment", "value").agg(F.count("*").alias("held")).filter(F.col("held") > CROWD)
    crowded = cut(sizes)  # few: at most 2 in CROWD fingerprints
    return cut(index.join(crowded, ["segment", "value"], "left").withColumn("held", F.coalesce("held", F.lit(0).cast("long"))))


def _lookups(prints: DataFrame) -> DataFrame:
    """``(segment, value, from, away)``: the values to look a fingerprint up by, and whether they are a bit from its own.

    Two bits are split over two segments so that the upper ones differ in one bit at most, or the lower ones are equal. So
    the upper segment has a ball of one bit, the lower one of none. Of two values that one bit tells apart, the one with the
    bit set is looked up by the one without it, never the other way round: a ball needs only the bits that are set.
    """
    upper = _half(F.col("print"), F.lit(0))
    bits = F.array(*(F.lit(1 << bit).cast("long") for bit in range(32)))
    near = F.transform(F.filter(bits, lambda bit: upper.bitwiseAND(bit) != 0), lambda bit: upper.bitwiseXOR(bit))

    def lookup(segment: int, value: Column, away: bool) -> Column:
        return F.struct(F.lit(segment).alias("segment"), value.alias("value"), F.lit(away).alias("away"))

    own = F.array(lookup(0, upper, False), lookup(1, _half(F.col("print"), F.lit(1)), False))
    return prints.select(F.col("print").alias("from"), F.inline(F.concat(own, F.transform(near, lambda value: lookup(0, value, True)))))


def matches(prints: DataFrame) -> DataFrame:
    """``(a, b)`` that multi-index hashing compares: pairs of distinct fingerprints that a lookup brings together.

    Values of more than ``CROWD`` fingerprints are not compared pair by pair, see ``_crowds``.
    """
    return _compared(_index(prints), _lookups(prints))


def _compared(index: DataFrame, lookups: DataFrame) -> DataFrame:
    met = lookups.join(index.filter("held = 0"), ["segment", "value"])
    once = F.col("away") | (F.col("from") < F.col("print"))  # equal values find each other both ways
    return met.filter(once).select(F.least("from", "print").alias("a"), F.greatest("from", "print").alias("b"))


def _crowds(index: DataFrame, lookups: DataFrame) -> DataFrame:
    """``(a, b)`` of the values of which there are more, by a ball of the other segment: no pairs, and nothing is lost.

    Under such a value, its own fingerprints are put at their other half and that half's 32 neighbours, and those that are a
    bit away at their other half only. Whoever is within 2 bits in all meets at such a place; who meets there is within 2
    bits, and a place holds 65 at most. Each is linked to the least there, which keeps all connected.
    """
    crowd = index.filter("held > 0")
    value = ["segment", "value"]
    bits = F.array(*(F.lit(step).cast("long") for step in (0, *(1 << bit for bit in range(32)))))
    other = _half(F.col("print"), 1 - F.col("segment"))
    own = crowd.select(*value, "print", F.explode(F.transform(bits, lambda bit: other.bitwiseXOR(bit))).alias("place"))
    guests = lookups.filter("away").join(crowd.select(*value).distinct(), value, "left_semi")
    guests = guests.select(*value, F.col("from").alias("print"), _half(F.col("from"), 1 - F.col("segment")).alias("place"))
    all_there = own.unionByName(guests).withColumn("least", F.min("print").over(W.partitionBy(*value, "place")))
    return all_there.select(F.col("least").alias("a"), F.col("print").alias("b")).filter("a <> b")


def links(prints: DataFrame) -> DataFrame:
    """``(a, b)`` between distinct fingerprints ``print``, so that the linked ones are those that 2 bits or fewer tell apart.

    Multi-index hashing: a table of the fingerprints under the values of two segments of 32 bits, small Hamming balls of
    those values looked up in it, and all 64 bits of what is found compared. A fingerprint has two rows in the table and
    about 18 lookups.
    """
    index, lookups = _index(prints), _lookups(prints)
    found = _compared(index, lookups).unionByName(_crowds(index, lookups))
    return found.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE).distinct()


def near_copies(documents: DataFrame) -> DataFrame:
    """``(doc_id, text_key, print, root, component_id)``: fingerprint, its component, and the component's smallest doc_id.

    Null text is empty and, like any text without words, has fingerprint 0. Equal fingerprints are one node. Null ids are
    never the smallest; a component of null ids only has none. Repeated rows are returned as often as they occur.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    each = cut(rows.mapInArrow(_fingerprints, "doc_id long, text_key long, print long"))
    prints = cut(each.groupBy("print").agg(F.min("doc_id").alias("first")))
    linked = components(links(prints.select("print"))).withColumnRenamed("node", "print")
    rooted = prints.join(linked, "print", "left").withColumn("root", F.coalesce("root", "print"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return each.join(rooted.join(smallest, "root").select("print", "root", "component_id"), "print")


def without_near_copies(documents: DataFrame) -> DataFrame:
    """The documents with all their columns, one of each component: the one with the smallest doc_id (of null ids, any)."""
    return carrying(documents, _without_near_copies)


def _without_near_copies(documents: DataFrame) -> DataFrame:
    kept = (
        near_copies(documents)
        .filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min(F.struct("doc_id", "text_key")).alias("_kept"))
        .select(F.col("_kept.doc_id").alias("_kept_id"), F.col("_kept.text_key").alias("_kept_text"))
    )
    named = documents.withColumn("_text_key", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("_kept_id")) & (F.col("_text_key") == F.col("_kept_text"))
    return named.join(kept, same, "left_semi").dropDuplicates(["doc_id", "_text_key"]).select(*(named[c] for c in documents.columns))

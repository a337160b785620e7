"""Trie of conversations: every distinct sequence of first turns is a node, with counts over its members and its subtree.

A prefix is named by a digest of 128 bits: the exclusive or of its turns' hashes, each taken with its place, so that parts of
a long conversation are hashed apart and put together. A digest that stood for two prefixes (two parents, last turns, depths
or sizes) is an error, not a merged node.

Conversations are cut into bands of ``BAND`` turns and dealt to shards. A shard enumerates its distinct digests and gives each
a slot by a minimal perfect hash whose slots hold the digest, so that a foreign one is found out. Counts are scattered into
flat arrays by slot and added up through the array of parent slots, deepest level first. What a node adds once (that it is a
leaf, its bytes) it adds in the shard of its smallest member; so shards just add up, and no shard needs to see all of a node.

Rows without conv_id belong to no conversation; other rows are ordered by turn (null first), equal turns by role and a hash of
the text, and repeated rows are turns of their own. A null role or text is empty.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stopline.llm.common import cut, partitions

#: Turns of a band; rows of a shard, on average.
BAND, SHARD_ROWS = 1024, 200_000
#: Turns of one conversation that find its description in one place; longer ones find copies of it.
CHUNK = 4096
#: The next state and the two mixing factors of the generator whose output deals digests to slots (fixed values).
_GOLDEN, _MIX_1, _MIX_2 = (np.uint64(v) for v in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def running_fold(frame: DataFrame, key: str, order: list[str], name: str, folds: dict[str, tuple[Callable, Callable]]) -> DataFrame:
    """Adds for each ``column: (fold, joined)`` the fold of that column over the key's rows up to this one, as ``name_column``.

    Rows are dealt out by ranges and folded in each part; the few keys that go on from part to part, one a part at most, take
    the folds of their earlier parts along, which ``joined`` adds. So one key may hold any share of the rows.
    """
    ranged = frame.repartitionByRange(partitions(frame.sparkSession), key, *order)
    dealt = cut(ranged.withColumn("_part", F.spark_partition_id()))
    totals = dealt.groupBy("_part", key).agg(*(fold(c).alias(f"_all_{c}") for c, (fold, _) in folds.items()))
    parts = W.partitionBy(key).orderBy("_part")
    earlier = parts.rowsBetween(W.unboundedPreceding, -1)
    brought = totals.select("_part", key, F.row_number().over(parts).alias("_nth"), *(fold(f"_all_{c}").over(earlier).alias(f"_to_{c}") for c, (fold, _) in folds.items()))
    brought = brought.filter("_nth > 1").drop("_nth")
    mine = W.partitionBy("_part", key).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = dealt.withColumns({f"_in_{c}": fold(c).over(mine) for c, (fold, _) in folds.items()})
    whole = inside.join(F.broadcast(brought), ["_part", key], "left")  # a part's first key alone can have earlier parts
    made = {f"{name}_{c}": joined(F.col(f"_in_{c}"), F.coalesce(f"_to_{c}", F.lit(0))) for c, (_, joined) in folds.items()}
    return whole.select(*frame.columns, *(v.alias(n) for n, v in made.items()))


def ordered_turns(table: DataFrame) -> DataFrame:
    """``(conv_id, pos, a, b, bytes)``: place from 0, two hashes of role and text, and the text's UTF-8 bytes."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = table.filter("conv_id IS NOT NULL").select(
        "conv_id",
        "turn",
        role.alias("role"),
        F.xxhash64(F.lit(1), role, text).alias("a"),
        F.xxhash64(F.lit(2), role, text).alias("b"),
        F.octet_length(text).cast("long").alias("bytes"),
        F.lit(1).alias("one"),
    )
    counted = running_fold(turns, "conv_id", ["turn", "role", "a", "b"], "to", {"one": (F.sum, lambda x, y: x + y)})
    return counted.select("conv_id", (F.col("to_one") - 1).alias("pos"), "a", "b", "bytes")


def spliced(turns: DataFrame, every: int, head: Column) -> tuple[DataFrame, DataFrame]:
    """Each conversation c behind the head of conversation ``c - c % every``, as ``(conv_id, depth, a, b, bytes)``, and all ids.

    ``head``: how many of c's first turns give way to as many of the other's, all if it has fewer, none if it is absent.
    Ids come as ``(conv_id, n)`` with the number of turns, which can be none.
    """
    lengths = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_own"))
    donor = F.col("conv_id") - F.col("conv_id") % every
    asked = lengths.select("conv_id", "n_own", donor.alias("donor"), head.cast("long").alias("head"))
    given = lengths.select(F.col("conv_id").alias("donor"), F.col("n_own").alias("n_donor"))
    known = asked.join(given, "donor", "left").withColumn("taken", F.least("head", F.coalesce("n_donor", F.lit(0))))
    known = cut(known.withColumn("n", F.col("taken") + F.greatest(F.col("n_own") - F.col("head"), F.lit(0))))

    most = 1 << 20  # turns of a head that are looked for in one place; heads are counted in turns, so this is ample
    longest = known.agg(F.max("taken")).first()[0] or 0
    if longest > most:
        raise ValueError(f"heads of more than {most} turns")
    heads = turns.filter((F.col("pos") < longest) & (F.col("conv_id") % every == 0)).withColumnRenamed("conv_id", "donor")
    first = heads.join(known.select("conv_id", "donor", "taken"), "donor").filter("pos < taken")
    first = first.select("conv_id", (F.col("pos") + 1).alias("depth"), "a", "b", "bytes")
    copies = F.explode(F.sequence(F.lit(0), F.expr(f"(n_own - 1) div {CHUNK}"))).alias("chunk")  # so that no id is hot
    described = known.filter("n_own > head").select("conv_id", "head", "taken", copies)
    own = turns.withColumn("chunk", F.expr(f"pos div {CHUNK}")).join(described, ["conv_id", "chunk"]).filter("pos >= head")
    own = own.select("conv_id", (F.col("pos") - F.col("head") + F.col("taken") + 1).alias("depth"), "a", "b", "bytes")
    return first.unionByName(own), known.select("conv_id", "n")


def _mixed(high: np.ndarray, low: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        state = (high.view(np.uint64) ^ np.uint64(seed + 1)) * _GOLDEN + low.view(np.uint64)
        state = (state ^ (state >> np.uint64(30))) * _MIX_1
        state = (state ^ (state >> np.uint64(27))) * _MIX_2
    return state ^ (state >> np.uint64(31))


class Slots:
    """A minimal perfect hash of digests: as many slots as distinct digests, and each slot keeps its digest.

    Each level deals what is left to twice as many cells. A cell that got one digest only, however often, is settled: its slot
    is its rank among the settled cells. Cells with several digests, found by comparing each with the cell's owner, go on.
    """

    def __init__(self, high: np.ndarray, low: np.ndarray) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.slot = np.zeros(len(high), np.int64)
        self.count, left = 0, np.arange(len(high))
        while len(left):
            h, l = high[left], low[left]
            cell = self._cells(h, l, 2 * len(left), len(self.levels))
            owner = np.full(2 * len(left), -1, np.int64)
            owner[cell] = np.arange(len(left))
            alien = (h[owner[cell]] != h) | (l[owner[cell]] != l)
            settled = owner >= 0
            settled[cell[alien]] = False
            rank = self.count + np.cumsum(settled) - 1
            self.levels.append((settled, rank))
            done = settled[cell]
            self.slot[left[done]] = rank[cell[done]]
            self.count += int(settled.sum())
            left = left[~done]
        self.high, self.low = np.zeros(self.count, np.int64), np.zeros(self.count, np.int64)
        self.high[self.slot], self.low[self.slot] = high, low

    @staticmethod
    def _cells(high: np.ndarray, low: np.ndarray, cells: int, level: int) -> np.ndarray:
        return (_mixed(high, low, level) % np.uint64(cells)).astype(np.int64)

    def find(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The slots of digests, -1 for those that are none of these."""
        found, left = np.full(len(high), -1, np.int64), np.arange(len(high))
        for level, (settled, rank) in enumerate(self.levels):
            cell = self._cells(high[left], low[left], len(settled), level)
            done = settled[cell]
            found[left[done]] = rank[cell[done]]
            left = left[~done]
        held = found >= 0
        held[held] = (self.high[found[held]] == high[held]) & (self.low[found[held]] == low[held])
        return np.where(held, found, -1)


#: What a shard's row is: a member's prefix, what a node adds once, what deeper bands of a member add.
MEMBER, ONCE, BELOW = 0, 1, 2


def accumulated(rows: dict[str, np.ndarray], band: int) -> dict[str, np.ndarray]:
    """A shard's nodes with members and subtree sums, by arrays over slots."""
    member = rows["kind"] == MEMBER
    mine = {n: v[member] for n, v in rows.items()}
    slots = Slots(mine["high"], mine["low"])
    n = np.bincount(slots.slot, minlength=slots.count).astype(np.int64)
    depth, size, up_high, up_low = (np.zeros(slots.count, np.int64) for _ in range(4))
    for array, name in ((depth, "depth"), (size, "bytes"), (up_high, "up_high"), (up_low, "up_low")):
        array[slots.slot] = mine[name]
    parent = np.where(depth % band == 0, -1, slots.find(up_high, up_low))  # a band's sums reach the one above as BELOW
    saved, leaves = n * size, np.zeros(slots.count, np.int64)
    if len(added := np.flatnonzero(~member)):
        place = slots.find(rows["high"][added], rows["low"][added])
        if (place < 0).any():
            raise ValueError("a node reached a shard that has no member of it")
        np.add.at(saved, place, rows["saved"][added])
        np.add.at(leaves, place, rows["leaves"][added])
    by_depth = np.argsort(depth, kind="stable")
    bounds = np.flatnonzero(np.diff(depth[by_depth])) + 1
    for level in reversed(np.split(by_depth, bounds)):
        level = level[parent[level] >= 0]
        np.add.at(saved, parent[level], saved[level])
        np.add.at(leaves, parent[level], leaves[level])
    return {"high": slots.high, "low": slots.low, "n_convs": n, "saved": saved, "leaves": leaves}


_SHARD = ("kind", "high", "low", "up_high", "up_low", "depth", "bytes", "saved", "leaves")


def _shards(band: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            table = pa.Table.from_batches(held)
            done = accumulated({n: table.column(n).to_numpy() for n in _SHARD}, band)
            yield from pa.table(done).to_batches(max_chunksize=10_000)

    return work


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of sorted ids of one node, as text."""
    for batch in batches:
        high, low, ids = (batch.column(n).to_numpy() for n in ("high", "low", "conv_id"))
        starts = np.flatnonzero(np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])]) if len(ids) else np.zeros(0, int)
        text = [",".join(map(str, run)) for run in np.split(ids, starts[1:])] if len(ids) else []
        yield pa.record_batch({"high": high[starts], "low": low[starts], "first": ids[starts], "ids": pa.array(text, pa.string())})


def _hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A node's runs in a row, hashed one after the other; only the hash's state is held."""
    node, state = None, None
    for batch in batches:
        done: list[tuple] = []
        for high, low, ids in zip(*(batch.column(n).to_pylist() for n in ("high", "low", "ids")), strict=True):
            if node != (high, low):
                done += [(*node, state.hexdigest())] if node else []
                node, state = (high, low), hashlib.sha256()
                state.update(ids.encode())
            else:
                state.update(f",{ids}".encode())
        yield _named(done)
    yield _named([(*node, state.hexdigest())] if node else [])


def _named(rows: list[tuple]) -> pa.RecordBatch:
    high, low, digest = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.record_batch({"high": pa.array(high, pa.int64()), "low": pa.array(low, pa.int64()), "ends_sha256": pa.array(digest, pa.string())})


def _ends(last: DataFrame) -> DataFrame:
    """``(high, low, ends_sha256)`` of the ids that end at a node. Ids are sorted by ranges and put together in runs of thousands
    first, so that one task reads a run a row of a node at which a large share of all conversations end."""
    spark = last.sparkSession
    ranged = last.repartitionByRange(partitions(spark), "high", "low", "conv_id").sortWithinPartitions("high", "low", "conv_id")
    runs = ranged.mapInArrow(_joined_ids, "high long, low long, first long, ids string")
    dealt = runs.repartition(partitions(spark), "high", "low").sortWithinPartitions("high", "low", "first")
    return dealt.mapInArrow(_hashed_ids, "high long, low long, ends_sha256 string")


def _one(column: str, what: str) -> Column:
    """The value all rows of a digest agree in."""
    agree = F.min(column).eqNullSafe(F.max(column))
    return F.when(agree, F.min(column)).otherwise(F.raise_error(F.lit(f"a digest stands for prefixes of several {what}")))


def trie(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """The nodes of conversations ``(conv_id, depth from 1, a, b, bytes)``; ``ids`` has every conversation with its length ``n``.

    ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``; no conversations, no nodes.
    """
    placed = turns.select("conv_id", "depth", "bytes", F.xxhash64(F.lit(3), "depth", "a", "b").alias("high"), F.xxhash64(F.lit(4), "depth", "a", "b").alias("low"))
    xor = F.bit_xor, lambda x, y: x.bitwiseXOR(y)
    folded = running_fold(placed, "conv_id", ["depth"], "to", {"high": xor, "low": xor})
    zero = F.lit(0).cast("long")
    up = [F.col(f"to_{c}").bitwiseXOR(F.col(c)).alias(f"up_{c}") for c in ("high", "low")]
    deep = folded.select("conv_id", "depth", "bytes", *up, F.col("to_high").alias("high"), F.col("to_low").alias("low"))
    root = ids.select("conv_id", zero.alias("depth"), *(zero.alias(c) for c in ("bytes", "up_high", "up_low", "high", "low")))
    members = cut(deep.unionByName(root))

    digest = ["high", "low"]
    same = {"depth": "depths", "bytes": "sizes", "up_high": "parents", "up_low": "parents"}
    nodes = members.groupBy(*digest).agg(F.min("conv_id").alias("conv_id"), *(_one(c, w).alias(c) for c, w in same.items()))
    below = nodes.filter("depth > 0").groupBy("up_high", "up_low").agg(F.count(F.lit(1)).alias("n_children"))
    below = below.withColumnsRenamed({"up_high": "high", "up_low": "low"})
    nodes = cut(nodes.join(below, digest, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))

    # Rows for the shards: every member's prefix, and what a node adds once, at its smallest member.
    leaf = (F.col("n_children") == 0).cast("long")
    rest = [F.lit(0).cast("long").alias(c) for c in ("saved", "leaves")]
    paths = members.select(F.lit(MEMBER).alias("kind"), "conv_id", *digest, "up_high", "up_low", "depth", "bytes", *rest)
    once = nodes.select(F.lit(ONCE).alias("kind"), "conv_id", *digest, "up_high", "up_low", "depth", "bytes", (-F.col("bytes")).alias("saved"), leaf.alias("leaves"))
    parts = paths.unionByName(once)
    band = F.expr(f"depth div {BAND}")
    far = parts.filter(F.col("depth") >= BAND).withColumn("adds", F.when(F.col("kind") == MEMBER, F.col("bytes")).otherwise(F.col("saved")))
    bands = far.groupBy("conv_id", band.alias("band")).agg(F.sum("adds").alias("saved"), F.sum("leaves").alias("leaves"))
    deeper = W.partitionBy("conv_id").orderBy(F.desc("band"))
    sums = bands.select("conv_id", (F.col("band") * BAND - 1).alias("depth"), *(F.sum(c).over(deeper).alias(c) for c in ("saved", "leaves")))
    edges = paths.filter((F.col("depth") + 1) % BAND == 0).drop("saved", "leaves").join(sums, ["conv_id", "depth"]).withColumn("kind", F.lit(BELOW))
    whole = parts.unionByName(edges.select(*parts.columns))
    shards = max(math.ceil(members.count() / SHARD_ROWS), partitions(turns.sparkSession))
    dealt = whole.repartition(shards, "conv_id", band).select(*_SHARD)
    summed = dealt.mapInArrow(_shards(BAND), "high long, low long, n_convs long, saved long, leaves long").groupBy(*digest)
    summed = summed.agg(F.sum("n_convs").alias("n_convs"), F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))

    ends = _ends(members.join(ids.select("conv_id", F.col("n").alias("depth")), ["conv_id", "depth"]).select(*digest, "conv_id"))
    parents = nodes.select(F.col("high").alias("up_high"), F.col("low").alias("up_low"), F.col("conv_id").alias("parent_conv_id"))
    named = nodes.join(parents, ["up_high", "up_low"], "left")
    done = named.join(summed, digest).join(ends, digest, "left")
    return done.select(
        "conv_id",
        "depth",
        F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )

"""Hard negatives of anchors: for each positive, the best rows of other labels in a band below the positive's score.

Anchors meet rows in blocks: a grid of row blocks and anchor blocks, both of bounded size, each cell a matrix product in one
task. Every cell is a combiner: it returns only an anchor's best rows.

The bands of an anchor's positives overlap. Their upper limits, in descending order, cut the scores into disjoint slots; each
cell keeps the best ``negatives`` rows of every slot, cells are merged slot by slot, and the slots from a positive's own one
downwards, one after the other, answer its band. The lower limit only cuts that answer's end off.

Rows without id, label or vector, with a null or non-finite component, or with one of 2^13 or more (whose products a long
cannot hold) take no part. Missing components of shorter vectors are zeros. Of rows with one id, the least label, then the
least vector, counts. A band of a negative positive score is empty.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stopline.llm.common import cut, partitions

#: Rows and anchors of a cell, at most as many vectors as make BLOCK_BYTES.
ROWS, ANCHORS, BLOCK_BYTES = 32_768, 8_192, 32 << 20
#: Scores held at once in a cell.
SCORES = 4 << 20
#: Components are less than this before they are scaled.
COMPONENT = float(1 << 13)


def vectors(table: DataFrame, label: Column, scale: int = 256) -> DataFrame:
    """``(vec_id, label, vector)`` with whole components ``floor(scale * x)``, one row an id."""
    unfit = F.exists("embedding", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) >= COMPONENT))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("int"))
    rows = table.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~unfit)
    rows = rows.select("vec_id", F.struct(label.cast("long").alias("label"), whole.alias("vector")).alias("row"))
    return rows.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.vector")


def _matrix(table: pa.Table, width: int) -> np.ndarray:
    lists = table.column("vector").combine_chunks()
    lists = lists if isinstance(lists, pa.Array) else pa.chunked_array(lists).combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and lengths.min() == width:
        return flat.reshape(len(lengths), width)
    made = np.zeros((len(lengths), width), np.int32)
    made[np.arange(width) < lengths[:, None]] = flat
    return made


def _long(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64)


def _best(scores: np.ndarray, among: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores among some places; of equal scores the first place, as rows are in order of id."""
    if len(among) > k:
        held = scores[among]
        among = among[held >= np.partition(held, len(held) - k)[len(held) - k]]
    return among[np.argsort(-scores[among], kind="stable")[:k]]


def _cell(pick: Callable[[dict, int, np.ndarray, np.ndarray, np.ndarray], list[tuple[int, np.ndarray]]]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A task's work on a cell: scores of its anchors and rows, of which ``pick`` names the rows to keep by slot."""

    def work(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: dict[str, list[np.ndarray]] = {"anchor_id": [], "slot": [], "vec_id": [], "score": []}
        if anchors.num_rows and rows.num_rows:
            rows = rows.sort_by("vec_id")
            width = max(anchors.column("width")[0].as_py(), 1)
            left, right = _matrix(anchors, width), _matrix(rows, width)
            most = int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0)) * width
            kind = np.float64 if most < 1 << 53 else np.int64  # both exact; the first is many times faster
            left, right = left.astype(kind), right.astype(kind).T
            ids, labels, anchor_ids, anchor_labels = _long(rows, "vec_id"), _long(rows, "label"), _long(anchors, "vec_id"), _long(anchors, "label")
            held = {n: anchors.column(n).to_pylist() for n in ("limits", "least") if n in anchors.column_names}
            step = max(1, SCORES // len(ids))
            for start in range(0, len(anchor_ids), step):
                for j, scores in enumerate((left[start : start + step] @ right).astype(np.int64), start):
                    for slot, places in pick(held, j, scores, labels == anchor_labels[j], ids != anchor_ids[j]):
                        for name, values in zip(out, (np.full(len(places), anchor_ids[j]), np.full(len(places), slot), ids[places], scores[places]), strict=True):
                            out[name].append(values)
        return pa.table({n: np.concatenate([np.zeros(0, np.int64), *v]).astype(np.int64) for n, v in out.items()})

    return work


def _grid(rows: DataFrame, anchors: DataFrame, work: Callable, n_rows: int, n_anchors: int, width: int) -> DataFrame:
    """Every cell's kept rows. Rows travel once for each block of anchors, anchors once for each block of rows."""
    most = max(1, BLOCK_BYTES // (4 * max(width, 1)))
    enough = min(partitions(rows.sparkSession), math.ceil(n_rows / 1024))
    down = max(1, enough, math.ceil(n_rows / min(ROWS, most)))
    across = max(1, math.ceil(n_anchors / min(ANCHORS, most)))
    block = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumns({"across": block(across), "width": F.lit(width)}).withColumn("down", every(down))
    right = rows.withColumn("down", block(down)).withColumn("across", every(across))
    left, right = (side.toDF(*side.columns) for side in (left, right))  # both stem from one table; a cogroup needs columns of its own
    both = left.groupBy("down", "across").cogroup(right.groupBy("down", "across"))
    return both.applyInArrow(work, "anchor_id long, slot long, vec_id long, score long")


def _first(kept: DataFrame, k: int, *keys: str) -> DataFrame:
    order = W.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return kept.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def hard_negatives(rows: DataFrame, is_anchor: Column, lower: int, upper: int, positives: int, negatives: int) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``rows``: ``(vec_id, label, vector)`` of whole numbers, an id once. An anchor's positives are its best ``positives`` rows of
    the same label; a negative is of another label and has ``lower`` to ``upper`` percent of the positive's score. Higher
    scores come first, of equal ones the smaller id. Empty tables give no rows.
    """
    rows = cut(rows.select("vec_id", "label", "vector"))
    anchors = rows.filter(is_anchor)
    n_rows, width = rows.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    sizes = n_rows, anchors.count(), width or 0

    def same(held: dict, j: int, scores: np.ndarray, alike: np.ndarray, others: np.ndarray) -> list[tuple[int, np.ndarray]]:
        return [(0, _best(scores, np.flatnonzero(alike & others), positives))]

    percent = lambda share, up: F.expr(f"{'-' if up else ''}(({'-' if up else ''}{share} * score - pmod({'-' if up else ''}{share} * score, 100)) div 100)")
    found = _first(_grid(rows, anchors, _cell(same), *sizes), positives, "anchor_id")
    found = cut(found.select("anchor_id", "vec_id", "score", percent(lower, True).alias("low"), percent(upper, False).alias("high")))
    limits = found.groupBy("anchor_id").agg(F.sort_array(F.collect_set("high"), asc=False).alias("limits"), F.min("low").alias("least"))

    def by_slot(held: dict, j: int, scores: np.ndarray, alike: np.ndarray, others: np.ndarray) -> list[tuple[int, np.ndarray]]:
        highs, least = held["limits"][j], held["least"][j]
        fit = ~alike & (scores >= least) & (scores <= highs[0])
        bounds = zip(highs, [*highs[1:], None], strict=True)
        return [(i, _best(scores, np.flatnonzero(fit & (scores <= top) & (True if below is None else scores > below)), negatives)) for i, (top, below) in enumerate(bounds)]

    asked = anchors.join(limits, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id")
    slots = _first(_grid(rows, asked, _cell(by_slot), *sizes), negatives, "anchor_id", "slot")
    down = F.sort_array(F.collect_list(F.struct("slot", "place", "vec_id", "score")))
    whole = slots.groupBy("anchor_id").agg(down.alias("slots"))  # at most positives x negatives rows an anchor
    own = F.array_position("limits", F.col("high")) - 1
    from_own = F.slice(F.filter("slots", lambda s: s["slot"] >= F.col("own")), 1, negatives)
    answers = found.join(limits.select("anchor_id", "limits"), "anchor_id").withColumn("own", own).join(whole, "anchor_id")
    each = answers.select("anchor_id", "vec_id", "score", F.posexplode(F.filter(from_own, lambda s: s["score"] >= F.col("low"))).alias("place", "one"))
    return each.select(
        "anchor_id",
        F.col("vec_id").alias("positive_id"),
        (F.col("place") + 1).alias("rank"),
        F.col("one.vec_id").alias("negative_id"),
        F.col("score").alias("positive_score"),
        F.col("one.score").alias("negative_score"),
    )

"""Packing: documents in order are cut into windows of at most a context's length, by dynamic programming."""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopline.llm.tokens import Words

CONTEXT = 2048
END = 1
#: What a cut costs, in tokens of padding: between sentences, and inside a sentence.
SENTENCE_CUT, WORD_CUT = 4, 24
#: A sentence longer than this may also be cut every so many tokens.
STRIDE = 128
#: Boundaries nearer to the one before are not considered, but for the ends of documents.
NEAREST = 12
#: Tokens that are packed together, after which a new sequence starts.
BLOCK = 1 << 20
#: Documents that are encoded at once.
ROWS = 1000

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
    ]
)


def boundaries(total: int, documents: np.ndarray, sentences: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a window may end, ascending and from 0, and what ending there costs."""
    documents = np.unique(documents)
    cost = dict.fromkeys(np.setdiff1d(sentences, documents).tolist(), SENTENCE_CUT)
    fixed = np.union1d(np.union1d(documents, sentences), [0, total])
    kept, last = [0], 0
    ends = set(documents.tolist()) | {total}
    for at in fixed.tolist():
        if at == 0 or at > total or (at - last < NEAREST and at not in ends):
            continue
        if at - last > STRIDE:
            inner = range(last + STRIDE, at, STRIDE)
            kept += inner
            cost.update(dict.fromkeys(inner, WORD_CUT))
        kept.append(at)
        last = at
    return np.array(kept, np.int64), np.array([cost.get(x, 0) for x in kept], np.int64)


def windows(places: np.ndarray, costs: np.ndarray, context: int = CONTEXT) -> list[int]:
    """The cuts, 0 and the end included, with the least padding plus cutting costs.

    A window from place i to place j pads up to the context, so the best before j is the least of best[i] + place[i] over
    the places within reach: the minimum of a sliding window, kept in a monotone queue. A window whose length is a power of
    two needs no padding; those starts are looked up. Places must be at most a context apart.
    """
    place, cost = places.tolist(), costs.tolist()
    at = {p: i for i, p in enumerate(place)}
    powers = [1 << k for k in range(4, context.bit_length() - 1)]
    best, back = [0] * len(place), [0] * len(place)
    queue: deque[tuple[int, int]] = deque()
    for j in range(1, len(place)):
        p = place[j]
        value = best[j - 1] + place[j - 1]
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j - 1))
        while place[queue[0][1]] < p - context:
            queue.popleft()
        value, start = queue[0]
        value += context - p
        for size in powers:
            i = at.get(p - size)
            if i is not None and best[i] < value:
                value, start = best[i], i
        best[j], back[j] = value + cost[j], start
    cuts = [len(place) - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return [place[i] for i in reversed(cuts)]


def packed(ids: np.ndarray, ends: np.ndarray, cuts: list[int]) -> tuple[np.ndarray, ...]:
    """The pieces between document ends and cuts: document, start in it, length, sequence, offset, place of the first id."""
    edges = np.union1d(ends, np.array(cuts))
    edges = np.union1d(edges, [0])
    first, last = edges[:-1], edges[1:]
    document = np.searchsorted(ends, first, side="right")
    begins = np.concatenate([[0], ends[:-1]])
    window = np.searchsorted(np.array(cuts), first, side="right") - 1
    return document, first - begins[document], last - first, window, first - np.array(cuts)[window], first


def _pieces(path: str, context: int, with_ids: bool):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words = Words.of(path)
        sequence = TaskContext.get().partitionId() << 33
        held_docs, held_ids, held_ends, held_stops, held = [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal sequence
            ids, ends, stops = np.concatenate(held_ids), np.concatenate(held_ends), np.concatenate(held_stops)
            docs = pa.concat_arrays(held_docs)
            cuts = windows(*boundaries(len(ids), ends, stops), context)
            document, start, length, window, offset, first = packed(ids, ends, cuts)
            tokens = np.diff(ends, prepend=0)
            pieces = [ids[a : a + n] for a, n in zip(first.tolist(), length.tolist(), strict=True)]
            data = {
                "doc_id": docs.take(pa.array(document)),
                "start": start,
                "length": length,
                "ids_crc32": [zlib.crc32(p.astype("<u4").tobytes()) for p in pieces],
                "doc_tokens": tokens[document],
                "sequence_id": window + sequence,
                "offset": offset,
            }
            columns = {k: v if isinstance(v, pa.Array) else pa.array(v, pa.int64()) for k, v in data.items()}
            if with_ids:
                offsets = pa.array(np.concatenate([first, [len(ids)]]), pa.int32())
                columns["ids"] = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))
            sequence += len(cuts) - 1
            for x in (held_docs, held_ids, held_ends, held_stops):
                x.clear()
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            for part in range(0, batch.num_rows, ROWS):
                rows = batch.slice(part, ROWS)
                ids, bounds, stops = words.encode_texts(rows["text"])
                extra = np.arange(1, len(bounds) + 1)
                moved = stops + np.searchsorted(bounds, stops, side="left")  # ends of texts come before their end id
                ids = np.insert(ids, bounds, END)
                held_docs.append(rows["doc_id"])
                held_ids.append(ids)
                held_ends.append(bounds + extra + held)
                held_stops.append(moved + held)
                held += len(ids)
                if held >= BLOCK:
                    yield flush()
                    held = 0
        if held:
            yield flush()

    return pack


def pack(documents: DataFrame, tokenizer: str, context: int = CONTEXT, with_ids: bool = True) -> DataFrame:
    """Pieces of documents in sequences of at most ``context`` tokens: ``PIECES``, without ``ids`` if not wanted.

    Null and empty texts are their end id alone; repeated rows are packed each. The order is that of the rows: every task
    packs its own in blocks of about a million tokens, keeping document order inside a sequence and from one sequence to
    the next, so nothing is shuffled and a lost task is simply run again. Cuts fall at the ends of documents or sentences,
    inside a sentence only if it is longer than ``STRIDE`` tokens. Sequence ids are those of the partition and a count.
    """
    schema = PIECES if with_ids else T.StructType(PIECES.fields[:-1])
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_pieces(tokenizer, context, with_ids), schema)

"""Substring deduplication: windows of words that an earlier document has are found in buckets of shared minimisers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopline.llm.common import cut, partitions, small, text_key

#: Words of a window, and of the grams of which a window's least hash is its minimiser.
WINDOW, GRAM = 13, 3
#: Bytes of packed windows that a bucket has on average, and what they are to the text.
BUCKET_BYTES, OVERLAP = 12 << 20, 3
#: Bytes of text that are cut into runs at once, and how hard they are compressed.
_PART, _LEVEL = 3 << 20, 6
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Runs:
    """The super-k-mers of some texts: runs of windows with one minimiser, as slices of all words joined by blanks."""

    def __init__(self, texts: list[str | None]) -> None:
        lists = [(t or "").encode().split() for t in texts]
        words = [w for ws in lists for w in ws]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        self.text = b" ".join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        self.at = np.concatenate([[0], np.cumsum(sizes)])
        document = np.repeat(np.arange(len(lists)), counts)
        before = np.repeat(np.cumsum(counts) - counts, counts)
        n = len(words) - WINDOW + 1
        if n < 1:
            self.first = self.last = self.doc = self.start = np.zeros(0, np.int64)
            self.minimiser = np.zeros(0, np.uint64)
            return
        coded = pa.array(words, pa.binary()).dictionary_encode()
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
        hashes = hashes[coded.indices.to_numpy()]
        least = hashes[: len(words) - GRAM + 1].copy()
        for step in range(1, GRAM):
            least = least * _MIX + hashes[step : step + len(least)]
        least ^= least >> np.uint64(29)
        least *= _MIX
        least ^= least >> np.uint64(32)
        span, grams = 1, WINDOW - GRAM + 1
        while span < grams:
            step = min(span, grams - span)
            least = np.minimum(least[: len(least) - step], least[step:])
            span += step
        valid = document[:n] == document[WINDOW - 1 :]
        new = np.ones(n, bool)
        new[1:] = (least[1:] != least[:-1]) | ~valid[:-1]
        first = np.flatnonzero(valid & new)
        stops = np.flatnonzero(~valid | new)
        after = np.searchsorted(stops, first, side="right")
        last = np.where(after < len(stops), np.append(stops, n)[after], n)
        self.first, self.last = first, last  # windows first to last - 1
        self.doc, self.start = document[first], first - before[first]
        self.minimiser = least[first]

    def slices(self) -> list[bytes]:
        text = self.text
        return [text[a:b] for a, b in zip(self.at[self.first].tolist(), (self.at[self.last + WINDOW - 1] - 1).tolist(), strict=True)]

    def keep(self, which: np.ndarray) -> None:
        for name in ("first", "last", "doc", "start", "minimiser"):
            setattr(self, name, getattr(self, name)[which])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Runs]]:
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False)) // _PART
        edges = np.flatnonzero(np.diff(sizes, prepend=-1)).tolist()
        for a, b in zip(edges, [*edges[1:], batch.num_rows], strict=True):
            part = batch.slice(a, b - a)
            yield part, Runs(part["text"].to_pylist())


def _frequent(share: float):
    """The minimisers that have at least this share of a batch's runs, and the number of all runs under null."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, runs in _parts(batches):
            found, n = np.unique(runs.minimiser, return_counts=True)
            often = n >= max(2, share * len(runs.minimiser))
            keys = pa.array([*found[often].view(np.int64).tolist(), None], pa.int64())
            yield pa.RecordBatch.from_pydict({"minimiser": keys, "n": pa.array([*n[often].tolist(), len(runs.minimiser)], pa.int64())})

    return count


def _packed(buckets: int, hot: np.ndarray):
    """Runs go to the bucket of their minimiser, those of a batch as one compressed string; hot minimisers are left out."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=_LEVEL).compress
        for batch, runs in _parts(batches):
            if len(hot):
                runs.keep(~np.isin(runs.minimiser, hot))
            n = len(runs.first)
            if not n:
                continue
            slices = runs.slices()
            rest = runs.minimiser // np.uint64(buckets)
            bucket = (runs.minimiser % np.uint64(buckets)).astype(np.int64)
            sizes = np.fromiter(map(len, slices), np.int64, n)
            ids, keys = (batch[c].to_numpy(zero_copy_only=False) for c in ("doc_id", "text_key"))
            order = np.argsort(bucket, kind="stable")
            edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            rows = []
            for a, b in zip(edges, [*edges[1:], n], strict=True):
                which = order[a:b]
                docs, doc = np.unique(runs.doc[which], return_inverse=True)
                head = np.array([len(docs), len(which)], np.int64)
                numbers = (doc, rest[which], runs.start[which], sizes[which])
                parts = [head.tobytes(), ids[docs].tobytes(), keys[docs].tobytes(), *(x.astype(np.uint32).tobytes() for x in numbers)]
                rows.append((int(bucket[which[0]]), squeeze(b"".join(parts + [slices[i] for i in which.tolist()]))))
            yield pa.RecordBatch.from_pydict({"bucket": pa.array([r[0] for r in rows], pa.int32()), "packed": pa.array([r[1] for r in rows], pa.binary())})

    return pack


def _unpacked(packs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Of each run: what its minimiser has besides the bucket (32 bits of it), doc_id, text_key, start, words."""
    columns, slices = [], []
    for raw in map(zstandard.ZstdDecompressor().decompress, packs):
        docs, n = np.frombuffer(raw, np.int64, 2).tolist()
        ids, keys = np.frombuffer(raw, np.int64, 2 * docs, 16).reshape(2, docs)
        doc, rest, start, sizes = np.frombuffer(raw, np.uint32, 4 * n, 16 * (docs + 1)).reshape(4, n)
        ends = 16 * (docs + 1 + n) + np.cumsum(sizes, dtype=np.int64)
        columns.append((rest, ids[doc], keys[doc], start))
        slices += [raw[b - s : b] for b, s in zip(ends.tolist(), sizes.tolist(), strict=True)]
    return (*(np.concatenate(c) for c in zip(*columns, strict=True)), slices)


def repeated_in(packs: list[bytes]) -> list[tuple[int, int, int, int]]:
    """``(doc_id, text_key, from, to)`` of the words covered by windows that a smaller doc_id has, in one bucket.

    Runs are sorted by minimiser. Where several documents share one, their windows are sorted by words and doc_id; the first
    of equal windows has the smallest doc_id.
    """
    minimisers, ids, keys, starts, slices = _unpacked(packs)
    order = np.lexsort((ids, minimisers))
    ranked = minimisers[order]
    edges = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    found = []
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(order)], strict=True):
        group = order[a:b]
        if ids[group[0]] == ids[group[-1]]:
            continue
        windows = []
        for i in group.tolist():
            words, doc, start = slices[i].split(b" "), int(ids[i]), int(starts[i])
            windows += [(b" ".join(words[k : k + WINDOW]), doc, i, start + k) for k in range(len(words) - WINDOW + 1)]
        windows.sort()
        known, smallest = None, 0
        later = []
        for window, doc, i, at in windows:
            if window != known:
                known, smallest = window, doc
            elif doc > smallest:
                later.append((i, at))
        later.sort()
        for j, (i, at) in enumerate(later):
            if j and later[j - 1] == (i, at - 1):
                found[-1] = (*found[-1][:3], at + WINDOW)
            else:
                found.append((int(ids[i]), int(keys[i]), at, at + WINDOW))
    return found


_SPANS = "doc_id long, text_key long, first long, after long"


def _span_batch(spans: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*spans, strict=True)) if spans else [[]] * 4
    return pa.RecordBatch.from_pydict({c.split()[0]: pa.array(v, pa.int64()) for c, v in zip(_SPANS.split(", "), columns, strict=True)})


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The packed strings come sorted by bucket; a bucket is held until the next one begins."""
    held, current = [], None
    for batch in batches:
        for bucket, packed in zip(batch["bucket"].to_pylist(), batch["packed"].to_pylist(), strict=True):
            if bucket != current and held:
                yield _span_batch(repeated_in(held))
                held = []
            current = bucket
            held.append(packed)
    if held:
        yield _span_batch(repeated_in(held))


def _hot_windows(hot: np.ndarray):
    """The windows of hot minimisers, one by one."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, runs in _parts(batches):
            runs.keep(np.isin(runs.minimiser, hot))
            sizes = runs.last - runs.first
            at = np.repeat(runs.first, sizes) + (np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes))
            start = np.repeat(runs.start - runs.first, sizes) + at
            doc = pa.array(np.repeat(runs.doc, sizes))
            text = runs.text
            windows = [text[a:b].decode() for a, b in zip(runs.at[at].tolist(), (runs.at[at + WINDOW] - 1).tolist(), strict=True)]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch["doc_id"].take(doc), "text_key": batch["text_key"].take(doc), "start": pa.array(start, pa.int64()), "window": pa.array(windows, pa.string())}
            )

    return split


def repeated_spans(documents: DataFrame) -> DataFrame:
    """``(doc_id, text_key, first, after)``: places of words covered by windows that a document with a smaller id has too.

    A window's minimiser is decided by its words, so equal windows meet in one bucket. A minimiser with more runs than half
    an average bucket would load one task; those are found first (a share of all runs is reached in some batch), they are
    as few as twice the buckets, and their windows are grouped by Spark instead: the smallest id of a window combines on the
    map side and is joined back, where skew can be split. Rows without doc_id have no order: they remove nothing and keep all.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"), "text").filter("doc_id is not null")
    spark = documents.sparkSession
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(partitions(spark), -(-size * OVERLAP // BUCKET_BYTES))
    share = 1 / (2 * buckets)
    counted = cut(rows.mapInArrow(_frequent(share / 2), "minimiser long, n long").groupBy("minimiser").agg(F.sum("n").alias("n")))
    runs = counted.filter("minimiser is null").first()
    limit = share / 2 * (runs["n"] if runs else 0)
    often = counted.filter(F.col("minimiser").isNotNull() & (F.col("n") >= limit)).select("minimiser")
    hot = np.array([r["minimiser"] for r in often.toLocalIterator()], np.int64).view(np.uint64)  # 4 for each bucket at most
    packed = rows.mapInArrow(_packed(buckets, hot), "bucket int, packed binary")
    spans = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_search, _SPANS)
    if len(hot):
        windows = rows.mapInArrow(_hot_windows(hot), "doc_id long, text_key long, start long, window string")
        smallest = windows.groupBy("window").agg(F.min("doc_id").alias("_smallest"))
        later = windows.join(smallest, "window").filter(F.col("doc_id") > F.col("_smallest"))
        spans = spans.unionByName(later.select("doc_id", "text_key", F.col("start").alias("first"), (F.col("start") + WINDOW).alias("after")))
    return spans


def _squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as they travel to their spans."""
    squeeze = zstandard.ZstdCompressor(level=_LEVEL).compress
    for batch in batches:
        packed = [squeeze((t or "").encode()) for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_pydict({c: batch[c] for c in ("doc_id", "_text_key")} | {"_packed": pa.array(packed, pa.binary())})


def _removed(with_text: bool):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unsqueeze = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            n_words, n_removed, digests, texts = [], [], [], []
            for packed, spans in zip(batch["_packed"].to_pylist(), batch["_spans"].to_pylist(), strict=True):
                words = unsqueeze(packed).split()
                n_words.append(len(words))
                if spans:
                    edge = np.zeros(len(words) + 1, np.int64)
                    for s in spans:
                        edge[s["first"]] += 1
                        edge[s["after"]] -= 1
                    left = np.cumsum(edge[:-1]) == 0
                    words = [w for w, stays in zip(words, left.tolist(), strict=True) if stays]
                n_removed.append(n_words[-1] - len(words))
                kept = b" ".join(words)
                digests.append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    texts.append(kept.decode())
            data = {"doc_id": batch["doc_id"], "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(digests, pa.string())}
            yield pa.RecordBatch.from_pydict(data | ({"kept": pa.array(texts, pa.string())} if with_text else {}))

    return remove


def without_repeated_substrings(documents: DataFrame, with_text: bool = True) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256, kept)`` for every row: what is left of the words, joined by one blank.

    Words are split at ASCII blanks; null text has none. Windows are judged on the input, and within one doc_id nothing is
    removed, so repeated rows and texts repeated inside a document stay.
    """
    gone = repeated_spans(documents).groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    gone = cut(gone.agg(F.collect_set(F.struct("first", "after")).alias("_spans")))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("_text_key"), "text")
    rows = rows.mapInArrow(_squeezed, "doc_id long, _text_key long, _packed binary")
    marked = rows.join(small(gone, "_spans"), (F.col("doc_id") == F.col("_id")) & (F.col("_text_key") == F.col("_key")), "left")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept string" if with_text else "")
    return marked.select("doc_id", "_packed", "_spans").mapInArrow(_removed(with_text), schema)

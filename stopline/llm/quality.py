"""Quality rules: lines that many documents of a host share are removed, and documents left with little are rejected."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopline.llm.common import carrying, cut

#: A line is removed from a host's documents if more than so many of them have it, and more than one in ``ONE_IN``.
MAX_DOCUMENTS = 10
ONE_IN = 20
#: A document is rejected if more than this part of its words goes with such lines.
MAX_REMOVED = 0.5
MIN_WORDS = 20
MAX_REPEATED = 0.3
WINDOW = 8
SYMBOLS = "#*$%&|<>"
ASCII_BLANKS = " \t\n\v\f\r"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SCHEMA = (
    "doc_id long, host string, text_key long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, lines array<struct<line: long, words: long>>"
)


def normalised(line: bytes) -> bytes:
    """A line without case (A-Z), digits' values and differences of blanks."""
    return re.sub(rb"[0-9]+", b"0", b" ".join(line.lower().split()))


def line_key(line: bytes) -> int:
    return xxhash.xxh64_intdigest(normalised(line)) - 2**63


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """How many words are in windows that the text has twice or more; windows are compared exactly, by doubling ranks."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    rank = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    span = 1
    while span < window:
        step = min(span, window - span)
        left, right = rank[: len(rank) - step], rank[step:]
        _, rank = np.unique(left * (int(right.max()) + 1) + right, return_inverse=True)
        span += step
    twice = np.bincount(rank)[rank] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, np.flatnonzero(twice), 1)
    np.add.at(edge, np.flatnonzero(twice) + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def measured(text: str) -> dict:
    raw = text.encode()
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.split()]
    own: dict[int, int] = {}
    for line in lines:
        key = line_key(line)
        own[key] = own.get(key, 0) + len(line.split())
    return {
        "n_words": len(words),
        "word_chars": len(text) - sum(map(text.count, ASCII_BLANKS)),
        "n_symbols": sum(map(text.count, SYMBOLS)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeated_words(words),
        "lines": [{"line": k, "words": v} for k, v in own.items()],
    }


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [measured(t or "") for t in batch["text"].to_pylist()]
        data = {k: batch[k] for k in ("doc_id", "host", "text_key")} | {k: [r[k] for r in rows] for k in measured("")}
        kinds = [("line", pa.int64()), ("words", pa.int64())]
        types = {"lines": pa.list_(pa.struct(kinds))}
        yield pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else pa.array(v, types.get(k, pa.int64())) for k, v in data.items()})


@F.arrow_udf(T.StringType())
def _cleared(texts: pa.Array, gone: pa.Array) -> pa.Array:
    """The texts without the lines of these hashes; blank lines stay."""
    kept = []
    for text, hashes in zip(texts, gone, strict=True):
        text, hashes = text.as_py(), set(hashes.as_py() or ())
        if text is not None and hashes:
            text = "\n".join(x for x in text.split("\n") if not x.encode().split() or line_key(x.encode()) not in hashes)
        kept.append(text)
    return pa.array(kept, pa.string())


def without_frequent_lines(documents: DataFrame, max_documents: int = MAX_DOCUMENTS, max_removed: float = MAX_REMOVED, one_in: int = ONE_IN) -> DataFrame:
    """The documents with all their columns, ``text`` without its host's frequent lines, and counts of the text as it was.

    The counts are ``_n_words``, ``_word_chars``, ``_n_symbols``, ``_n_dup_lines``, ``_n_repeat_words`` and
    ``_n_frequent_words``, the words of the lines that went; ``_base_failed`` and ``_kept`` say whether the document stays.
    Rejected documents are returned too. A line is frequent if more than ``max_documents`` of a host's documents have it,
    and more than one in ``one_in``: the limit grows with the host, so natural short lines stay however large a host is.
    Needs ``doc_id``, ``text`` and ``source``, the host; null text counts as empty and
    stays null, null hosts are one host, the empty one. A line counts once a document; blank lines are not counted and stay.
    Rows that agree in all three columns are one document and get the same answer as often as they occur. Line counts
    combine on the map side, so that one line in a third of all documents is a row for each task; the frequent lines meet
    the documents' lines in a join that Spark may split on skew. Texts travel to their document's lines only if ``text`` is
    asked for.
    """
    return carrying(documents, lambda rows: _without_frequent_lines(rows, max_documents, max_removed, one_in), *TOLD)


#: What is told of each document.
TOLD = [f"_{c}" for c in (*COUNTS, "base_failed", "kept", "n_frequent_words")]


def _without_frequent_lines(documents: DataFrame, max_documents: int, max_removed: float, one_in: int) -> DataFrame:
    host = F.coalesce("source", F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), host.alias("host"), F.xxhash64("text").alias("text_key"), "text")
    keys = ["doc_id", "host", "text_key"]
    each = cut(rows.mapInArrow(_measure, _SCHEMA).groupBy(*keys).agg(*(F.first(c).alias(c) for c in COUNTS), F.first("lines").alias("lines")))
    lines = each.select(*keys, F.inline("lines"))
    frequent = (
        lines.select("host", "line", "doc_id").distinct().groupBy("host", "line").agg(F.count("*").alias("documents"))
    ).filter(F.col("documents") > max_documents)
    hosts = each.select("host", "doc_id").distinct().groupBy("host").agg(F.count("*").alias("of_host"))
    frequent = frequent.join(hosts, "host").filter(one_in * F.col("documents") > F.col("of_host")).select("host", "line")
    gone = (
        lines.join(frequent, ["host", "line"])
        .groupBy(*(F.col(k).alias(f"_{k}") for k in keys))
        .agg(F.sum("words").alias("_n_frequent_words"), F.collect_list("line").alias("_gone"))
    )

    def same(left: str, right: str) -> Column:
        return reduce(Column.__and__, (F.col(f"{left}{k}").eqNullSafe(F.col(f"{right}{k}")) for k in keys))

    n, frequent_words = F.col("n_words"), F.coalesce("_n_frequent_words", F.lit(0)).cast("long")
    failed = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > int(100 * MAX_REPEATED) * n)
    judged = each.join(gone, same("", "_"), "left").select(
        *(F.col(k).alias(f"_its_{k}") for k in keys),
        *(F.col(c).alias(f"_{c}") for c in COUNTS),
        failed.alias("_base_failed"),
        (~failed & (frequent_words <= max_removed * n) & (n - frequent_words >= MIN_WORDS)).alias("_kept"),
        frequent_words.alias("_n_frequent_words"),
        "_gone",
    )
    named = documents.withColumns({"_row_doc_id": F.col("doc_id").cast("long"), "_row_host": host, "_row_text_key": F.xxhash64("text")})
    joined = named.join(judged, same("_row_", "_its_"))
    text = _cleared("text", "_gone").alias("text")
    return joined.select(*(text if c == "text" else joined[c] for c in documents.columns), *TOLD)


def rated(documents: DataFrame, max_documents: int = MAX_DOCUMENTS, max_removed: float = MAX_REMOVED, one_in: int = ONE_IN) -> DataFrame:
    """What ``without_frequent_lines`` tells of each document, without the documents."""
    rows = without_frequent_lines(documents.select("doc_id", "text", "source"), max_documents, max_removed, one_in)
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), *(F.col(f"_{c}").alias(c) for c in (*COUNTS, "base_failed", "kept", "n_frequent_words")))

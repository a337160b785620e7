"""Token counts of texts by byte-pair merging on a heap; no token is ever made.

A text is split at special tokens and then by the vocabulary's word pattern. Each piece starts as one symbol a byte. A heap
holds every adjacent pair that has a rank; the lowest pair (the leftmost of equal ones) is popped and merged in a linked list,
which brings up to two new pairs. A piece has as many tokens as it had bytes, less its merges.

Null and empty texts have no tokens. Any character counts, unassigned ones too; texts of any length are counted whole.
"""

from __future__ import annotations

import heapq
import json
import sys
import types
import unicodedata
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

#: Pieces whose counts a Python worker remembers.
REMEMBERED = 500_000
#: The word pattern of byte-level vocabularies (fixed value).
_PIECES = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: The least character that the pattern's library may take for a letter although it is unassigned elsewhere.
_FIRST_ODD = "՘"


def byte_letters() -> list[str]:
    """The printable stand-in of every byte in byte-level vocabularies: itself if visible, else the next letter from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


def vocabulary(path: str) -> tuple[list[tuple[str, str]], list[str]]:
    """The merges in order of rank, and the special strings, of a byte-level file; anything else is refused."""
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    model, splitter = whole["model"], whole.get("pre_tokenizer") or {}
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    if model.get("type") != "BPE" or any(model.get(o) for o in options) or whole.get("normalizer") or any(splitter.get(k) != v for k, v in plain.items()):
        raise ValueError(f"{path} is not a plain byte-level vocabulary; its counts would be wrong")
    if missing := [c for c in byte_letters() if c not in model["vocab"]]:
        raise ValueError(f"{path} lacks {len(missing)} of the 256 bytes")
    special = whole.get("added_tokens", [])
    if any(t[o] for t in special for o in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"{path} has special tokens that match by other rules than their plain string")
    return [tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]], [t["content"] for t in special]


def merges_of(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many merges a piece allows, always the pair of the lowest rank first."""
    symbols = list(symbols)
    size = len(symbols)
    before, after = list(range(-1, size - 1)), list(range(1, size + 1))
    heap = [(ranks[p], i, *p) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)) if p in ranks]
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if symbols[i] != left or j >= size or symbols[j] != right:  # one of the two has gone into another merge
            continue
        merges += 1
        symbols[i], symbols[j] = left + right, ""
        after[i] = k = after[j]
        if k < size:
            before[k] = i
            if (rank := ranks.get((symbols[i], symbols[k]))) is not None:
                heapq.heappush(heap, (rank, i, symbols[i], symbols[k]))
        if (h := before[i]) >= 0 and (rank := ranks.get((symbols[h], symbols[i]))) is not None:
            heapq.heappush(heap, (rank, h, symbols[h], symbols[i]))
    return merges


class Counter(dict):
    """Tokens of each piece seen so far; forgets all of them when they have become too many."""

    def __init__(self, merges: list[tuple[str, str]], special: list[str]) -> None:
        super().__init__()
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(merges)}
        self.letters = byte_letters()
        longest_first = sorted(special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, longest_first))) if special else None
        self.splitter = pre_tokenizers.ByteLevel(add_prefix_space=False)

    def __missing__(self, piece: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        data = piece.encode()
        count = self[piece] = len(data) - merges_of([self.letters[b] for b in data], self.ranks)
        return count

    def pieces(self, text: str) -> list[str]:
        """The words of a text. Letters newer than the vocabulary's own Unicode tables are left to its library."""
        if not text.isascii() and any(c >= _FIRST_ODD and unicodedata.category(c) == "Cn" for c in set(text)):
            return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]
        return _PIECES.findall(text)

    def tokens(self, text: str) -> int:
        parts = self.special.split(text) if self.special else [text]
        return len(parts) - 1 + sum(sum(map(self.__getitem__, self.pieces(p))) for p in parts)


def token_count(text: Column | str, path: str) -> Column:
    """The number of tokens that the byte-level vocabulary at ``path`` makes of a text, without begin, end or added tokens."""
    sent = SparkSession.active().sparkContext.broadcast(vocabulary(path))  # a vocabulary: some MB, whatever the texts

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        kept = sys.modules.setdefault("_token_counters_of_this_worker", types.ModuleType("_token_counters_of_this_worker"))
        if path not in vars(kept):
            setattr(kept, path, Counter(*sent.value))
        counter = vars(kept)[path]
        for texts in batches:
            yield pd.Series([0 if t is None else counter.tokens(t) for t in texts], dtype="int64")

    return counted(F.coalesce(text, F.lit("")))


def token_counts(documents: DataFrame, path: str, limit: int) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of each document; repeated rows and ids each get their own row."""
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    counted = documents.select("doc_id", size.alias("n_bytes"), token_count("text", path).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

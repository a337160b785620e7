"""Token ids of many texts at once: every distinct word of a batch is encoded once, then ids are gathered with numpy."""

from __future__ import annotations

import sys
import types
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

#: Words that a Python worker remembers, and as many pieces of words.
REMEMBERED = 700_000
#: A word that ends a sentence, whatever brackets or quotes follow.
_STOP = r"""[.!?…。！？]["')\]}»”’]*$"""
#: The vocabulary's own rule for splitting a word after lower-casing (fixed values).
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of every byte in byte-level vocabularies: itself if visible, else a letter from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Words:
    """Ids of words, remembered for as long as Spark keeps the Python worker, which is longer than one task."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.known: dict[str, tuple] = {}
        self.pieces: dict[str, tuple] = {}

    @staticmethod
    def of(path: str) -> Words:
        kept = sys.modules.setdefault("_words_of_this_worker", types.ModuleType("_words_of_this_worker"))
        if path not in vars(kept):
            setattr(kept, path, Words(path))
        return vars(kept)[path]

    def piece(self, piece: str) -> tuple:
        found = self.pieces.get(piece)
        if found is None:
            shown = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
            found = self.pieces[piece] = tuple([t.id for t in self.tokenizer.model.tokenize(shown)])
        return found

    def encode(self, word: str) -> tuple:
        """A word's ids. Words of Latin letters skip the parts of the tokenizer that only matter for other text."""
        if not word or max(word) >= "ƀ" or "<|" in word:
            return tuple(self.tokenizer.encode(word, add_special_tokens=False).ids)
        lower = word.lower()
        if lower.isalpha():
            return self.piece(lower)
        if lower[-1] in ".," and lower[:-1].isalpha():
            return self.piece(lower[:-1]) + self.piece(lower[-1])
        return tuple([i for p in _PIECES.findall(lower) for i in self.piece(p)])

    def ids(self, words: list[str]) -> list[tuple]:
        """The ids of each word. What is known is forgotten when it has become too much, and learned again."""
        for known in (self.known, self.pieces):
            if len(known) > REMEMBERED:
                known.clear()
        found = list(map(self.known.get, words))
        for i, ids in enumerate(found):
            if ids is None:
                found[i] = self.known[words[i]] = self.encode(words[i])
        return found

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids in a row, where each text's ids end, and where sentences end (both as positions in that row).

        Cutting at blanks first changes no id, as the vocabulary drops white space. A sentence ends with a word whose last
        sign is a full stop, question or exclamation mark, whatever brackets or quotes follow.
        """
        flat = pc.fill_null(texts, "")
        for blank in "\n\t\r":
            flat = pc.replace_substring(flat, blank, " ")
        words = pc.split_pattern(flat, " ")
        coded = words.flatten().dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        distinct = coded.dictionary.to_pylist()
        known = self.ids(distinct)
        sizes = np.fromiter(map(len, known), np.int64, len(known))
        ends = pc.match_substring_regex(coded.dictionary, _STOP).to_numpy(zero_copy_only=False).astype(bool)
        pool = np.fromiter(chain.from_iterable(known), np.uint32, int(sizes.sum()))
        starts = np.cumsum(sizes) - sizes
        lengths = sizes[codes]
        after = np.cumsum(lengths)
        total = int(after[-1]) if len(after) else 0
        take = np.repeat(starts[codes] - (after - lengths), lengths) + np.arange(total)
        bounds = np.concatenate([[0], after])[np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False))]
        return pool[take], bounds, np.unique(after[ends[codes]])

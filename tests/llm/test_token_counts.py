"""Token counts against the tokenizer itself."""

from __future__ import annotations

import json
import random
import sys

import public_tokenizers
import pytest
from conftest_llm import SF_DIR
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stopline.llm.queries import op11_token_counts
from stopline.llm.token_counts import Counter, token_count, token_counts, vocabulary

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return Counter(*vocabulary(PATH))


def size(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def test_query_equals_the_tokenizer_on_all_documents(spark, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = op11_token_counts(spark, SF_DIR).collect()
    want = {(i, len((t or "").encode()), n := size(library, t or ""), n > 1024) for i, t in texts.items()}
    assert len(got) == len(texts) and {tuple(r) for r in got} == want
    assert {r["over_limit"] for r in got} == {True, False}


def test_odd_documents(spark, documents, odd, library):
    got = token_counts(odd, PATH, limit=10).collect()
    want = [(r["doc_id"], len((r["text"] or "").encode()), n := size(library, r["text"] or ""), n > 10) for r in odd.collect()]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert token_counts(documents([]), PATH, limit=10).count() == 0
    kept = odd.withColumn("tokens of it", token_count("text", PATH))
    assert kept.columns == [*odd.columns, "tokens of it"] and kept.filter(F.col("text").isNull()).first()["tokens of it"] == 0


def test_special_strings_blanks_and_long_pieces(counter, library):
    texts = ["<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext", "it's we'll I'M  \n\n x\t\t y   z ", " ", "  ", "\r\n\x00\x1c\x85",
             "a" * 5000, "ab" * 3000 + "!" * 999, "é" * 700, "🙂👩‍👩‍👧" * 50, "漢字かな交じり文" * 40, "0123456789" * 30, "՘a՘ 1՘!"]
    assert [counter.tokens(t) for t in texts] == [size(library, t) for t in texts]


def test_every_character_and_random_bytes(counter, library):
    rng = random.Random(3)
    points = [c for c in map(chr, range(sys.maxunicode + 1)) if not "\ud800" <= c <= "\udfff"]
    whole = ["".join(f"a{c}1{c}! {c} " for c in points[i : i + 400]) for i in range(0, len(points), 400)]
    mixed = ["".join(rng.choice(("th", "e ", "in", "'s", " ", "\n", "9", "é", "ß", "!?", "<|", chr(rng.randrange(32, 0x3000)))) for _ in range(80)) for _ in range(1500)]
    encoded = library.encode_batch(whole + mixed, add_special_tokens=False)
    assert [counter.tokens(t) for t in whole + mixed] == [len(e.ids) for e in encoded]


def test_remembered_pieces_are_bounded(library, monkeypatch):
    monkeypatch.setattr("stopline.llm.token_counts.REMEMBERED", 20)
    counter = Counter(*vocabulary(PATH))
    text = " ".join(f"word{i}" for i in range(500))
    assert counter.tokens(text) == size(library, text) and len(counter) <= 20


def test_other_vocabularies_are_refused(tmp_path):
    with pytest.raises(ValueError, match="plain byte-level"):
        vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    with open(PATH, encoding="utf-8") as file:
        whole = json.load(file)
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "use_regex": True}}):
        other = tmp_path / "other.json"
        other.write_text(json.dumps(whole | change))
        with pytest.raises(ValueError, match="plain byte-level"):
            vocabulary(str(other))

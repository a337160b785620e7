from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from conftest_llm import SF_DIR
from tokenizers import Tokenizer

from stopline.llm.packing import boundaries, pack, windows
from stopline.llm.queries import op10_packing
from stopline.llm.tokens import Words

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, got, context=2048):
    tokenizer = Tokenizer.from_file(PATH)
    encoded = [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for _, t in rows]
    want = sorted(((i is not None, i or 0), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for (i, _), ids in zip(rows, encoded, strict=True))
    got = got.sort_values(["sequence_id", "offset"])
    for _, part in got.groupby("sequence_id"):
        assert part["offset"].tolist() == [0, *np.cumsum(part["length"])[:-1]]
        assert part["length"].sum() <= context and (part["length"] > 0).all()
    # Pieces follow each other, so a document's pieces join to the whole of its ids.
    whole, have = [], 0
    for r in got.to_dict("records"):
        if r["start"] == 0:
            whole.append((r["doc_id"], r["doc_tokens"], []))
        assert r["start"] == len(whole[-1][2]) and r["doc_tokens"] == whole[-1][1]
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
        whole[-1][2].extend(r["ids"])
        have += r["length"]
    made = sorted(((not pd.isna(i), 0 if pd.isna(i) else i), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, _, ids in whole)
    assert made == want and have == sum(map(len, encoded))
    lengths = got.groupby("sequence_id")["length"].sum()
    return sum(context - n for n in lengths if n & (n - 1)) / have


def test_whole_table_round_trip(spark):
    rows = list(pd.read_parquet(f"{SF_DIR}/documents.parquet")[["doc_id", "text"]].itertuples(index=False, name=None))
    got = pack(spark.read.parquet(f"{SF_DIR}/documents.parquet"), PATH).toPandas()
    assert check(rows, got) < 0.01
    query = op10_packing(spark, SF_DIR).toPandas()
    same = ["sequence_id", "offset"]
    pd.testing.assert_frame_equal(query.sort_values(same, ignore_index=True), got.drop(columns="ids").sort_values(same, ignore_index=True))


def test_odd_rows(odd, documents):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    check(rows, pack(odd.coalesce(1), PATH).toPandas())
    assert pack(documents([]), PATH).count() == 0


def test_words_are_encoded_as_the_tokenizer_does():
    tokenizer = Tokenizer.from_file(PATH)
    texts = [
        "It's we'll I'd NAÏVE café x1y22 ... ?!¡ don't 'S 'tis",
        "ſ K Å ﬁ İstanbul STRASSE ǅ",
        "a<|endoftext|>b <|startoftext|> <| |>",
        "tab\tline\nfeed\rform\x0cvert\x0bnbsp next\x85sep  zero​width",
        "漢字かな 한글 ع🙂🙂 é ́ ½ ² ª º µ",
        None,
        "",
        "  ",
    ]
    ids, ends, _ = Words(PATH).encode_texts(pa.array(texts, pa.string()))
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in np.split(ids, ends[:-1])] == want


def test_dynamic_programme_is_optimal():
    rng = random.Random(2)
    for _ in range(200):
        places = np.array([0, *itertools.accumulate(rng.randint(1, 20) for _ in range(9))])
        costs = np.array([0, *(rng.choice((0, 3, 9)) for _ in range(9))])

        def cost(cuts, places=places, costs=costs):
            total = 0
            for a, b in itertools.pairwise(cuts):
                n = b - a
                if n > 64:
                    return float("inf")
                total += (0 if n >= 16 and n & (n - 1) == 0 else 64 - n) + costs[places.tolist().index(b)]
            return total

        best = min(cost((0, *(places[1 + i] for i in range(8) if pick >> i & 1), places[-1])) for pick in range(256))
        assert cost(windows(places, costs, 64)) == best


def test_boundaries_reach_every_stride():
    places, _ = boundaries(5000, np.array([4000, 5000]), np.array([], np.int64))
    assert np.diff(places).max() <= 128 and {0, 4000, 5000} <= set(places.tolist())

from __future__ import annotations

import random
import re

from stopline.llm.decontamination import clean_documents, contamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for i, text in items:
        w = words(text)
        for k in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[k : k + 13]), set()).add(i)
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if owners := windows.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    found |= owners
        out.append((i, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def run(docs, items):
    got = contamination(docs, items).select("doc_id", "n_words", "n_hit", "items", "contaminated").collect()
    return sorted(map(tuple, got), key=str)


def test_random_texts_against_brute_force(spark, documents):
    rng = random.Random(8)
    items = [(i, " ".join(rng.choice("abcdef") for _ in range(n))) for i, n in enumerate((40, 25, 13, 12, 5, 3, 14, 1, 0, 60))]
    items += [(3, None), (99, items[0][1].upper()), (100, "É-à 漢字 x")]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(rng.randint(0, 6)):
            source = (rng.choice(items)[1] or "").split()
            a = rng.randint(0, max(0, len(source) - 13))
            parts += source[a : a + rng.randint(8, 30)] if rng.random() < 0.6 else [f"own{rng.randint(0, 999)}" for _ in range(rng.randint(1, 40))]
        rows.append((i, rng.choice((" ", ", ", "\n")).join(parts)))
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("item_id", "text", "'x' AS window", "1 AS length", "2 AS doc_id")
    assert run(documents(rows), table) == brute(rows, items)
    bad = {i for i, *_, b in brute(rows, items) if b}
    assert {r["doc_id"] for r in clean_documents(documents(rows), table).collect()} == {i for i, _ in rows} - bad


def test_odd_rows_and_empty_tables(spark, odd, documents):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    items = [(1, " ".join(f"w{i * i % 9973}" for i in range(700, 740))), (2, "equal text twice"), (None, "word")]
    table = spark.createDataFrame(items, "item_id long, text string")
    named = [(i, t) for i, t in items if i is not None]
    got = {r[:3] + r[4:] for r in run(odd, table)}
    assert got == {r[:3] + r[4:] for r in brute(rows, items)}
    assert run(odd, table.filter("item_id > 0")) == brute(rows, named)
    assert run(odd, table.limit(0)) == brute(rows, [])
    assert run(documents([]), table) == []
    assert clean_documents(odd, table).columns == odd.columns

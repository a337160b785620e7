from __future__ import annotations

import random

import pandas as pd
import xxhash
from conftest_llm import SF_DIR, components_of

from stopline.llm.common import components
from stopline.llm.queries import op2_simhash
from stopline.llm.simhash import CROWD, links, matches, near_copies, without_near_copies


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - 2)
    shingles = [b" ".join(words[i : i + 3]) for i in range(n)]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > n)


def brute(rows):
    prints = [(i, brute_print(t)) for i, t in rows]
    distinct = sorted({p for _, p in prints})
    root = components_of(distinct, [(a, b) for k, a in enumerate(distinct) for b in distinct[k + 1 :] if (a ^ b).bit_count() <= 2])
    least = {}
    for i, p in prints:
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    return sorted(((i, f"{p:016x}", least.get(root[p])) for i, p in prints), key=str)


def test_query_against_brute_force(spark):
    rows = pd.read_parquet(f"{SF_DIR}/documents.parquet")[["doc_id", "text"]].itertuples(index=False)
    got = op2_simhash(spark, SF_DIR).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == brute(list(rows))


def test_odd_rows(odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = near_copies(odd).selectExpr("doc_id", "lower(lpad(hex(print), 16, '0'))", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_links_connect_what_two_bits_tell_apart(spark):
    rng = random.Random(4)
    near = [0, -1]
    for _ in range(60):
        near += [near[rng.randrange(len(near))] ^ (1 << rng.randrange(63)) ^ rng.choice((0, -(1 << 63), 1 << rng.randrange(63)))]
    prints = sorted(set(near) | {rng.getrandbits(64) - 2**63 for _ in range(50)})
    found = links(spark.createDataFrame([(p,) for p in prints], "print long")).collect()
    exact = [(a, b) for k, a in enumerate(prints) for b in prints[k + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= 2]
    assert {(r["a"], r["b"]) for r in found} <= set(exact)
    assert components_of(prints, found) == components_of(prints, exact)


def within(prints):
    return [(a, b) for k, a in enumerate(prints) for b in prints[k + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= 2]


def test_lookups_find_all_and_whole_distances_reject(spark):
    rng = random.Random(6)
    signed = lambda x: x - 2**64 if x >> 63 else x
    base = [rng.getrandbits(64) for _ in range(40)]
    near = [b ^ 1 << i ^ 1 << j for b in base for i, j in (rng.sample(range(64), 2) for _ in range(8))]
    far = [b ^ (rng.getrandbits(32) << 32 * rng.randrange(2)) for b in base]  # one segment is the same, the other is not
    prints = sorted(map(signed, {*base, *near, *far}))
    frame = spark.createDataFrame([(p,) for p in prints], "print long")
    looked_up = {(r["a"], r["b"]) for r in matches(frame).collect()}
    exact = set(within(prints))
    assert exact <= looked_up and len(looked_up - exact) >= 40
    assert {(r["a"], r["b"]) for r in links(frame).collect()} == exact


def test_crowded_values_lose_no_link(spark):
    rng = random.Random(8)
    upper, lower = 0x7B00FF01, 0x12345678
    crowd = {upper << 32 | rng.getrandbits(9) for _ in range(3 * CROWD)} | {rng.getrandbits(9) << 32 | lower for _ in range(3 * CROWD)}
    guests = {p ^ 1 << 32 + rng.randrange(31) ^ rng.choice((0, 1 << rng.randrange(32))) for p in rng.sample(sorted(crowd), 150)}
    prints = sorted(crowd | guests)
    found = links(spark.createDataFrame([(p,) for p in prints], "print long")).collect()
    exact = within(prints)
    assert {(r["a"], r["b"]) for r in found} <= set(exact)
    assert components_of(prints, found) == components_of(prints, exact)
    assert len(found) < len(prints) * 40


def test_components_of_a_long_path_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(200)}


def test_one_of_each_group_stays(odd, documents):
    kept = without_near_copies(odd)
    assert kept.columns == odd.columns
    got = [r["doc_id"] for r in kept.collect()]  # of 1, 2, 3 without words 1, of the long texts 5, both texts of 7, one null
    assert sorted((i or 0) for i in got) == [0, 1, 4, 5, 7, 7, 8]
    assert without_near_copies(documents([])).count() == 0
    assert near_copies(documents([])).count() == 0

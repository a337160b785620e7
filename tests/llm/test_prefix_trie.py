"""The trie against a plain one, its hash against sets."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stopline.llm.prefix_trie import Slots, ordered_turns, spliced, trie

SCHEMA = "conv_id long, turn long, role string, text string, depth long, pos int, high string, one string, kind string"


def nodes(spark, rows):
    turns = ordered_turns(spark.createDataFrame([(*r, 7, 7, "x", "x", "x") for r in rows], SCHEMA))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    return sorted(map(tuple, trie(*spliced(turns, 5, head)).collect()), key=str)


def plain(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        donor = c - (c % 5 if c >= 0 else -(-c % 5))
        made[c] = own.get(donor, [])[:h] + turns[h:]
    number, parent, members, ends = {(): 0}, {0: None}, defaultdict(list), defaultdict(list)
    depth, size = {0: 0}, {0: 0}
    for c in sorted(made):
        at = 0
        members[0].append(c)
        for d, turn in enumerate(made[c], 1):
            key = (at, turn)
            if key not in number:
                number[key] = len(number)
                parent[number[key]], depth[number[key]], size[number[key]] = at, d, len(turn[1].encode())
            at = number[key]
            members[at].append(c)
        ends[at].append(c)
    if not made:
        return []
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for n in sorted(parent, key=lambda n: -depth[n]):
        saved[n] += (len(members[n]) - 1) * size[n]
        leaves[n] += children[n] == 0
        if parent[n] is not None:
            children[parent[n]] += 1
            leaves[parent[n]] += leaves[n]
            saved[parent[n]] += saved[n]
    sha = lambda n: hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest()
    low = {n: min(m) for n, m in members.items()}
    return sorted(((low[n], depth[n], None if parent[n] is None else low[parent[n]], len(members[n]), children[n], leaves[n], saved[n], sha(n)) for n in parent), key=str)


def talks(n, seed):
    """Conversations with few different turns, so that paths meet; some missing, some with one hot opening."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(2 * n), n):
        hot = rng.random() < 0.4
        rows += [(c, t, ("user", "assistant")[t % 2], "same opening" if hot and t < 3 else f"é{rng.randrange(3)}") for t in range(rng.randint(1, 12))]
    return rows


@pytest.mark.parametrize("band", [1024, 3])
def test_against_a_plain_trie(spark, band, monkeypatch):
    monkeypatch.setattr("stopline.llm.prefix_trie.BAND", band)
    monkeypatch.setattr("stopline.llm.prefix_trie.SHARD_ROWS", 50)
    rows = talks(300, 1)
    got = nodes(spark, rows)
    assert got == plain(rows) and len(got) > 500


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "no conversation"),
        (1, None, None, None),
        (1, 0, "user", ""),
        (5, 1, "user", "x"),
        (5, 1, "assistant", "x"),
        (6, 0, "user", "a,b"),
        (6, 0, "user", "a,b"),
        (-3, 0, "user", "below zero"),
        (0, 2, "user", "ünïcödé 🙂"),
        (0, 1, "", "empty role"),
        (12, 0, "user", "long " * 5000),
        (2**40 + 1, 0, "user", "x"),
        (3, 0, "ab", "c"),
        (4, 0, "a", "bc"),
    ]
    assert nodes(spark, rows) == plain(rows)
    assert nodes(spark, []) == [] and nodes(spark, rows[:1]) == []


def test_one_conversation_with_most_turns(spark, monkeypatch):
    monkeypatch.setattr("stopline.llm.prefix_trie.BAND", 16)
    monkeypatch.setattr("stopline.llm.prefix_trie.CHUNK", 64)
    rows = [(10, t, "user", f"turn {t // 2}") for t in range(1500)] + [(12, t, "user", f"turn {t // 2}") for t in range(900)]
    rows += [(20 + c, t, "user", f"turn {t // 2}") for c in range(60) for t in range(c % 9)]
    assert nodes(spark, rows) == plain(rows)


def test_slots_are_minimal_perfect_and_verified():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 50, 5000):
        distinct = rng.integers(-(2**63), 2**63 - 1, (n, 2))
        distinct[: n // 3, 0] = 17  # equal halves
        keys = distinct[rng.integers(0, n, 3 * n)] if n else distinct
        keys = np.concatenate([keys, distinct, distinct[:1].repeat(n, axis=0)])  # and one digest with a third of all rows
        slots = Slots(keys[:, 0].copy(), keys[:, 1].copy())
        assert slots.count == len(distinct) and sorted(set(slots.slot.tolist())) == list(range(n))
        assert (slots.high[slots.slot] == keys[:, 0]).all() and (slots.low[slots.slot] == keys[:, 1]).all()
        assert (slots.find(keys[:, 0].copy(), keys[:, 1].copy()) == slots.slot).all()
        assert (slots.find(keys[:, 1].copy(), keys[:, 0].copy()) == -1).all()


def test_a_digest_of_two_prefixes_is_an_error(spark, monkeypatch):
    turns = spark.createDataFrame([(1, 1, 3, 3, 5), (2, 1, 3, 3, 6)], "conv_id long, depth long, a long, b long, bytes long")
    with pytest.raises(Exception, match="a digest stands for"):
        trie(turns, spark.createDataFrame([(1, 1), (2, 1)], "conv_id long, n long"))

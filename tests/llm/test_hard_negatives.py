"""Hard negatives against plain sorting of all scores."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from stopline.llm.hard_negatives import hard_negatives, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, anchor_id long, slot long, row string, high long, down int"


def plain(rows, lower, upper, positives, negatives, every):
    fit = {}
    for i, v, label, *_ in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) or abs(x) >= 1 << 13 for x in v):
            continue
        row = (label, [math.floor(256 * x) for x in v])
        fit[i] = min(row, fit.get(i, row))
    out = []
    for a, (label, v) in fit.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in fit.items() if i != a)  # noqa: B905
        for p, pid, _ in [s for s in scored if s[2] == label][:positives]:
            band = [(-s, i) for s, i, other in scored if other != label and lower * -p <= 100 * -s <= upper * -p][:negatives]
            out += [(a, pid, r, i, -p, s) for r, (s, i) in enumerate(band, 1)]
    return sorted(out)


def mined(spark, rows, lower=30, upper=90, positives=5, negatives=10, every=10):
    frame = vectors(spark.createDataFrame(rows, SCHEMA), F.col("label"))
    return sorted(map(tuple, hard_negatives(frame, F.col("vec_id") % every == 0, lower, upper, positives, negatives).collect()))


def some(n, seed, dims=6, labels=4):
    rng = random.Random(seed)
    return [(i, [rng.uniform(-0.2, 1) for _ in range(dims)], rng.randrange(labels), 7, 7, "x", 7, 7) for i in range(n)]


@pytest.mark.parametrize("hot", [False, True])
def test_against_plain_sorting(spark, hot, monkeypatch):
    if hot:  # many cells of a few rows, and scores a few rows at a time
        for name, value in (("ROWS", 40), ("ANCHORS", 7), ("SCORES", 100)):
            monkeypatch.setattr(f"stopline.llm.hard_negatives.{name}", value)
    rows = some(400, 1)
    rows += [(1000 + i, rows[3][1], i % 4, *rows[0][3:]) for i in range(150)]  # a hot vector: ties go by id
    got = mined(spark, rows)
    assert got == plain(rows, 30, 90, 5, 10, 10) and len(got) > 500
    assert mined(spark, rows, 50, 100, 2, 3) == plain(rows, 50, 100, 2, 3, 10)


def test_odd_rows(spark):
    rest = (7, 7, "x", 7, 7)
    rows = some(60, 2) + [
        (None, [0.5] * 6, 1, *rest),
        (100, None, 1, *rest),
        (101, [0.5] * 6, None, *rest),
        (102, [0.5, None, 0.1, 0.2, 0.3, 0.4], 1, *rest),
        (103, [float("nan")] * 6, 1, *rest),
        (104, [float("inf")] * 6, 1, *rest),
        (105, [1e30] * 6, 1, *rest),
        (110, [], 1, *rest),
        (111, [0.7, 0.7], 1, *rest),
        (120, [-1.0] * 6, 2, *rest),
        (30, [0.9] * 6, 0, *rest),
        (-20, [0.4] * 6, 1, *rest),
    ]
    rows += rows[5:9]
    assert mined(spark, rows) == plain(rows, 30, 90, 5, 10, 10)
    assert mined(spark, []) == [] and mined(spark, rows[:1]) == [] and mined(spark, [(3, [1.0], 1, *rest)]) == []


def test_large_components_stay_exact(spark):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-8000, 8000) for _ in range(300)], i % 2, 7, 7, "x", 7, 7) for i in range(40)]
    assert mined(spark, rows) == plain([(i, [float(__import__("numpy").float32(x)) for x in v], *r) for i, v, *r in rows], 30, 90, 5, 10, 10)

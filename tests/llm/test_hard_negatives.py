"""Hard negatives against brute force, the tree's bounds, and odd rows."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hitloom.llm import hard_negatives as hn

KIND = "vec_id long, label int, embedding array<float>"


def usable(rows):
    good = {(i, y, tuple(v)) for i, y, v in rows if i is not None and y is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v)}
    width = max((len(v) for *_, v in good), default=0)
    whole = [(i, y, [math.floor(256 * float(np.float32(x))) for x in v]) for i, y, v in good]
    return [(i, y, v + [0] * (width - len(v))) for i, y, v in whole]


def brute(rows, k=5):
    points, out = usable(rows), []
    for i, y, v in points:
        if i % 10:
            continue
        score = [(-sum(a * b for a, b in zip(v, w)), j, z) for j, z, w in points if j != i]
        for p, pid, _ in sorted(s for s in score if s[2] == y)[:k]:
            window = sorted((s, j) for s, j, z in score if z != y and 80 * -p <= 100 * -s <= 100 * -p)
            out += [(i, pid, n + 1, j, -p, -s) for n, (s, j) in enumerate(window[:k])]
    return sorted(out)


def mined(spark, rows, **tree):
    df = spark.createDataFrame(rows, KIND).repartition(4).withColumn("id", F.lit("x")).withColumn("leaf", F.lit(1))
    return sorted(tuple(r) for r in hn.mine(df, F.col("vec_id") % 10 == 0, **tree).collect())


def cloud(r, n, dim=6, centres=5, spread=0.2):
    middle = [[r.uniform(-1, 1) for _ in range(dim)] for _ in range(centres)]
    return [(i, r.randrange(4), [x + r.gauss(0, spread) for x in r.choice(middle)]) for i in range(n)]


@pytest.mark.parametrize("tree", [{}, {"arity": 3, "leaf": 2, "sample": 60}])
def test_against_brute_force(spark, tree):
    rows = cloud(random.Random(5), 260)
    rows += [(1000 + i, i % 3, rows[7][2]) for i in range(60)]  # ties
    want = brute(rows)
    assert len(want) > 200 and mined(spark, rows, **tree) == want


def test_odd_rows(spark):
    rows = [*cloud(random.Random(6), 60, 3), (70, 1, None), (80, None, [1.0, 0.0, 0.0]), (90, 1, [1.0, None, 0.0]), (100, 1, [float("nan"), 0.0, 0.0]),
            (110, 2, [float("inf"), 0.0, 0.0]), (None, 1, [1.0, 0.0, 0.0]), (120, 1, []), (130, 1, [1.0]), (130, 1, [1.0]), (10, 3, [0.5, 0.5, 0.5])]
    # An id with two vectors is two anchors, each without the other.
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, []) == [] and mined(spark, [(10, 1, [1.0])]) == [] and mined(spark, [(10, 1, [0.0]), (11, 1, [0.0]), (12, 2, [0.0])])
    assert mined(spark, [(10, 1, None)]) == []


def test_leaves_left_out_hold_nothing():
    """Every row whose score lies in a window is in a leaf that is reached; most leaves are not."""
    r = np.random.default_rng(1)
    x = (256 * (r.normal(size=(40, 8))[r.integers(0, 40, 3000)] + 0.03 * r.normal(size=(3000, 8)))).astype(int).astype(float)
    square = float((x * x).sum(axis=1).max())
    tree = hn.grown(hn.lifted(x[:800], square), square)
    leaf, seen = hn.placed(tree, hn.lifted(x, square))
    spans = [np.stack([np.full((len(n.points),) * 2, np.inf), np.full((len(n.points),) * 2, -np.inf)]) for n in tree.nodes]
    for at, d, own in seen:
        for j in set(own):
            spans[at][0][:, j], spans[at][1][:, j] = d[own == j].min(axis=0), d[own == j].max(axis=0)
    q, score = x[:50], x[:50] @ x.T
    high = np.sort(score, axis=1)[:, [-5, -300]].astype(int)
    low = (0.98 * high).astype(int)
    found = hn.reached(tree._replace(ranges=spans), q, low, high)
    for i in range(50):
        inside = ((score[i][:, None] >= low[i]) & (score[i][:, None] <= high[i])).any(axis=1)
        assert set(leaf[inside]) <= set(found[i])
    assert sum(map(len, found)) < 0.5 * 50 * tree.leaves


def test_first_of_equal_scores():
    r = np.random.default_rng(2)
    for _ in range(50):
        s = r.integers(0, 4, size=(5, 30))
        s[r.random(s.shape) < 0.5] = hn.LEAST
        i, j = hn.best_in(s, 4)
        for row in range(5):
            want = sorted((-v, c) for c, v in enumerate(s[row]) if v > hn.LEAST)[:4]
            assert sorted(j[i == row]) == sorted(c for _, c in want)

"""Ranked search against brute force, over few and many segments, and odd rows."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hitloom.llm import ranked_search as rs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
KINDS = "doc_id long, text string", "item_id long, text string"


def terms(text):
    return TERM.findall((text or "").translate(ASCII))


def brute(docs, items, top):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in counted]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for i, text in set(items):
        scored = []
        for (d, c), size in zip(counted, sizes):
            score = 0
            for t in set(terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 20 * (50 + (50 * size * n) // total)))
            if score > 0:
                scored.append((-score, d is None, d))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(i, k + 1, d, -s) for k, (s, _, d) in enumerate(scored[:top])]
    return sorted(out, key=str)


def searched(spark, docs, items, top):
    d = spark.createDataFrame(docs, KINDS[0]).repartition(4).withColumn("n", F.lit("x")).withColumn("code", F.lit(0))
    q = spark.createDataFrame(items, KINDS[1]).withColumn("rank", F.lit(0))
    got = rs.ranked_search(d, q, top=top)
    return sorted((tuple(r)[:4] for r in got.collect()), key=str)


def made(r, n, words=400):
    pick = [f"w{k}" for k in range(words)]
    weights = [1 / (k + 1) for k in range(words)]
    return [(i, " ".join(r.choices(pick, weights, k=r.choice([3, 20, 150])))) for i in range(n)]


def test_against_brute_force(spark, monkeypatch):
    r = random.Random(3)
    docs = made(r, 500)
    docs += [(1000 + i, docs[5][1]) for i in range(80)]  # ties
    items = [(k, " ".join(docs[r.randrange(500)][1].split()[:12]) + " W1 w2,W3") for k in range(12)] + [(99, docs[5][1])]
    want = brute(docs, items, 7)
    assert len(want) == 13 * 7 and searched(spark, docs, items, 7) == want
    # Thresholds of a sample, several sets of items.
    monkeypatch.setattr(rs, "SAMPLE", 100)
    monkeypatch.setattr(rs, "CHARS", 300)
    assert searched(spark, docs, items, 7) == want


def test_segments_and_bounds():
    """Blocks of small segments, walked by the task's code: the same documents, most blocks left out."""
    r = np.random.default_rng(1)
    best = rs.Best(1, 3)
    scores = r.integers(0, 50, 400)
    for start in range(0, 400, 7):
        s = scores[start : start + 7]
        best.add(s, np.zeros(len(s), dtype=int), np.arange(start, start + len(s)))
    want = sorted((-int(s), i) for i, s in enumerate(scores))[:3]
    assert [(int(a), int(c)) for a, _, c in best.rows] == want and best.least == -want[-1][0]
    asked, weights, most = [np.array([2, 0, 1])], np.array([3, 1, 5]), np.array([10, 10, 10])
    assert rs.charge(asked, weights, most, np.array([41])) == {2: [(0, 0)]}
    assert rs.charge(asked, weights, most, np.array([40])) == {2: [(0, 0)], 0: [(0, 1)]}


def test_odd_rows(spark):
    r = random.Random(4)
    docs = [*made(r, 40, 30), (None, "w1 w2"), (None, "w1 w2"), (3, "w1 w2"), (3, "w1 w2"), (50, None), (51, ""), (52, " -- "), (53, "ñandú W1" + " w5" * 60_000)]
    items = [(1, "w1 W2 w2"), (1, "w1 W2 w2"), (1, "ÑANDÚ ñandú"), (2, None), (None, "w5"), (4, ""), (5, "absent"), (6, "w5 " * 20_000 + " ".join(f"x{k}" for k in range(9000)))]
    want = brute(docs, [(i, t) for i, t in items if t is not None], 60)
    assert searched(spark, docs, items, 60) == want
    assert searched(spark, [], items, 5) == [] and searched(spark, docs, [], 5) == [] and searched(spark, [(1, None)], items, 5) == []


@pytest.mark.parametrize("text", ["Aé_b1 z", "", None, "A" * 10 + "-\x85x"])
def test_terms(text):
    assert [t.decode() for t in rs.terms(text)] == terms(text)

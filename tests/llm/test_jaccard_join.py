import random

import brute
import numpy as np
import pytest

from hitloom.llm import jaccard_join as jj
from hitloom.llm.jaccard_join import jaccard_join


def copies(seed, n=160):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, bases = [], [[r.choice(vocabulary) for _ in range(r.choice([1, 2, 4, 9, 30, 120, 500]))] for _ in range(12)]
    for i in range(n):
        words = list(r.choice(bases))
        for _ in range(r.choice([0, 0, 1, 2, 5]) * (len(words) // 40 + 1)):
            words[r.randrange(len(words))] = r.choice(vocabulary)
        rows.append((i, " ".join(words)))
    return [*rows, (1000, None), (1001, ""), (1002, " \n\t"), (1003, "A b C"), (1004, "a  B\nc")]


@pytest.mark.parametrize("width, num, den", [(3, 90, 100), (5, 8, 10), (1, 7, 10)])
def test_same_groups_as_brute_force(spark, width, num, den):
    rows = copies(width)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join(df, width=width, num=num, den=den).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.jaccard(rows, width, num, den)


def test_linked_sets_share_a_key():
    r = np.random.default_rng(5)
    for n in (12, 40, 150, 800, 5000):
        for _ in range(30):
            a = r.integers(0, 2**63, n).astype(np.uint64)
            d = int(n * 0.1)
            b = np.concatenate([a[d:], r.integers(0, 2**63, d).astype(np.uint64)])
            allowed = jj.differences(2 * n, 8, 10)
            assert len(np.setxor1d(a, b)) <= allowed
            assert len(np.intersect1d(jj.block_keys(a, 3, allowed), jj.block_keys(b, 3, allowed)))
            mark = np.unpackbits(jj.sketch(a, allowed).view(np.uint8) ^ jj.sketch(b, allowed).view(np.uint8)).sum()
            assert mark <= len(np.setxor1d(a, b))


def test_bands_hold_linked_sizes():
    firsts = jj.edges_of_bands(3000, 8, 10)
    band = lambda n: np.searchsorted(firsts, n, side="right")
    assert all(band(n * 10 // 8) - band(n) <= 1 for n in range(1, 2000))


def test_odd_tables(spark):
    kind = "text string, doc_id long, component_id string, h1 long, key string"
    assert jaccard_join(spark.createDataFrame([], kind)).count() == 0
    long = " ".join(f"x{i % 977}" for i in range(60000))
    rows = [("a b c d e f", 1, "x", 0, None), ("a b c d e f", 1, "x", 0, None), ("a b c d e f", None, "y", 0, None), (long, 7, "", 0, ""), (long, 8, "", 0, "")]
    got = sorted(map(tuple, jaccard_join(spark.createDataFrame(rows, kind)).collect()), key=str)
    assert got == [(1, 2, 1, 1), (1, 2, 1, 1), (7, 977, 7, 7), (8, 977, 7, 7), (None, 2, None, None)]


def test_copy_without_an_id_hides_no_link(spark):
    words = [f"w{i}" for i in range(200)]
    text, near = " ".join(words), " ".join([*words[:-1], "other"])
    rows = [(None, text), (1, text), (2, near), (3, near)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = sorted(tuple(r) for r in jaccard_join(df).where("doc_id is not null").select("doc_id", "component_id", "class_id").collect())
    assert got == [(1, 1, 1), (2, 1, 2), (3, 1, 2)]
    alone = jaccard_join(df).where("doc_id is null").collect()
    assert [(r.n_shingles, r.component_id, r.class_id) for r in alone] == [(196, None, None)]

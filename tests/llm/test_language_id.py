"""Language identification: held-out accuracy, vectors against plain counting, and odd rows."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hitloom.llm import language_id as li
from hitloom.llm import queries as q

WORDS = {
    "aa": ["the", "thing", "and", "ther", "ing", "edness", "hand"],
    "bb": ["que", "ción", "llos", "para", "ado", "ñandú", "mente"],
    "cc": ["und", "schaft", "über", "ein", "ich", "keit", "gä"],
}


def sentence(r, lang, n):
    return " ".join("".join(r.choices(WORDS[lang], k=r.randrange(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(4)
    return [(i, sentence(r, lang, r.choice([3, 8, 60])), lang) for i in range(900) for lang in [r.choice(list(WORDS))]]


def grams(text):
    low = " " + re.sub(r"[\x00-\x60\x7B-\x7F]+", " ", text.lower()).strip() + " "
    data = low.encode()
    return Counter(data[i : i + n] for n in li.ORDERS for i in range(len(data) - n + 1))


def test_counts_against_plain_counting():
    """Trailing windows are padded with blanks, so only those inside the text are compared."""
    r = random.Random(1)
    for text in ["", "a", "Ñandú -- 12 x", sentence(r, "bb", 500)]:
        found, plain = li.counts(text), np.zeros(li.BUCKETS, dtype=int)
        for gram, n in grams(text).items():
            code = int.from_bytes(gram, "big") + len(gram)
            mixed = code * 0x9E3779B1 % 2**32
            plain[(mixed ^ (mixed >> 15)) % li.BUCKETS] += n
        assert (found >= plain).all() and found.sum() - plain.sum() <= 3 * len(li.ORDERS)


def test_held_out_accuracy(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    got = {r.doc_id: r for r in li.identify(df).collect()}
    test = [x for x in rows if zlib.crc32(str(x[0]).encode()) % 4 == 2]
    assert len(test) > 150 and np.mean([got[i].nearest == lang for i, _, lang in test]) > 0.98
    assert all(0 <= r.score <= 1 and (r.lang is None) == r.rejected for r in got.values())
    assert np.mean([r.rejected for r in got.values()]) < 0.06


def test_weights_and_far_texts(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = li.fit(df, sample=200)
    held = sum((li.counts(t) > 0).astype(int) for _, t, _ in rows)
    assert np.allclose(model.weights, np.log((1 + len(rows)) / (1 + held)) + 1, atol=1e-5)
    per = Counter(model.langs)
    assert set(per) == set(WORDS) and max(per.values()) == li.CENTROIDS
    far = spark.createDataFrame([(1, "zzyx qqwv jjkx xqzj " * 30)], "doc_id long, text string")
    assert li.predict(far, model).first().rejected
    assert math.isclose(float(np.linalg.norm(model.centroids[0])), 1, abs_tol=1e-4)


def test_odd_rows(spark, rows):
    odd = [
        (None, "the thing and", "aa"), (1, None, "aa"), (1, "", None), (2, "12 -- !!", "bb"), (2, "12 -- !!", "bb"),
        (5, "ñ", None), (6, "the hand " * 60_000, "aa"), (7, "퟿\x00 thing", None),
    ]
    df = spark.createDataFrame(rows[:200] + odd, "doc_id long, text string, lang string").withColumn("nearest", F.lit(1)).withColumn("score", F.lit(2))
    got = li.identify(df).collect()
    assert len(got) == 208
    und = [r for r in got if r.nearest is None]
    assert sorted(r.doc_id for r in und if r.score == 0 and r.rejected) == sorted(
        [1, 1, 2, 2]
    )
    assert {r.nearest for r in got if r.doc_id == 6} >= {"aa"}
    assert [r.nearest for r in got if r.doc_id is None] == ["aa"]
    empty = df.limit(0)
    assert li.identify(empty).count() == 0
    untaught = li.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert len(untaught) == 208 and all(r.nearest is None and r.score == 0 for r in untaught)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    got = q.op13_language_id(spark, folder).join(q.documents(spark, folder).select("doc_id", "lang"), "doc_id").collect()
    test = [r for r in got if r.held_out]
    assert len(got) == 200 and np.mean([r.lang == r.lang_pred for r in test]) > 0.95

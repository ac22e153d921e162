"""Skewed joins, running sums, ranks, quotas and quantiles against plain computation."""

import math
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from hitloom.functions.tails import u_distribution, u_two_sided
from hitloom.operators import ranking as rk
from hitloom.operators.attribution import hash_ranks
from hitloom.operators.hypothesis import hypothesis_table
from hitloom.operators.metrics import best_threshold, binary_metrics, class_report, confusion_cells, roc_auc
from hitloom.operators.quantiles import exact_quantiles
from hitloom.operators.skew import salted_join


def skewed(spark, n=3000):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise((F.col("id") % 400).cast("string"))
    return spark.range(n).select("id", key.alias("k"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join(spark, how):
    many = skewed(spark)
    few = spark.createDataFrame([("hot", 1), ("hot", 2), ("5", 3), ("7", 4), ("none", 5)], "k string, v int")
    want = sorted(map(tuple, many.join(few, "k", how).select("id", "k", "v").collect()), key=str)
    got = sorted(map(tuple, salted_join(many, few, ["k"], how).select("id", "k", "v").collect()), key=str)
    assert got == want


def brute_u(pos, neg):
    return float(sum((pos[:, None] > neg).sum(1) + 0.5 * (pos[:, None] == neg).sum(1)))


@pytest.mark.parametrize("per_range", [1, 40, 10**6])
def test_rank_statistics(spark, per_range):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 700)
    x = np.where(rng.random(700) < 0.3, 0.5, rng.normal(size=700)).round(2)
    z = rng.integers(0, 4, 700).astype(float)
    df = spark.createDataFrame([(int(a), float(b), float(c) if c else None) for a, b, c in zip(y, x, z)], "y int, x double, z double")
    got = {r.feature: r for r in rk.rank_statistics(df, ["x", "z"], "y", per_range).collect()}
    assert got["x"].u == brute_u(x[y == 1], x[y == 0])
    assert got["z"].u == brute_u(z[(y == 1) & (z > 0)], z[(y == 0) & (z > 0)])
    _, n = np.unique(x, return_counts=True)
    assert got["x"].tie_sum == float((n.astype(float) ** 3 - n).sum())


def test_signed_zero_is_one_score(spark):
    df = spark.createDataFrame([(1, 0.0), (0, -0.0), (1, 1.0), (0, 0.5)], "is_hit int, s double")
    assert roc_auc(df, "s").first().roc_auc == (0.5 + 0 + 1 + 1) / 4


def test_one_class(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.3)], "is_hit int, s double")
    assert roc_auc(df, "s").first().roc_auc is None
    assert best_threshold(df, "s").first().threshold == 0.5


def test_best_threshold(spark):
    rng = np.random.default_rng(5)
    y, s = rng.integers(0, 2, 300), rng.integers(0, 40, 300) / 40
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "is_hit int, s double")

    def f1(t):
        tp, fp = ((s >= t) & (y == 1)).sum(), ((s >= t) & (y == 0)).sum()
        p, r = tp / (tp + fp), tp / (y == 1).sum()
        return 2 * p * r / (p + r + 1e-8)

    assert best_threshold(df, "s", rows_per_range=4).first().threshold == max(sorted(set(s)), key=f1)


def test_published_confusion_matrix(spark):
    counts = spark.createDataFrame([(221, 155, 10, 14)], "tn bigint, fp bigint, fn bigint, tp bigint")
    m = binary_metrics(counts).first()
    assert m.accuracy == 0.5875 and m.f1 == pytest.approx(0.14507772020725387, abs=1e-15)
    assert m.precision == pytest.approx(0.08284023668639054) and m.recall == pytest.approx(0.5833333333333334)
    report = {r["class"]: r for r in class_report(counts).collect()}
    assert round(report["macro avg"].precision, 2) == 0.52 and round(report["weighted avg"].f1, 2) == 0.69
    assert (report["0"].support, report["1"].support) == (376, 24)


def test_undefined_metrics_are_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "is_hit int, prediction int")
    cells = {(r.label, r.predicted): r.n for r in confusion_cells(df).collect()}
    assert cells == {(0, 0): 2, (0, 1): 0, (1, 0): 0, (1, 1): 0}
    m = binary_metrics(spark.createDataFrame([(2, 0, 0, 0)], "tn bigint, fp bigint, fn bigint, tp bigint")).first()
    assert (m.accuracy, m.precision, m.recall, m.f1) == (1.0, 0.0, 0.0, 0.0)


def test_exact_quantiles(spark):
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=50001), rng.integers(0, 3, 50001).astype(float)
    df = spark.createDataFrame([(float(x), float(y) if y else None) for x, y in zip(a, b)], "a double, b double")
    got = {(r.feature, r.p): r.value for r in exact_quantiles(df.repartition(8), ["a", "b"], [0.0, 0.25, 0.5, 0.9, 1.0]).collect()}
    for p in (0.0, 0.25, 0.5, 0.9, 1.0):
        assert got["a", p] == pytest.approx(np.quantile(a, p), abs=1e-12)
        assert got["b", p] == pytest.approx(np.quantile(b[b > 0], p))
    small = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "a double")
    assert exact_quantiles(small, ["a"], [0.5]).first().value == 2.5


def test_split_and_folds_do_not_depend_on_partitions(spark):
    df = spark.range(5003).select(F.col("id").alias("k"), (F.col("id") % 9 == 0).cast("int").alias("y"))

    def parts(frame):
        test = rk.with_test_flag(frame, "y", "k", 42, 0.2).where("is_test")
        folds = rk.with_folds(frame, "y", "k", 1, 5)
        return sorted(r.k for r in test.collect()), sorted((r.k, r.fold) for r in folds.collect())

    one = parts(df)
    assert one == parts(df.repartition(7, F.rand(1)))
    assert len(one[0]) == 1001  # ceil(0.2 * 5003)
    sizes = rk.with_folds(df, "y", "k", 1, 5).groupBy("y", "fold").count().collect()
    for y in (0, 1):
        n = [r["count"] for r in sizes if r.y == y]
        assert len(n) == 5 and max(n) - min(n) <= 1


def test_folds_of_a_tiny_class(spark):
    df = spark.createDataFrame([(i, int(i < 2)) for i in range(30)], "k int, y int")
    rows = rk.with_folds(df, "y", "k", 1, 5).collect()
    assert len(rows) == 30 and len({r.fold for r in rows if r.y == 1}) == 2


def test_fixed_sample(spark):
    df = spark.range(1000)
    one = sorted(r.id for r in rk.fixed_sample(df, 50, "id", 3).collect())
    assert len(one) == 50 and one == sorted(r.id for r in rk.fixed_sample(df.repartition(9), 50, "id", 3).collect())
    assert rk.fixed_sample(df, 0, "id", 3).count() == 1000
    assert rk.fixed_sample(df, 5000, "id", 3).count() == 1000


def test_hash_ranks(spark):
    df = spark.range(500).select("id", (F.col("id") % 2).alias("g"))
    rows = hash_ranks(df, ["g"], rk.hash_order(F.col("id"), 1), "i").collect()
    for g in (0, 1):
        assert sorted(r.i for r in rows if r.g == g) == list(range(250))


def test_constant_columns_over_partitions(spark):
    """A constant has no correlation and no spread, however its rows are dealt out."""
    from hitloom.operators.eda import correlations
    from hitloom.operators.preparation import numeric_statistics

    for parts in (3, 7, 13):
        df = spark.range(1000).selectExpr("0.1D AS a", "id * 0.3D AS b", "1D / 3 AS c").repartition(parts)
        got = {(r.feature_a, r.feature_b): r["corr"] for r in correlations(df, ["a", "b", "c"]).collect()}
        assert got[("b", "b")] == 1.0 and all(v is None for k, v in got.items() if k != ("b", "b"))
        spread = {r.feature: r["std"] for r in numeric_statistics(df, ["a", "b", "c"]).collect()}
        assert spread["a"] == 0.0 and spread["c"] == 0.0 and spread["b"] > 1


def test_quantile_brackets_that_miss_are_widened(spark, monkeypatch):
    from hitloom.operators import quantiles

    monkeypatch.setattr(quantiles, "MARGIN", 0.0)
    a = np.random.default_rng(3).normal(size=4000)
    rows = spark.createDataFrame([(float(x), None) for x in a], "a double, none double")
    got = {(r.feature, r.p): r.value for r in exact_quantiles(rows, ["a", "none"], [0.1, 0.5, 0.77]).collect()}
    assert got == {("a", p): pytest.approx(np.quantile(a, p), abs=1e-12) for p in (0.1, 0.5, 0.77)}


@pytest.mark.parametrize("m,n", [(1, 1), (2, 5), (4, 4), (3, 8), (8, 8)])
def test_exact_law_of_u(m, n):
    """Against all ways to place m of m + n ranks."""
    ways = Counter(sum(c) - m * (m - 1) // 2 for c in combinations(range(m + n), m))
    total = sum(ways.values())
    assert u_distribution(m, n) == pytest.approx([ways[u] / total for u in range(m * n + 1)], abs=1e-13)
    for u in range(m * n + 1):
        less = sum(w for v, w in ways.items() if v <= min(u, m * n - u)) / total
        assert u_two_sided(u, m, n) == pytest.approx(min(1, 2 * less), abs=1e-12)
    assert sum(u_distribution(8, 50_000)) == pytest.approx(1)


def test_law_of_u_is_chosen_by_size_and_ties(spark):
    rows = [(int(i < 5), float(i), float(i // 2), float(i) if i < 12 else None, 0.1) for i in range(40)]
    got = {r.feature: r for r in hypothesis_table(spark.createDataFrame(rows, "is_hit int, a double, b double, c double, d double"), ["a", "b", "c", "d"]).collect()}
    assert [got[f].status_p for f in "abcd"] == ["exact", "asymptotic", "exact", "asymptotic"]
    assert got["a"].mannwhitney_u_p_value == pytest.approx(2 / math.comb(40, 5))
    assert got["c"].mannwhitney_u_p_value == pytest.approx(2 / math.comb(12, 5))
    # A constant column has no spread, so no t and no effect.
    assert got["d"].welch_t_stat is None and got["d"].cohens_d is None


def test_more_ranges_than_1024(spark):
    """A range per row or two: the same ranks, curve and quantiles as in one range."""
    rng = np.random.default_rng(11)
    x, y = np.concatenate([rng.normal(size=1100), np.zeros(300)]), rng.integers(0, 2, 1400)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, x)], "is_hit int, x double")
    fine, coarse = (rk.rank_statistics(df, ["x"], "is_hit", n).first() for n in (1, 10**6))
    assert fine == coarse and fine.u == brute_u(x[y == 1], x[y == 0])
    got = {r.p: r.value for r in exact_quantiles(df, ["x"], [0.1, 0.5, 0.9], 2).collect()}
    assert got == pytest.approx({p: np.quantile(x, p) for p in (0.1, 0.5, 0.9)})

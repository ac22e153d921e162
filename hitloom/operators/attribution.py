"""Feature attributions in long form: (row, feature, value)."""

from __future__ import annotations

import math
import random
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hitloom.operators.metrics import binary_metrics
from hitloom.operators.network import Net, input_gradient
from hitloom.operators.quantiles import exact_quantiles
from hitloom.operators.ranking import HASH_DIGITS, hash_order
from hitloom.session import settle

GROUP_SCHEMA = "feature string, feature_group string, group_ord int"


def importance(values: DataFrame, feature: str = "feature", value: str = "value") -> DataFrame:
    """Mean absolute attribution per feature."""
    return values.groupBy(feature).agg(F.avg(F.abs(value)).alias("mean_abs_shap"))


def top_importance(values: DataFrame, k: int = 15) -> DataFrame:
    return importance(values).orderBy(F.col("mean_abs_shap").desc(), "feature").limit(k)


def linear_values(rows: DataFrame, background: DataFrame, weights: dict[str, float], key: str) -> DataFrame:
    """Attributions of a linear score: weight times distance from the background mean."""
    means = background.agg(F.struct(*[F.avg(c).alias(c) for c in weights]).alias("m")).scalar()
    cells = [
        F.struct(F.lit(c).alias("feature"), (F.lit(float(w)) * (F.col(c) - means[c])).alias("value"))
        for c, w in weights.items()
    ]
    return rows.select(key, F.inline(F.array(*cells)))


def long_values(rows: DataFrame, key: str, values: Column, names: tuple[str, ...] | list[str]) -> DataFrame:
    """An array of attributions as (key, feature, value) rows."""
    exploded = rows.select(key, F.posexplode(values).alias("i", "value"))
    return exploded.select(key, F.element_at(F.array(*map(F.lit, names)), F.col("i") + 1).alias("feature"), "value")


def grouped_values(values: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """Attributions summed back to raw columns and ranked per row by size, first group first.

    ``groups`` is (feature, feature_group, group_ord) with one row per model feature.
    """
    # One shuffle by row serves both the sums and the ranks.
    total = (
        values.join(F.broadcast(groups), "feature")
        .repartition(key)
        .groupBy(key, "feature_group")
        .agg(F.sum("value").alias("attribution"), F.min("group_ord").alias("group_ord"))
    )
    size = F.abs("attribution")
    order = Window.partitionBy(key).orderBy(size.desc(), "group_ord")
    return total.select(
        key, "feature_group", "attribution", size.alias("abs_attribution"), F.row_number().over(order).alias("rank")
    )


def conservation(values: DataFrame, grouped: DataFrame, key: str) -> DataFrame:
    """Largest difference between the raw and the grouped sum of a row."""
    raw = values.groupBy(key).agg(F.sum("value").alias("raw"))
    summed = grouped.groupBy(key).agg(F.sum("attribution").alias("grouped"))
    return raw.join(summed, key).agg(F.max(F.abs(F.col("raw") - F.col("grouped"))).alias("max_abs_diff"))


def wide_values(values: DataFrame, key: str, names: list[str] | tuple[str, ...]) -> DataFrame:
    return values.groupBy(key).pivot("feature", list(names)).agg(F.first("value"))


def hash_ranks(df: DataFrame, groups: list[str], order: Column, name: str) -> DataFrame:
    """Rank 0.. in hash order within groups; hash prefixes split a group over tasks."""
    placed = df.withColumns({"_h": order, "_p": F.substring(order, 1, HASH_DIGITS)})
    counts = placed.groupBy(*groups, "_p").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*groups, "_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inner = Window.partitionBy(*groups, "_p").orderBy("_h")
    ranked = placed.join(starts, [*groups, "_p"])
    return ranked.withColumn(name, F.col("_start") + F.row_number().over(inner) - 1).select(*df.columns, name)


def permutation_of(n: int, seed: int, repeat: int) -> tuple[int, int, int]:
    """(a, b, n) of a permutation i -> (a i + b) mod n of the first n numbers."""
    draw = random.Random(f"{seed} {repeat}")
    a = draw.randrange(1, max(2, n))
    while math.gcd(a, n) != 1:
        a = draw.randrange(1, max(2, n))
    return a, draw.randrange(max(1, n)), max(1, n)


def multiplied(i: str, a: str, b: str, n: str) -> Column:
    """(a i + b) mod n, in decimals wide enough for the product."""
    wide = F.col(i).cast("decimal(19,0)") * F.col(a).cast("decimal(19,0)") + F.col(b).cast("decimal(19,0)")
    return F.pmod(wide, F.col(n).cast("decimal(19,0)")).cast("bigint")


def permutation_importance(
    rows: DataFrame,
    key: str,
    label: str,
    names: tuple[str, ...],
    probability: Callable[[Column], Column],
    threshold: float,
    repeats: int = 5,
    seed: int = 42,
) -> DataFrame:
    """Drop in F1 when one transformed feature (array column ``x``) is shuffled.

    A repeat is one permutation for all features: the row of hash rank i takes a feature from the row
    of rank (a i + b) mod n, with a prime to n. Rows meet their donors once per repeat, and features are
    told apart only then, so what is shuffled does not grow with their number. All rows are donors; written
    small as repeated categories are, they would pass for a table to broadcast, so the join is said to sort.
    """
    base = settle(hash_ranks(rows.select(key, label, "x"), [], hash_order(F.col(key), seed), "i"))
    moves = [(r, *permutation_of(base.count(), seed, r)) for r in range(1, repeats + 1)]
    drawn = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(n).alias("n")) for r, a, b, n in moves])
    asked = base.withColumn("t", F.explode(drawn)).select(label, "x", "t.r", multiplied("i", "t.a", "t.b", "t.n").alias("i"))
    met = asked.join(base.select("i", F.col("x").alias("given")).hint("merge"), "i")
    changed = met.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(len(names) - 1)))).withColumn(
        "x", F.transform("x", lambda v, n: F.when(n == F.col("j"), F.element_at("given", n + 1)).otherwise(v))
    )

    def f1(scored: DataFrame, *groups: str) -> DataFrame:
        hit = (probability(F.col("x")) >= F.lit(threshold)).cast("int")
        decided = scored.withColumn("hit", hit)
        cells = {
            n: F.count_if((F.col(label) == y) & (F.col("hit") == p))
            for n, y, p in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))
        }
        return binary_metrics(decided.groupBy(*groups).agg(*[c.alias(n) for n, c in cells.items()]))

    baseline = f1(rows).select("f1").scalar()
    drops = f1(changed, "j", "r").withColumn("drop", baseline - F.col("f1"))
    per_feature = drops.groupBy("j").agg(
        F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std")
    )
    everything = Window.orderBy(F.col("importance_mean").desc(), "j")  # one row per feature
    return per_feature.select(
        F.row_number().over(everything).alias("rank"),
        F.element_at(F.array(*map(F.lit, names)), F.col("j") + 1).alias("feature"),
        "importance_mean",
        "importance_std",
        baseline.alias("baseline_f1"),
    )


def median_baseline(rows: DataFrame, names: tuple[str, ...]) -> np.ndarray:
    """Median of every transformed feature (array column ``x``); 0 where there is none."""
    columns = [f"x{i}" for i in range(len(names))]
    wide = rows.select(*[F.element_at("x", i + 1).alias(c) for i, c in enumerate(columns)])
    found = {r["feature"]: r["value"] for r in exact_quantiles(wide, columns, [0.5]).collect()}
    values = np.array([np.nan if found.get(c) is None else found[c] for c in columns])
    return np.where(np.isfinite(values), values, 0.0)


def _array_udf(function):
    @F.pandas_udf("array<double>")
    def call(x: pd.Series) -> pd.Series:
        return pd.Series(list(function(np.stack(x.to_numpy()))) if len(x) else [], dtype="object")

    return call


def integrated_gradients(net: Net, baseline: np.ndarray, steps: int, x: Column) -> Column:
    """Integrated gradients of the logit from a baseline, by Gauss-Legendre quadrature."""
    nodes, weights = np.polynomial.legendre.leggauss(steps)
    alphas, weights, flat = (nodes + 1) / 2, weights / 2, net.weights

    def attribute(rows: np.ndarray) -> np.ndarray:
        away = rows - baseline
        mean = sum(w * input_gradient(flat, baseline + a * away) for a, w in zip(alphas, weights))
        return away * mean

    return _array_udf(attribute)(x)


def expected_gradients(net: Net, background: np.ndarray, seed: int, x: Column) -> Column:
    """Expected gradients of the logit over a bounded background sample.

    Every background row is one path; its position on the path is drawn once from the seed.
    """
    alphas, flat = np.random.default_rng(seed).random(len(background)), net.weights

    def attribute(rows: np.ndarray) -> np.ndarray:
        total = np.zeros_like(rows)
        for base, a in zip(background, alphas):
            away = rows - base
            total += away * input_gradient(flat, base + a * away)
        return total / len(background)

    return _array_udf(attribute)(x)

"""Summaries and reports that explain a trained run."""

from __future__ import annotations

from dataclasses import asdict

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.contracts import ExplainSettings
from hitloom.operators import attribution as at
from hitloom.operators.forest import forest_values, leaves
from hitloom.operators.network import Net
from hitloom.operators.preparation import Prepared, feature_groups
from hitloom.operators.ranking import fixed_sample
from hitloom.plans.training import Trained
from hitloom.session import settle
from hitloom.sources.sinks import write_csv, write_document

# Sample sizes of the summaries.
BACKGROUND, EXPLAINED, TOP = 300, 400, 15
NET_BACKGROUND, NET_EXPLAINED = 200, 250


def transformed(df: DataFrame, prepared: Prepared, *kept: str) -> DataFrame:
    """Kept columns and the transformed features as an array ``x``."""
    return prepared.transform(df).select(*kept, vector_to_array("features").alias("x"))


def _samples(run: Trained, background: int, explained: int, seed: int) -> tuple[DataFrame, DataFrame]:
    key = run.split.key
    inner = fixed_sample(run.split.train, background, key, seed)
    outer = fixed_sample(run.split.test, explained, key, seed + 1)
    return transformed(inner, run.prepared, key), transformed(outer, run.prepared, key)


def _matrix(rows: DataFrame) -> np.ndarray:
    """A sample of parameter-bounded size as a matrix."""
    return np.array([r.x for r in rows.select("x").collect()], dtype="float64")


def linear_summary(
    run: Trained, seed: int = 42, background: int = BACKGROUND, explained: int = EXPLAINED, k: int = TOP
) -> DataFrame:
    """Mean absolute attribution of the linear model's features, largest first."""
    inner, outer = _samples(run, background, explained, seed)
    coefficients = run.classifier.coefficients.toArray().tolist()
    mean = F.array(*[F.avg(F.element_at("x", i + 1)) for i in range(len(coefficients))])
    centre = F.array(*map(F.lit, inner.agg(mean.alias("m")).first()["m"]))  # one number per feature
    weights = F.array(*map(F.lit, coefficients))
    away = F.zip_with("x", centre, lambda a, b: a - b)
    values = F.zip_with(away, weights, lambda a, w: a * w)
    return at.top_importance(at.long_values(outer, run.split.key, values, run.prepared.names), k)


def forest_summary(
    run: Trained, seed: int = 42, background: int = BACKGROUND, explained: int = EXPLAINED, k: int = TOP
) -> DataFrame:
    """Mean absolute exact Shapley value of the forest's features, largest first."""
    inner, outer = _samples(run, background, explained, seed)
    spark = inner.sparkSession
    spread = outer.repartition(spark.sparkContext.defaultParallelism, run.split.key)
    values = forest_values(leaves(spark, run.classifier), _matrix(inner), F.col("x"))
    valued = settle(spread.select(run.split.key, values.alias("values")))
    return at.top_importance(at.long_values(valued, run.split.key, F.col("values"), run.prepared.names), k)


def net_summary(
    run: Trained, seed: int = 42, background: int = NET_BACKGROUND, explained: int = NET_EXPLAINED, k: int = TOP
) -> DataFrame:
    """Mean absolute expected gradient of the neural model's features, largest first."""
    inner, outer = _samples(run, background, explained, seed)
    values = at.expected_gradients(run.classifier, _matrix(inner), seed, F.col("x"))
    valued = outer.select(run.split.key, values.alias("values"))
    return at.top_importance(at.long_values(valued, run.split.key, F.col("values"), run.prepared.names), k)


def net_importance(
    prepared: Prepared, net: Net, df: DataFrame, key: str, label: str, settings: ExplainSettings = ExplainSettings()
) -> DataFrame:
    """Permutation importance of the transformed features on a sample."""
    sample = fixed_sample(df, settings.max_samples, key, settings.seed)
    rows = settle(transformed(sample, prepared, key, label))
    return at.permutation_importance(
        rows, key, label, prepared.names, net.probability, net.threshold, settings.repeats, settings.seed
    )


def group_table(spark: SparkSession, prepared: Prepared) -> DataFrame:
    groups = feature_groups(prepared)
    order = list(dict.fromkeys(groups))
    rows = [(n, g, order.index(g)) for n, g in zip(prepared.names, groups)]
    return spark.createDataFrame(rows, at.GROUP_SCHEMA)


def net_local(
    prepared: Prepared, net: Net, rows: DataFrame, reference: DataFrame, key: str, settings: ExplainSettings = ExplainSettings()
) -> tuple[DataFrame, DataFrame]:
    """Integrated gradients per row: long raw values, and values per raw column with ranks."""
    if settings.baseline != "median":
        raise ValueError("the baseline is 'median'")
    if rows.isEmpty():
        raise ValueError("there is no row to explain")
    sample = fixed_sample(reference, settings.max_samples, key, settings.seed)
    baseline = at.median_baseline(settle(transformed(sample, prepared)), prepared.names)
    values = at.integrated_gradients(net, baseline, settings.steps, F.col("x"))
    valued = settle(transformed(rows, prepared, key).select(key, values.alias("values")))
    raw = at.long_values(valued, key, F.col("values"), prepared.names)
    return raw, at.grouped_values(raw, group_table(rows.sparkSession, prepared), key)


def explain_net(
    prepared: Prepared,
    net: Net,
    evaluated: DataFrame,
    explained: DataFrame,
    key: str,
    label: str,
    folder: str,
    settings: ExplainSettings = ExplainSettings(),
) -> dict[str, str]:
    """Global and local reports of the neural model as files; returns their paths."""
    spark = evaluated.sparkSession
    overall = net_importance(prepared, net, evaluated, key, label, settings)
    raw, grouped = net_local(prepared, net, explained, evaluated, key, settings)
    grouped = settle(grouped)
    checks = at.conservation(raw, grouped, key).first()
    paths = {k: f"{folder}/{k}" for k in ("global", "local_raw", "local_grouped", "local_top", "metadata")}
    write_csv(overall, paths["global"])
    write_csv(at.wide_values(raw, key, prepared.names), paths["local_raw"])
    write_csv(grouped, paths["local_grouped"])
    write_csv(grouped.where(F.col("rank") <= settings.top_k), paths["local_top"])
    document = {
        "method_global": "permutation_importance",
        "method_local": "integrated_gradients",
        "config": asdict(settings),
        "n_eval_rows": evaluated.count(),
        "n_local_rows": explained.count(),
        "checks": {
            "raw_attribution_width": len(prepared.names),
            "transformed_input_dim": net.width,
            "max_abs_grouped_sum_diff": checks["max_abs_diff"],
        },
    }
    write_document(spark, document, paths["metadata"])
    return paths

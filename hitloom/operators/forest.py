"""Exact interventional Shapley values of a random forest.

A leaf counts for a mix of an explained and a background row if every test on its path holds
for the row the feature is taken from. With a features that only the explained row satisfies
and b that only the background row satisfies, the leaf's value is shared with the closed-form
weights (a-1)! b! / (a+b)! and -a! (b-1)! / (a+b)!. Explained rows are spread over tasks; the
trees and the background sample have sizes set by parameters.
"""

from __future__ import annotations

import uuid
from math import factorial

import numpy as np
import pandas as pd
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from hitloom.session import shared_folder

Leaf = tuple[np.ndarray, np.ndarray, np.ndarray, float]


def leaves(spark: SparkSession, model: RandomForestClassificationModel) -> list[list[Leaf]]:
    """Per tree its leaves as (features, lower, upper, probability of a hit)."""
    path = f"{shared_folder(spark)}/forest-{uuid.uuid4().hex}"
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    trees: dict[int, dict[int, object]] = {}
    for node in nodes.collect():  # at most trees * 2^(depth + 1) nodes
        trees.setdefault(node.treeID, {})[node.id] = node
    return [_paths(trees[t]) for t in sorted(trees)]


def _paths(nodes: dict) -> list[Leaf]:
    found, open_ = [], [(0, {})]
    while open_:
        at, box = open_.pop()
        node = nodes[at]
        if node.leftChild < 0:
            stats = node.impurityStats
            share = stats[1] / sum(stats) if len(stats) > 1 and sum(stats) else 0.0
            names = sorted(box)
            low = np.array([box[f][0] for f in names])
            high = np.array([box[f][1] for f in names])
            found.append((np.array(names, dtype=int), low, high, float(share)))
            continue
        f, values = node.split.featureIndex, list(node.split.leftCategoriesOrThreshold)
        below, above = node.leftChild, node.rightChild
        cut = values[0]
        if node.split.numCategories > 0:  # a one-hot column: the left side lists 0 or 1
            cut = 0.5
            below, above = (below, above) if values == [0.0] else (above, below)
        low, high = box.get(f, (-np.inf, np.inf))
        open_.append((below, {**box, f: (low, min(high, cut))}))
        open_.append((above, {**box, f: (max(low, cut), high)}))
    return found


def _weights(depth: int) -> tuple[np.ndarray, np.ndarray]:
    gain, loss = np.zeros((depth + 1, depth + 1)), np.zeros((depth + 1, depth + 1))
    for a in range(depth + 1):
        for b in range(depth + 1 - a):
            if a:
                gain[a, b] = factorial(a - 1) * factorial(b) / factorial(a + b)
            if b:
                loss[a, b] = factorial(a) * factorial(b - 1) / factorial(a + b)
    return gain, loss


def shapley(forest: list[list[Leaf]], rows: np.ndarray, background: np.ndarray) -> np.ndarray:
    """Attributions (row x feature), averaged over trees and background rows."""
    out = np.zeros_like(rows)
    widest = max((len(leaf[0]) for tree in forest for leaf in tree), default=0)
    gain, loss = _weights(widest)
    for tree in forest:
        for features, low, high, value in tree:
            if not value or not len(features):
                continue
            own = ((rows[:, features] > low) & (rows[:, features] <= high)).astype(float)
            other = ((background[:, features] > low) & (background[:, features] <= high)).astype(float)
            reached = (1 - own) @ (1 - other).T == 0
            a = (own @ (1 - other).T).astype(int)
            b = ((1 - own) @ other.T).astype(int)
            plus = np.where(reached, gain[a, b], 0.0) @ (1 - other)
            minus = np.where(reached, loss[a, b], 0.0) @ other
            out[:, features] += value * (own * plus - (1 - own) * minus)
    return out / (len(forest) * len(background))


def forest_values(forest: list[list[Leaf]], background: np.ndarray, x: Column) -> Column:
    """Attributions of an array column of transformed features."""

    @F.pandas_udf("array<double>")
    def call(batch: pd.Series) -> pd.Series:
        values = shapley(forest, np.stack(batch.to_numpy()), background) if len(batch) else []
        return pd.Series(list(values), dtype="object")

    return call(x)

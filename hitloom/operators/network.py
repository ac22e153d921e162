"""A small neural classifier trained data-parallel.

Layers d -> 32 -> 16 -> 1 with ReLU, dropout after the first, binary cross-entropy on the logit
and Adam. In every epoch each shard of the rows runs its own mini-batches from the shared state; the
states are then averaged on Spark, weighted by rows. Shards and their random streams depend on the
rows only, so the weights do not depend on partitions. Only the state (a few thousand numbers) passes
through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.session import settle

# Layer widths, dropout and optimiser constants.
HIDDEN = (32, 16)
DROPOUT = 0.5
BETA1, BETA2, EPSILON = 0.9, 0.999, 1e-8
SHARD, LEAST_SHARDS = 16384, 8


def shapes(width: int) -> list[tuple[int, ...]]:
    sizes = (width, *HIDDEN, 1)
    return [s for a, b in zip(sizes, sizes[1:]) for s in ((a, b), (b,))]


def unpack(flat: np.ndarray, width: int) -> list[np.ndarray]:
    out, at = [], 0
    for shape in shapes(width):
        n = int(np.prod(shape))
        out.append(flat[at : at + n].reshape(shape))
        at += n
    return out


def initial(width: int, seed: int) -> np.ndarray:
    """Uniform start in +-1/sqrt(inputs) for weights and biases of each layer."""
    rng = np.random.default_rng(seed)
    parts, inputs = [], width
    for shape in shapes(width):
        inputs = shape[0] if len(shape) == 2 else inputs
        parts.append(rng.uniform(-1, 1, int(np.prod(shape))) / np.sqrt(inputs))
    return np.concatenate(parts)


def logits(flat: np.ndarray, x: np.ndarray) -> np.ndarray:
    w1, b1, w2, b2, w3, b3 = unpack(flat, x.shape[1])
    h = np.maximum(x @ w1 + b1, 0.0)
    h = np.maximum(h @ w2 + b2, 0.0)
    return (h @ w3 + b3)[:, 0]


def probabilities(flat: np.ndarray, x: np.ndarray) -> np.ndarray:
    z = np.clip(logits(flat, x), -700, 700)
    return np.clip(1.0 / (1.0 + np.exp(-z)), 0.0, 1.0)


def input_gradient(flat: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Gradient of the logit with respect to the inputs."""
    w1, b1, w2, b2, w3, _ = unpack(flat, x.shape[1])
    a1 = x @ w1 + b1
    a2 = np.maximum(a1, 0.0) @ w2 + b2
    g2 = (a2 > 0) * w3[:, 0]
    g1 = (g2 @ w2.T) * (a1 > 0)
    return g1 @ w1.T


def loss_gradient(flat: np.ndarray, x: np.ndarray, y: np.ndarray, keep: np.ndarray) -> np.ndarray:
    """Gradient of the mean loss of one mini-batch; ``keep`` is the scaled dropout mask."""
    w1, b1, w2, b2, w3, b3 = unpack(flat, x.shape[1])
    a1 = x @ w1 + b1
    h1 = np.maximum(a1, 0.0) * keep
    a2 = h1 @ w2 + b2
    h2 = np.maximum(a2, 0.0)
    z = np.clip((h2 @ w3 + b3)[:, 0], -700, 700)
    dz = ((1.0 / (1.0 + np.exp(-z)) - y) / len(y))[:, None]
    da2 = (dz @ w3.T) * (a2 > 0)
    da1 = (da2 @ w2.T) * keep * (a1 > 0)
    parts = (x.T @ da1, da1.sum(0), h1.T @ da2, da2.sum(0), h2.T @ dz, dz.sum(0))
    return np.concatenate([p.ravel() for p in parts])


@dataclass(frozen=True)
class Net:
    weights: np.ndarray
    width: int
    threshold: float = 0.5

    def probability(self, features: Column) -> Column:
        """P(hit) of an array column."""
        flat = self.weights

        @F.pandas_udf("double")
        def score(x: pd.Series) -> pd.Series:
            return pd.Series(probabilities(flat, np.stack(x.to_numpy())) if len(x) else [], dtype="float64")

        return score(features)


def sharded(rows: DataFrame, key: str, features: str, label: str) -> DataFrame:
    """Rows dealt by a hash of their key into shards of about ``SHARD`` rows, each one row of the result, ordered within.

    Shards depend on the rows only, not on how they are partitioned or on how many executors there are.
    """
    shards = max(LEAST_SHARDS, -(-rows.count() // SHARD))
    place = F.xxhash64(F.col(key).cast("string"))
    row = F.struct(place.alias("h"), F.col(key).cast("string").alias("k"), F.col(label).cast("double").alias("y"), F.col(features).alias("x"))
    dealt = rows.groupBy(F.pmod(place, F.lit(shards)).cast("int").alias("shard")).agg(F.sort_array(F.collect_list(row)).alias("rows"))
    return settle(dealt.select("shard", F.transform("rows", lambda r: r["y"]).alias("y"), F.flatten(F.transform("rows", lambda r: r["x"])).alias("x")))


def _epoch(shards: DataFrame, state: np.ndarray, step: float, settings, epoch: int) -> tuple[np.ndarray, float]:
    n = len(state) // 3
    size, lr, seed = settings.batch_size, settings.lr, settings.seed

    def learned(shard: int, x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
        flat, m, v, t = state[:n].copy(), state[n : 2 * n].copy(), state[2 * n :].copy(), step
        rng = np.random.default_rng((seed, epoch, shard))
        order = rng.permutation(len(y))
        for at in range(0, len(y), size):
            take = order[at : at + size]
            keep = (rng.random((len(take), HIDDEN[0])) >= DROPOUT) / (1.0 - DROPOUT)
            g = loss_gradient(flat, x[take], y[take], keep)
            t += 1
            m = BETA1 * m + (1 - BETA1) * g
            v = BETA2 * v + (1 - BETA2) * g * g
            flat = flat - lr * (m / (1 - BETA1**t)) / (np.sqrt(v / (1 - BETA2**t)) + EPSILON)
        return t, np.concatenate([flat, m, v])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                y = batch.column(1).slice(r, 1).flatten().to_numpy()
                x = batch.column(2).slice(r, 1).flatten().to_numpy().reshape(len(y), -1)
                shard = batch.column(0)[r].as_py()
                t, after = learned(shard, x, y)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard], pa.int32()), pa.array([len(y)], pa.int64()), pa.array([[t, *after]], pa.list_(pa.float64()))],
                    names=["shard", "n", "state"],
                )

    parts = shards.mapInArrow(learn, "shard int, n bigint, state array<double>")
    cells = parts.select("shard", "n", F.posexplode("state").alias("i", "value"))
    # Sums go by shard, so that not even rounding depends on the order in which tasks end.
    listed = cells.groupBy("i").agg(F.sort_array(F.collect_list(F.struct("shard", "n", "value"))).alias("s"))
    total = F.aggregate("s", F.lit(0.0), lambda a, c: a + c["n"] * c["value"])
    mean = total / F.aggregate("s", F.lit(0).cast("bigint"), lambda a, c: a + c["n"])
    out = np.empty(len(state) + 1)
    for r in listed.select("i", mean.alias("value")).collect():  # one row per number of the state
        out[r.i] = r.value
    return out[1:], float(out[0])


def train_network(rows: DataFrame, key: str, features: str, label: str, settings) -> Net:
    """Train on rows with a unique key, an array column of features and a 0/1 label."""
    shards = sharded(rows, key, features, label)
    width = shards.select((F.size("x") / F.size("y")).cast("int").alias("n")).first().n
    flat = initial(width, settings.seed)
    state, step = np.concatenate([flat, np.zeros(2 * len(flat))]), 0.0
    for epoch in range(settings.epochs):
        state, step = _epoch(shards, state, step, settings, epoch)
    return Net(state[: len(flat)], width)

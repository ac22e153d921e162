"""L2 logistic regressions fitted together: every pass over the rows serves all models.

Rows are (x, y, part, pick): a model uses the rows of its ``part`` whose ``pick`` is its own or null,
so folds, their own scaling and their own synthetic rows lie in one table. The driver holds one
coefficient vector per model and, per part, one matrix of width x width.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEMORY = 10  # steps whose changes of gradient a model keeps
ROWS_AT_ONCE = 4096


@dataclass(frozen=True)
class Candidate:
    part: int
    pick: int | None
    c: float


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Part, features with a leading 1, labels and picks (-1 for null), in pieces of one part."""
    for batch in batches:
        part = batch.column(2).to_numpy()
        for p in np.unique(part):
            rows = np.flatnonzero(part == p)
            for start in range(0, len(rows), ROWS_AT_ONCE):
                some = batch.take(pa.array(rows[start : start + ROWS_AT_ONCE]))
                x = some.column(0).flatten().to_numpy(zero_copy_only=False).reshape(some.num_rows, -1)
                pick = some.column(3).fill_null(-1).to_numpy()
                yield int(p), np.concatenate([np.ones((len(x), 1)), x], axis=1), some.column(1).to_numpy(), pick


def _sums(rows: DataFrame, size: dict[int, int], tell) -> dict[int, np.ndarray]:
    """Add up, over all rows, arrays that ``tell(part, x, y, pick)`` gives per key; each task sends its own sums."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for piece in _parts(batches):
            for key, value in tell(*piece):
                total[key] = total[key] + value if key in total else value
        for key, value in total.items():
            at = np.flatnonzero(value)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), key)), pa.array(at), pa.array(value[at])], names=["key", "at", "value"])

    found = rows.select("x", "y", "part", "pick").mapInArrow(add, "key bigint, at bigint, value double")
    out = {k: np.zeros(n) for k, n in size.items()}
    for r in found.groupBy("key", "at").agg(F.sum("value").alias("value")).collect():  # one row per coefficient
        out[r.key][r.at] = r.value
    return out


def _of(candidates: list[Candidate]) -> dict[int, list[int]]:
    own: dict[int, list[int]] = {}
    for i, m in enumerate(candidates):
        own.setdefault(m.part, []).append(i)
    return own


@dataclass
class _Fit:
    """One model's way down: L-BFGS from a bound on the curvature, halving steps that do not help."""

    inverse: np.ndarray
    x: np.ndarray
    f: float = np.inf
    g: np.ndarray | None = None
    step: np.ndarray | None = None
    changes: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    done: bool = False

    @property
    def trial(self) -> np.ndarray:
        return self.x if self.step is None else self.x + self.step

    def told(self, f: float, g: np.ndarray, tol: float) -> None:
        if self.step is not None:
            rounding = 1e-12 * (1 + abs(self.f))
            if f > self.f + 1e-4 * self.g @ self.step + rounding and np.abs(self.step).max() > 1e-14:
                self.step = self.step / 2
                return
            if (self.step @ (g - self.g)) > 0:
                self.changes = [*self.changes, (self.step, g - self.g)][-MEMORY:]
            self.x = self.x + self.step
        self.f, self.g = f, g
        self.done = bool(np.abs(g).max() <= tol)
        self.step = self._direction()

    def _direction(self) -> np.ndarray:
        q, used = -self.g, []
        for s, y in reversed(self.changes):
            a = (s @ q) / (s @ y)
            q = q - a * y
            used.append(a)
        q = self.inverse @ q
        for (s, y), a in zip(self.changes, reversed(used), strict=True):
            q = q + s * (a - (y @ q) / (s @ y))
        return q


def fit_many(rows: DataFrame, candidates: list[Candidate], tol: float = 1e-9, max_iter: int = 200) -> list[np.ndarray]:
    """Coefficients (the intercept first) of every candidate; the penalty is |w|^2 / (2 C n) against the mean loss.

    Each pass evaluates all models that are not done at their own trial points. A model whose part has no rows stays at 0.
    """
    of = _of(candidates)
    picks = {i: -1 if m.pick is None else m.pick for i, m in enumerate(candidates)}
    widths = {r.part: r.width + 1 for r in rows.groupBy("part").agg(F.max(F.size("x")).alias("width")).collect()}
    shapes = sorted({(m.part, picks[i]) for i, m in enumerate(candidates) if m.part in widths})
    at = {s: k for k, s in enumerate(shapes)}

    def curvature(part, x, y, pick):
        for p, own in shapes:
            if p == part:
                some = x[(pick == -1) | (pick == own)]
                yield at[p, own], (some.T @ some).ravel()

    grams = _sums(rows, {k: widths[p] ** 2 for (p, _), k in at.items()}, curvature)
    fits: dict[int, _Fit] = {}
    n, penalty = {}, {}
    for i, m in enumerate(candidates):
        if m.part in widths:
            d = widths[m.part]
            gram = grams[at[m.part, picks[i]]].reshape(d, d)
            n[i] = max(gram[0, 0], 1.0)
            penalty[i] = np.append(0.0, np.full(d - 1, 1.0 / (m.c * n[i])))
            bound = gram / (4 * n[i]) + np.diag(penalty[i])
            fits[i] = _Fit(np.linalg.pinv(bound + 1e-12 * np.trace(bound) * np.eye(d) / d), np.zeros(d))

    for _ in range(max_iter):
        active = [i for i in fits if not fits[i].done]
        if not active:
            break
        trial = {i: fits[i].trial for i in active}

        def loss(part, x, y, pick):
            for i in of.get(part, ()):
                if i in trial:
                    use = (pick == -1) | (pick == picks[i])
                    some, z = x[use], x[use] @ trial[i]
                    value = np.logaddexp(0, z).sum() - y[use] @ z
                    yield i, np.append(value, some.T @ (1 / (1 + np.exp(-np.clip(z, -700, 700))) - y[use]))

        found = _sums(rows, {i: widths[candidates[i].part] + 1 for i in active}, loss)
        for i in active:
            w, p = trial[i], penalty[i]
            fits[i].told(found[i][0] / n[i] + 0.5 * (p * w) @ w, found[i][1:] / n[i] + p * w, tol)
    return [fits[i].x if i in fits else np.zeros(1) for i in range(len(candidates))]


def confusions(rows: DataFrame, candidates: list[Candidate], coefficients: list[np.ndarray]) -> list[tuple[int, int, int, int]]:
    """(tn, fp, fn, tp) of every model over the rows of its part, whatever their pick, in one pass."""
    of = _of(candidates)

    def count(part, x, y, pick):
        for i in of.get(part, ()):
            yield i, np.bincount((2 * y + (x @ coefficients[i] > 0)).astype(int), minlength=4).astype(float)

    found = _sums(rows, {i: 4 for i in range(len(candidates))}, count)
    return [tuple(int(v) for v in found[i]) for i in range(len(candidates))]

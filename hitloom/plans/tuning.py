"""Random search with stratified cross-validation."""

from __future__ import annotations

import random
from dataclasses import asdict, dataclass, replace
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.contracts import CHART_CONTRACT, FeatureContract, ForestSettings, LinearSettings, NetSettings
from hitloom.operators.logistic import Candidate, confusions, fit_many
from hitloom.operators.metrics import roc_auc
from hitloom.operators.oversampling import oversampling_plan, synthetic_sets
from hitloom.operators.preparation import fit_preparation
from hitloom.operators.ranking import with_folds
from hitloom.plans import training as tr
from hitloom.session import settle

# The search spaces.
NEIGHBOURS = (3, 5, 7)
FOREST_SPACE = {"trees": (200, 400, 800), "depth": (None, 6, 10, 14), "min_leaf": (1, 3, 5, 10)}
NET_SPACE = {"batch_size": (16, 32, 64), "epochs": (40, 80, 120), "lr": (1e-4, 5e-4, 1e-3, 5e-3)}
C_GRID = {"first": -3.0, "last": 2.0, "count": 20}


def log_grid(first: float, last: float, count: int) -> list[float]:
    """Numbers evenly spaced in their logarithm, from 10^first to 10^last."""
    return [10.0 ** (first + (last - first) * i / (count - 1)) for i in range(count)]


def linear_space() -> dict[str, tuple]:
    return {"c": tuple(log_grid(**C_GRID))}


@dataclass(frozen=True)
class Search:
    draws: int = 20
    folds: int = 5
    scoring: str = "f1"
    at_once: int = 4  # forests that are fitted, or folds prepared, at a time


def draw(space: dict[str, tuple], n: int, seed: int) -> list[dict]:
    """Up to n different combinations in random order."""
    grid = list(product(*space.values()))
    chosen = random.Random(seed).sample(range(len(grid)), min(max(1, n), len(grid)))
    return [dict(zip(space, grid[i])) for i in chosen]


@dataclass(frozen=True)
class _Task:
    """What a search works on."""

    split: tr.Split
    folded: DataFrame  # training rows with their fold
    folds: int
    candidates: list[dict]


def _task(df, key, contract, settings, search: Search, space: dict) -> _Task:
    if search.scoring not in ("f1", "roc_auc"):
        raise ValueError(f"scoring is 'f1' or 'roc_auc', not {search.scoring!r}")
    split = tr.split_rows(df, contract, settings, key)
    use, k = oversampling_plan(tr.class_sizes(split.train, split.label), settings.oversample)
    if use:
        space = {**space, "neighbours": tuple(sorted({max(1, min(n, k)) for n in NEIGHBOURS}))}
    folds = max(2, search.folds)
    folded = with_folds(split.train, split.label, split.key, settings.seed + 2, folds, settled=True)
    return _Task(split, folded, folds, draw(space, search.draws, settings.seed))


def _refit(task: _Task, scores: list[float], settings, search: Search, fit, scale: bool, name: str) -> tr.Trained:
    """The best candidate (the first of equal ones) fitted on all training rows."""
    split, candidates = task.split, task.candidates
    best = max(range(len(candidates)), key=lambda i: (scores[i], -i))
    chosen = replace(settings, **candidates[best])
    prepared = fit_preparation(split.train, list(split.numeric), list(split.categorical), scale)
    rows, extra = tr.fitting_rows(split.train, split, prepared, chosen)
    model = fit(rows, chosen)
    metrics = {
        "model": name,
        **extra,
        **tr.evaluate(tr.score(split.test, prepared, model), split.label),
        "tuned": True,
        "tune_scoring": search.scoring,
        "tune_cv": task.folds,
        "tune_n_iter": len(candidates),
        "best_cv_score": scores[best],
        "best_params": candidates[best],
        "search": [{**c, "score": s} for c, s in zip(candidates, scores)],
    }
    return tr.Trained(prepared, model, split, metrics, {**asdict(chosen), "search": asdict(search)})


def fold_rows(task: _Task, settings, at_once: int) -> DataFrame:
    """Prepared rows of all folds in one table: (x, y, part, pick, held).

    Each fold has its own preparation, its rows outside are ``held``; synthetic rows carry the number
    of neighbours they were made with as ``pick``. Some folds are prepared at a time.
    """
    split = task.split
    neighbours = sorted({c["neighbours"] for c in task.candidates if "neighbours" in c})

    def shaped(df: DataFrame, fold: int, pick: int | None, held: bool) -> DataFrame:
        return df.select(
            vector_to_array("features").alias("x"), F.col(split.label).cast("double").alias("y"), F.lit(fold).alias("part"),
            F.lit(pick).cast("int").alias("pick"), F.lit(held).alias("held"),
        )

    def of_fold(fold: int) -> DataFrame:
        inside, outside = task.folded.where(F.col("fold") != fold), task.folded.where(F.col("fold") == fold)
        prepared = fit_preparation(inside, list(split.numeric), list(split.categorical), True)
        ready = settle(prepared.transform(inside).select(split.key, split.label, "features"))
        tables = [shaped(ready, fold, None, False), shaped(prepared.transform(outside), fold, None, True)]
        plans = {n: oversampling_plan(tr.class_sizes(ready, split.label), settings.oversample, n) for n in neighbours}
        wanted = {n: k for n, (use, k) in plans.items() if use}
        made = synthetic_sets(ready, split.label, split.key, sorted(set(wanted.values())), settings.seed) if wanted else {}
        return settle(reduce(DataFrame.unionByName, tables + [shaped(made[k], fold, n, False) for n, k in wanted.items()]))

    with ThreadPool(max(1, at_once)) as pool:
        return reduce(DataFrame.unionByName, pool.map(inheritable_thread_target(task.folded.sparkSession)(of_fold), range(task.folds)))


def _linear_scores(task: _Task, settings, search: Search) -> list[float]:
    """Mean score of each candidate over the folds; all candidates and folds are fitted together."""
    rows = fold_rows(task, settings, search.at_once)
    models = [
        Candidate(fold, choice.get("neighbours"), choice.get("c", settings.c)) for choice in task.candidates for fold in range(task.folds)
    ]
    coefficients = fit_many(rows.where(~F.col("held")), models, max_iter=settings.max_iter)
    held = rows.where("held")
    if search.scoring == "f1":
        each = [2 * tp / (2 * tp + fp + fn) if tp else 0.0 for _, fp, fn, tp in confusions(held, models, coefficients)]
    else:
        each = []
        for m, w in zip(models, coefficients, strict=True):
            terms = F.zip_with("x", F.array(*[F.lit(float(v)) for v in w[1:]]), lambda a, b: a * b)
            z = F.aggregate(terms, F.lit(float(w[0])), lambda a, b: a + b)
            area = roc_auc(held.where(F.col("part") == m.part).withColumn("p", 1 / (1 + F.exp(-z))), "p", "y").first()
            each.append((area["roc_auc"] if area else None) or 0.0)
    return [sum(each[i : i + task.folds]) / task.folds for i in range(0, len(each), task.folds)]


def _forest_scores(task: _Task, settings, search: Search) -> list[float]:
    """Mean score of each candidate over the folds; some fits run at a time over the same written rows."""
    split, scores = task.split, [0.0] * len(task.candidates)
    spark = task.folded.sparkSession
    with ThreadPool(max(1, search.at_once)) as pool:
        for fold in range(task.folds):
            inside, outside = task.folded.where(F.col("fold") != fold), settle(task.folded.where(F.col("fold") == fold))
            prepared = fit_preparation(inside, list(split.numeric), list(split.categorical), False)
            trials = [replace(settings, **choice) for choice in task.candidates]
            # Candidates with equal oversampling share their rows.
            made = {n: tr.fitting_rows(inside, split, prepared, next(t for t in trials if t.neighbours == n))[0] for n in {t.neighbours for t in trials}}

            def run(trial, made=made, prepared=prepared, outside=outside) -> float:
                model = tr.fit_forest(made[trial.neighbours], trial)
                return tr.evaluate(tr.score(outside, prepared, model), split.label)[search.scoring] or 0.0

            for i, found in enumerate(pool.map(inheritable_thread_target(spark)(run), trials)):
                scores[i] += found / task.folds
    return scores


def tune_linear(
    df: DataFrame,
    key: str,
    contract: FeatureContract = CHART_CONTRACT,
    settings: LinearSettings = LinearSettings(),
    search: Search = Search(),
) -> tr.Trained:
    """Search over C and neighbours; Spark has one solver, so there is none to choose."""
    task = _task(df, key, contract, settings, search, linear_space())
    return _refit(task, _linear_scores(task, settings, search), settings, search, tr.fit_linear, True, "logistic_regression")


def tune_forest(
    df: DataFrame,
    key: str,
    contract: FeatureContract = CHART_CONTRACT,
    settings: ForestSettings = ForestSettings(),
    search: Search = Search(),
    space: dict | None = None,
) -> tr.Trained:
    task = _task(df, key, contract, settings, search, space or FOREST_SPACE)
    return _refit(task, _forest_scores(task, settings, search), settings, search, tr.fit_forest, False, "random_forest")


def tune_net(
    df: DataFrame,
    key: str,
    contract: FeatureContract = CHART_CONTRACT,
    settings: NetSettings = NetSettings(),
    draws: int = 20,
    space: dict | None = None,
) -> tr.Trained:
    """Independent draws (with replacement); the first with the highest F1 on the validation rows wins.

    Rows are split and prepared once; the test rows are looked at by the winner only.
    """
    rng, space = random.Random(settings.seed), space or NET_SPACE
    rows = tr.net_rows(df, key, contract, settings)
    choices = [{name: rng.choice(values) for name, values in space.items()} for _ in range(max(1, draws))]
    fits = [tr.fit_net(rows, replace(settings, **choice)) for choice in choices]
    best = max(range(len(fits)), key=lambda i: (fits[i][1], -i))
    run = tr.net_run(rows, fits[best][0], replace(settings, **choices[best]))
    extra = {
        "tuned": True, "tune_scoring": "f1", "tune_n_iter": len(choices), "best_params": choices[best],
        "search": [{**c, "score": f1} for c, (_, f1) in zip(choices, fits)],
    }
    return replace(run, metrics={**run.metrics, **extra, "best_score": fits[best][1]})

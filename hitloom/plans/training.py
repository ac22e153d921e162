"""Train, score and evaluate the three models."""

from __future__ import annotations

from dataclasses import asdict, dataclass, replace
from typing import Any

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.contracts import (
    ARTIST_CONTRACT,
    CHART_CONTRACT,
    FeatureContract,
    ForestSettings,
    LinearSettings,
    NetSettings,
)
from hitloom.operators.metrics import best_threshold, binary_metrics, class_report, confusion_counts, roc_auc
from hitloom.operators.network import Net, train_network
from hitloom.operators.oversampling import oversample, oversampling_plan
from hitloom.operators.preparation import Prepared, audio_summary, class_weights, fit_preparation, training_frame
from hitloom.operators.ranking import with_test_flag
from hitloom.session import settle
from hitloom.sources.sinks import read_document, write_document

# The deepest tree Spark grows, used where no limit is asked for.
MAX_DEPTH = 30


@dataclass(frozen=True)
class Split:
    train: DataFrame
    test: DataFrame
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    label: str
    key: str
    audio: tuple[str, ...] = ()  # audio columns of the table
    dropped: DataFrame | None = None  # one row: how many rows their holes cost


@dataclass(frozen=True)
class Trained:
    """A fitted run: preparation, classifier, what it was tested on and how it did."""

    prepared: Prepared
    classifier: Any
    split: Split
    metrics: dict
    settings: dict

    @property
    def model(self) -> PipelineModel:
        return PipelineModel(stages=[*self.prepared.model.stages, self.classifier])

    def score(self, df: DataFrame) -> DataFrame:
        return score(df, self.prepared, self.classifier)


def split_rows(
    df: DataFrame, contract: FeatureContract, settings, key: str
) -> Split:
    """Prepared rows with an exact stratified test share, written once for all later passes."""
    frame, numeric, categorical = training_frame(df, contract, settings.frame)
    rows = frame.select(key, contract.label, *numeric, *categorical)
    flagged = with_test_flag(rows, contract.label, key, settings.seed, settings.test_size, settled=True)
    train, test = flagged.where(~F.col("is_test")), flagged.where("is_test")
    audio, dropped = audio_summary(df, contract, settings.frame)
    return Split(train, test, tuple(numeric), tuple(categorical), contract.label, key, tuple(audio), dropped)


def score(df: DataFrame, prepared: Prepared, classifier) -> DataFrame:
    """Add ``probability`` of a hit and the 0/1 ``prediction``."""
    ready = prepared.transform(df)
    if isinstance(classifier, Net):
        p = classifier.probability(vector_to_array("features"))
        scored = ready.withColumn("probability", p)
        decided = (F.col("probability") >= F.lit(classifier.threshold)).cast("int")
        return scored.withColumn("prediction", decided).drop("features")
    out = classifier.transform(ready)
    return out.withColumns(
        {
            "probability": vector_to_array("probability")[1],
            "prediction": F.col("prediction").cast("int"),
        }
    ).drop("features", "rawPrediction")


def evaluate(scored: DataFrame, label: str) -> dict:
    """Metrics of a scored table; every one is a distributed aggregate."""
    rows = settle(scored.select(F.col(label).alias("y"), "prediction", "probability"))
    found = confusion_counts(rows, "y", "prediction").first()
    counts = rows.sparkSession.createDataFrame([found], "tn bigint, fp bigint, fn bigint, tp bigint")
    m = binary_metrics(counts).first()
    area = roc_auc(rows, "probability", "y").first()
    report = [r.asDict() for r in class_report(counts).collect()]
    return {
        **{k: m[k] for k in ("accuracy", "f1", "precision", "recall")},
        "roc_auc": area["roc_auc"] if area else None,
        "confusion_matrix": [[m["tn"], m["fp"]], [m["fn"], m["tp"]]],
        "classification_report": report,
    }


def class_sizes(df: DataFrame, label: str) -> dict[int, int]:
    return {r[0]: r[1] for r in df.groupBy(label).agg(F.count(F.lit(1))).collect()}


def fitting_rows(train: DataFrame, split: Split, prepared: Prepared, settings) -> tuple[DataFrame, dict]:
    """Transformed training rows, oversampled if asked for and possible."""
    use, k = oversampling_plan(class_sizes(train, split.label), settings.oversample, settings.neighbours)
    ready = prepared.transform(train).select(split.key, split.label, "features")
    if use:
        ready = oversample(settle(ready), split.label, split.key, k, settings.seed)
    rows = settle(ready.select("features", F.col(split.label).cast("double").alias("label")))
    return rows, {"use_smote": use, "smote_k_neighbors": k if use else None}


def fit_linear(rows: DataFrame, settings: LinearSettings):
    """L2 logistic regression; the penalty weighs 1 / (C n) against the mean loss."""
    return LogisticRegression(
        regParam=1.0 / (settings.c * rows.count()),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=settings.max_iter,
        tol=1e-8,
    ).fit(rows)


def fit_forest(rows: DataFrame, settings: ForestSettings):
    """Random forest with balanced class weights."""
    weighted = rows.join(F.broadcast(class_weights(rows, "label").drop("n")), "label")
    return RandomForestClassifier(
        numTrees=settings.trees,
        maxDepth=MAX_DEPTH if settings.depth is None else settings.depth,
        minInstancesPerNode=settings.min_leaf,
        featureSubsetStrategy="sqrt",
        weightCol="weight",
        seed=settings.seed,
    ).fit(weighted)


def _metrics(name: str, split: Split, settings, scored: DataFrame, extra: dict) -> dict:
    return {
        "model": name,
        "n_rows": split.train.count() + split.test.count(),
        "recent_years_window": settings.frame.years_back,
        "audio_feature_columns": list(split.audio),
        "max_audio_missing_frac": settings.frame.max_audio_missing if split.audio else None,
        "n_rows_dropped_audio_missing": split.dropped.first()[0] if split.dropped is not None else 0,
        "n_features_numeric": len(split.numeric),
        "n_features_categorical": len(split.categorical),
        "test_size": settings.test_size,
        **extra,
        **evaluate(scored, split.label),
        "feature_columns": {"numeric": list(split.numeric), "categorical": list(split.categorical)},
    }


def train_linear(
    df: DataFrame, key: str, contract: FeatureContract = CHART_CONTRACT, settings: LinearSettings = LinearSettings()
) -> Trained:
    split = split_rows(df, contract, settings, key)
    prepared = fit_preparation(split.train, list(split.numeric), list(split.categorical))
    rows, extra = fitting_rows(split.train, split, prepared, settings)
    model = fit_linear(rows, settings)
    metrics = _metrics("logistic_regression", split, settings, score(split.test, prepared, model), extra)
    return Trained(prepared, model, split, metrics, asdict(settings))


def train_default(df: DataFrame, key: str, settings: LinearSettings = LinearSettings()) -> Trained:
    """The linear model on the default table of artists' features."""
    return train_linear(df, key, ARTIST_CONTRACT, settings)


def train_forest(
    df: DataFrame, key: str, contract: FeatureContract = CHART_CONTRACT, settings: ForestSettings = ForestSettings()
) -> Trained:
    split = split_rows(df, contract, settings, key)
    prepared = fit_preparation(split.train, list(split.numeric), list(split.categorical), scale=False)
    rows, extra = fitting_rows(split.train, split, prepared, settings)
    model = fit_forest(rows, settings)
    extra |= {"n_estimators": settings.trees, "max_depth": settings.depth, "min_samples_leaf": settings.min_leaf}
    metrics = _metrics("random_forest", split, settings, score(split.test, prepared, model), extra)
    return Trained(prepared, model, split, metrics, asdict(settings))


@dataclass(frozen=True)
class NetRows:
    """Rows prepared once for any number of networks: the split, and the training part with its validation flag."""

    split: Split
    prepared: Prepared
    parts: DataFrame


def net_rows(df: DataFrame, key: str, contract: FeatureContract, settings: NetSettings) -> NetRows:
    split = split_rows(df, contract, settings, key)
    prepared = fit_preparation(split.train, list(split.numeric), list(split.categorical))
    ready = prepared.transform(split.train).select(
        split.key, split.label, vector_to_array("features").alias("x")
    )
    sizes = class_sizes(ready, split.label)
    stratum = split.label
    if min(sizes.values()) < 2:  # a class of one row cannot be split by class
        ready, stratum = ready.withColumn("all", F.lit(0)), "all"
    return NetRows(split, prepared, with_test_flag(ready, stratum, split.key, settings.seed + 1, settings.validation, settled=True))


def fit_net(rows: NetRows, settings: NetSettings) -> tuple[Net, float]:
    """A network with the threshold of highest F1 on the validation part (or the test), and that F1."""
    if settings.threshold_on not in ("validation", "test"):
        raise ValueError(f"threshold_on is 'validation' or 'test', not {settings.threshold_on!r}")
    split = rows.split
    net = train_network(rows.parts.where(~F.col("is_test")), split.key, "x", split.label, settings)
    if settings.threshold_on == "validation":
        held = rows.parts.where("is_test").withColumn("probability", net.probability(F.col("x")))
    else:
        held = score(split.test, rows.prepared, net)
    best = best_threshold(held, "probability", split.label).first()
    return replace(net, threshold=float(best["threshold"])), float(best["f1"] or 0.0)


def net_run(rows: NetRows, net: Net, settings: NetSettings) -> Trained:
    """The network's test metrics."""
    split = rows.split
    extra = {
        "use_smote": False,
        "smote_k_neighbors": None,
        "input_dim": net.width,
        "batch_size": settings.batch_size,
        "epochs": settings.epochs,
        "lr": settings.lr,
        "val_fraction": settings.validation,
        "decision_threshold": net.threshold,
    }
    metrics = _metrics("mlp", split, settings, score(split.test, rows.prepared, net), extra)
    return Trained(rows.prepared, net, split, metrics, asdict(settings))


def train_net(
    df: DataFrame, key: str, contract: FeatureContract = CHART_CONTRACT, settings: NetSettings = NetSettings()
) -> Trained:
    """The neural classifier; its threshold maximises F1 on the validation part (or the test)."""
    if settings.threshold_on not in ("validation", "test"):
        raise ValueError(f"threshold_on is 'validation' or 'test', not {settings.threshold_on!r}")
    rows = net_rows(df, key, contract, settings)
    net, _ = fit_net(rows, settings)
    return net_run(rows, net, settings)


def save_net(spark: SparkSession, folder: str, trained: Trained) -> None:
    """Preparation as a pipeline, weights and threshold as one document."""
    net = trained.classifier
    trained.prepared.model.write().overwrite().save(f"{folder}/preparation")
    document = {
        "weights": net.weights.tolist(),
        "width": net.width,
        "threshold": net.threshold,
        "numeric": list(trained.prepared.numeric),
        "categorical": list(trained.prepared.categorical),
        "names": list(trained.prepared.names),
    }
    write_document(spark, document, f"{folder}/net")


def load_net(spark: SparkSession, folder: str) -> tuple[Prepared, Net]:
    d = read_document(spark, f"{folder}/net")
    model = PipelineModel.load(f"{folder}/preparation")
    prepared = Prepared(model, tuple(d["numeric"]), tuple(d["categorical"]), tuple(d["names"]))
    return prepared, Net(np.array(d["weights"]), d["width"], d["threshold"])


def report(metrics: dict, spark: SparkSession, keys: tuple[str, ...]) -> DataFrame:
    """Chosen metrics in order as (position, metric, value), the ones present."""
    rows = [(i, k, str(metrics[k])) for i, k in enumerate(keys) if k in metrics]
    return spark.createDataFrame(rows, "position int, metric string, value string")

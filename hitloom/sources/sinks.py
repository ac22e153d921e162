"""Writing tables, documents and models."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", by: tuple[str, ...] = ()) -> str:
    writer = df.write.mode(mode)
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return path


def write_document(spark: SparkSession, document: dict, path: str) -> str:
    """One JSON document, such as metrics or settings."""
    spark.createDataFrame([(json.dumps(document, default=str),)], "value string").write.mode(
        "overwrite"
    ).text(path)
    return path


def read_document(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def save_run(
    spark: SparkSession, folder: str, model: PipelineModel, metrics: dict, settings: dict
) -> dict[str, str]:
    """Model, metrics and settings of a run; returns the three paths."""
    paths = {k: f"{folder}/{k}" for k in ("model", "metrics", "settings")}
    model.write().overwrite().save(paths["model"])
    write_document(spark, metrics, paths["metrics"])
    write_document(spark, settings, paths["settings"])
    return paths


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)

"""Folders in the cluster's file system: publish in one step, list, remove."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none if it does not exist."""
    where, system = _at(spark, folder)
    return sorted(s.getPath().getName() for s in system.listStatus(where)) if system.exists(where) else []


def publish(df: DataFrame, folder: str, name: str) -> None:
    """Write ``df`` as ``folder/name``, which appears whole or not at all: it is written aside and renamed.

    What is there already stays. The file system has to rename folders in one step, as HDFS does.
    """
    spark = df.sparkSession
    aside = f"{folder}/_aside-{uuid.uuid4().hex}"
    df.write.parquet(aside)
    source, system = _at(spark, aside)
    target, _ = _at(spark, f"{folder}/{name}")
    if system.exists(target) or not system.rename(source, target):
        system.delete(source, True)
        if not system.exists(target):
            raise OSError(f"could not rename {aside} to {name}")


def remove(spark: SparkSession, path: str) -> None:
    where, system = _at(spark, path)
    system.delete(where, True)

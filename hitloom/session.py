"""Session defaults for tests and benches, and lineage cuts for long jobs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "hitloom", **conf: str) -> SparkSession:
    """A single-machine session for tests and benches; clusters bring their own."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="hitloom-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back, so that later steps neither
    recompute it nor depend on the executors that made it, and read only the columns they need.

    Every call makes a new table; the folder is the cluster's scratch space to expire.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark removes the shuffle files of each write as soon as it has ended; the written
    table replaces them. Else they stay until the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def settle_wide(df: DataFrame) -> DataFrame:
    """Like :func:`settle`, for a table that many later passes read: a table in fewer files than
    the cluster has cores (so a small one) is dealt out over them."""
    settled = settle(df)
    cores = df.sparkSession.sparkContext.defaultParallelism
    if len(settled.inputFiles()) >= cores:
        return settled
    return settle(settled.repartition(cores))

"""Reading tables, finding files, and SQL over DataFrames."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _suffix(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return "." + name.rsplit(".", 1)[-1].lower() if "." in name else ""


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A CSV or Parquet table by the suffix of its path, in any case.

    Without a schema a CSV is read as text columns: types come from coercion, which is lenient
    and needs no extra pass over the file.
    """
    kind = _suffix(path)
    if kind == ".csv":
        return read_csv(spark, path, schema)
    if kind == ".parquet":
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    raise ValueError(f"{path}: only .csv and .parquet tables are read, not {kind!r}")


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """A table stored in fewer files than the cluster has cores, dealt out over them by key.

    A table of many files, such as any large one, is left as it is read.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if len(df.inputFiles()) >= cores else df.repartition(cores, *keys)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A CSV table; other suffixes raise."""
    if _suffix(path) != ".csv":
        raise ValueError(f"{path}: a .csv file is expected")
    reader = spark.read.option("header", True).option("escape", '"')
    return (reader if schema is None else reader.schema(schema)).csv(path)


def csv_files(spark: SparkSession, folder: str, recursive: bool = True) -> DataFrame:
    """Paths of the CSV files under a folder, by listing only."""
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", recursive)
        .option("pathGlobFilter", "*.[cC][sS][vV]")
        .load(folder)
    )
    return found.select("path")


def first_csv(spark: SparkSession, folder: str, recursive: bool = True) -> str:
    path = csv_files(spark, folder, recursive).agg(F.min("path")).first()[0]
    if path is None:
        raise FileNotFoundError(f"no CSV file under {folder}")
    return path


def choose_csv(
    spark: SparkSession,
    folder: str,
    explicit: str | None = None,
    hint: str | None = None,
    any_file: bool = False,
) -> str:
    """The explicit path if it exists, else the hinted file, else (if allowed) the first CSV."""
    for path in (explicit, f"{folder}/{hint}" if hint else None):
        if path and _exists(spark, path):
            return path
    if any_file:
        return first_csv(spark, folder, recursive=False)
    raise FileNotFoundError(f"no CSV file was chosen in {folder}")


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException:
        return False
    return True


def with_source(df: DataFrame, name: str = "kaggle_source_csv", path: str | None = None) -> DataFrame:
    """Source path as a column: the given one, or the file each row was read from."""
    return df.withColumn(name, F.col("_metadata.file_path") if path is None else F.lit(path))


def sql(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """SQL over DataFrames named in braces."""
    return spark.sql(text, **frames)

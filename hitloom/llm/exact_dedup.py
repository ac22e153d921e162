"""Exact dedup by skew-safe combining: in each task, per salt, then globally."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.operators.skew import salted_join
from hitloom.session import settle


def _same(text: Column) -> Column:
    return text


def _sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def exact_dedup(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] = _same,
    digest: Callable[[Column], Column] = _sha256,
) -> DataFrame:
    """Marks which row of each group of equal normalised texts stays: the one with the largest id.

    Returns one row per id and text: doc_id, keep_id, group_size (rows), kept, digest.

    A null text counts as empty. Rows that repeat both id and text become one row, but count in
    ``group_size``; a null id never stays beside another one (its keep_id is null if all are null).
    Extra columns are ignored. An empty table gives an empty result.

    Every stage groups by digest and whole text, so that two texts with one digest never mix. Each
    task folds its own rows first, the groups then meet per salt (the task's number), so a group
    with a third of all rows sends at most one text per task, and to many reducers; last, the
    winners of the salts meet. Rows find their group by digest, frequent digests salted, and by
    text where a digest has several.
    """
    spark = docs.sparkSession
    salts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), normalise(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("text")
    ).select("doc_id", "text", digest(F.col("text")).alias("digest"))
    salted = (
        rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        .groupBy("digest", "text", "salt")
        .agg(F.max("doc_id").alias("best"), F.count(F.lit(1)).alias("n"))
    )
    winners = settle(
        salted.groupBy("digest", "text")
        .agg(F.max("best").alias("keep_id"), F.sum("n").alias("group_size"))
        .select("digest", F.sha2("text", 256).alias("content"), "keep_id", "group_size")
    )
    clashes = settle(winners.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest"))
    clashing = not clashes.isEmpty()

    members = rows.select("doc_id", "digest", F.sha2("text", 256).alias("content") if clashing else F.lit("").alias("content"))
    members = members.dropDuplicates(["doc_id", "digest", "content"])
    keys = ["digest", "content"] if clashing else ["digest"]
    named = winners if clashing else winners.drop("content")
    found = salted_join(
        members if clashing else members.drop("content"), named, keys,
        sizes=winners.select(*keys, F.col("group_size").alias("n")),
    )
    return found.select(
        "doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"), "digest",
    )

"""Corpus pipeline over ``documents``: quality rules, line dedup, near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the
last return the columns of ``documents``. Rows with a null id count like others, told apart by what
they hold; as line dedup and near duplicates compare ids, those two keep them as they are.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.llm.jaccard_join import jaccard_join
from hitloom.llm.line_dedup import line_dedup
from hitloom.llm.packing import pack
from hitloom.llm.quality_rules import quality_rules
from hitloom.llm.queries import tokenizer
from hitloom.llm.source_mixing import mix
from hitloom.session import shared_folder


def _keyed(docs: DataFrame) -> DataFrame:
    """Adds __key: the id or, where it is null, a hash of what the stages look at."""
    return docs.withColumn("__key", F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text", "lang", "source")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    rows = _keyed(docs)
    kept = quality_rules(rows, id_col="__key").where("kept").select(F.col("doc_id").alias("__id")).distinct()
    return rows.join(kept, F.col("__key") == F.col("__id"), "left_semi").drop("__key")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one has; one that loses all its words goes."""
    rows = line_dedup(docs)
    left = F.trim(F.regexp_replace("text", r"[\x09-\x0D\x20]+", " ")) != ""
    rows = rows.where((F.size("deleted") == 0) | left)
    return rows.select(*[F.col("text").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id; rows without an id are in no group."""
    groups = jaccard_join(docs)
    kept = groups.where("doc_id = component_id").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(kept, F.col("doc_id") == F.col("__id"), "left_semi").unionByName(docs.where("doc_id is null"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix uses it."""
    rows = _keyed(docs)
    uses = mix(rows, id_col="__key").where("uses > 0").groupBy(F.col("doc_id").alias("__id")).agg(F.max("uses").alias("__uses"))
    rows = rows.join(uses, F.col("__key") == F.col("__id"))
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__uses").cast("int")))).select(*[F.col(f"`{c}`") for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences."""
    return pack(docs, tokenizer()).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]
#: Outlier estimates, diffs, components and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if at == len(STAGES) - 1:
            return out
        path = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

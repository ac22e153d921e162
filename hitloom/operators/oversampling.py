"""Minority oversampling between exact nearest neighbours."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.operators.neighbours import nearest_neighbours
from hitloom.operators.ranking import hash_cuts, hash_order, prefix_counts
from hitloom.session import settle

# Default neighbour count.
DEFAULT_K = 5


def oversampling_plan(counts: dict, wanted: bool = True, k: int | None = None) -> tuple[bool, int]:
    """Whether to oversample and with how many neighbours, from rows per class."""
    minority = min(counts.values(), default=0)
    if not wanted or minority <= 1:
        return False, DEFAULT_K
    return True, max(1, min(k or DEFAULT_K, minority - 1))


def plan_table(class_counts: DataFrame) -> DataFrame:
    """The same decision as a one-row table: minority and majority size, use, k, rows to add."""
    sizes = class_counts.agg(F.min("n").alias("minority"), F.max("n").alias("majority"))
    use = F.col("minority") > 1
    k = F.greatest(F.lit(1), F.least(F.lit(DEFAULT_K), F.col("minority") - 1))
    return sizes.select(
        "minority",
        "majority",
        use.alias("use"),
        F.when(use, k).otherwise(DEFAULT_K).cast("bigint").alias("k"),
        F.when(use, F.col("majority") - F.col("minority")).otherwise(0).alias("to_add"),
    )


def synthetic_rows(
    train: DataFrame, label: str, key: str, k: int, seed: int, features: str = "features"
) -> DataFrame:
    """New minority rows (features, label) that level the classes.

    Each lies between a minority row and one of its k nearest. Every minority row is used
    equally often; the remainder goes to the first rows in hash order. Neighbour and position
    are taken from hashes, so a rerun gives the same rows.
    """
    return synthetic_sets(train, label, key, [k], seed, features)[k]


def synthetic_sets(
    train: DataFrame, label: str, key: str, ks: list[int], seed: int, features: str = "features"
) -> dict[int, DataFrame]:
    """:func:`synthetic_rows` for several numbers of neighbours, which are searched for once."""
    counts = {r[label]: r["n"] for r in train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    minority = min(counts, key=lambda c: (counts[c], c))
    size, missing = counts[minority], max(counts.values()) - counts[minority]
    rows = train.where(F.col(label) == minority).select(
        F.col(key).cast("string").alias("key"), vector_to_array(features).alias("vec"), F.lit(0).alias("c")
    ).withColumn("_h", hash_order(F.col("key"), seed))
    rows = settle(rows)
    each, rest = divmod(missing, size)
    again = F.lit(each)
    if rest:
        quota = rows.sparkSession.createDataFrame([(0, 0, rest)], "label int, part int, quota bigint")
        cut = hash_cuts(rows, prefix_counts(rows, "c"), "c", quota).first()["cut"]
        again = again + (F.col("_h") <= cut).cast("int")
    used = rows.select("key", "vec", again.alias("times"))
    near = nearest_neighbours(rows.select("key", "vec"), max(ks)).select("key", "near")
    drawn = used.where("times > 0").join(near, "key")
    drawn = settle(drawn) if len(ks) > 1 else drawn
    return {k: _between(drawn.withColumn("near", F.slice("near", 1, k)), seed, features, minority, label) for k in ks}


def _between(drawn: DataFrame, seed: int, features: str, minority, label: str) -> DataFrame:
    """Each row as often as it is used, moved towards one of its neighbours."""
    drawn = drawn.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
    pick = F.pmod(F.xxhash64("key", "copy", F.lit(f"pick{seed}")), F.size("near")) + 1
    u = F.pmod(F.xxhash64("key", "copy", F.lit(f"step{seed}")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    other = F.element_at("near", pick.cast("int"))
    mixed = F.zip_with("vec", other, lambda a, b: a + F.col("u") * (b - a))
    return drawn.withColumn("u", u).select(
        array_to_vector(mixed).alias(features), F.lit(minority).cast("int").alias(label)
    )


def oversample(train: DataFrame, label: str, key: str, k: int, seed: int, features: str = "features") -> DataFrame:
    """Training rows plus synthetic minority rows: (features, label)."""
    real = train.select(features, F.col(label).cast("int").alias(label))
    return real.unionByName(synthetic_rows(train, label, key, k, seed, features))

"""Rank statistics, hash samples and exact quotas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hitloom.operators.skew import running_sums
from hitloom.session import settle, settle_wide

RANGE_ROWS = 200_000
HASH_DIGITS = 4  # quota histograms have at most 16^4 rows per class


def hash_order(key: Column, seed: int) -> Column:
    """A reproducible pseudo-random order of keys, independent of partitioning."""
    return F.md5(F.concat_ws("_", F.lit(str(seed)), key.cast("string")))


def class_cells(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """Positives and negatives per feature and distinct value: (feature, value, pos, neg)."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    long = df.select(F.explode(pairs).alias("c"), F.col(label).alias("y")).select("c.*", "y")
    return (
        long.dropna()
        .groupBy("feature", "value")
        .agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))
        .where(F.col("pos") + F.col("neg") > 0)
    )


def ranges_for(cells: DataFrame, rows_per_range: int = RANGE_ROWS) -> int:
    """How many ranges of about ``rows_per_range`` rows a written table makes."""
    return -(-cells.count() // rows_per_range)


def rank_statistics(
    df: DataFrame, columns: list[str], label: str, rows_per_range: int = RANGE_ROWS
) -> DataFrame:
    """Per feature: class sizes, Mann-Whitney U of the positives, AUC and the tie sum.

    U counts, for every positive, the negatives below it plus half the negatives equal to it.
    Rows are folded to distinct values first; running sums go by value range.
    """
    cells = settle(class_cells(df, columns, label))
    below = running_sums(cells, "value", {"neg": "neg_below"}, ranges_for(cells, rows_per_range), ["feature"])
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    ties = (pos + neg) * (pos + neg) * (pos + neg) - (pos + neg)
    total = below.groupBy("feature").agg(
        F.sum("pos").alias("n_pos"),
        F.sum("neg").alias("n_neg"),
        F.sum(pos * (F.col("neg_below") + neg / 2)).alias("u"),
        F.sum(ties).alias("tie_sum"),
    )
    area = F.try_divide("u", F.col("n_pos").cast("double") * F.col("n_neg"))
    return total.withColumn("auc", area)


def mid_ranks(df: DataFrame, column: str, rows_per_range: int = RANGE_ROWS) -> DataFrame:
    """Average rank of each distinct value of a column: (value, n, mid_rank)."""
    rows = df.where(F.col(column).isNotNull())
    named = rows.select(F.lit(column).alias("feature"), F.col(column).cast("double").alias("value"))
    cells = settle(named.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")))
    below = running_sums(cells, "value", {"n": "below"}, ranges_for(cells, rows_per_range))
    return below.select("value", "n", (F.col("below") + (F.col("n") + 1) / 2).alias("mid_rank"))


def top_per_group(df: DataFrame, groups: list[str], by: Column, ties: list[str], k: int) -> DataFrame:
    """The first k rows of each group with their rank, first-wins on ties."""
    order = Window.partitionBy(*groups).orderBy(by, *ties)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def fixed_sample(df: DataFrame, n: int, key: str, seed: int) -> DataFrame:
    """Exactly n rows in hash order, or all rows if n <= 0; the same rows however partitioned."""
    return df if n <= 0 else df.orderBy(hash_order(F.col(key), seed), key).limit(n)


def shared_quotas(counts: DataFrame, label: str, share: float) -> DataFrame:
    """Test rows per class: ceil(share * n) in all, split by largest remainder."""
    everything = Window.partitionBy(F.lit(0))
    total = F.sum("n").over(everything)
    exact = F.col("n") * F.ceil(total * F.lit(share)) / total
    base = counts.select(label, "n", F.ceil(total * F.lit(share)).alias("draws"), exact.alias("exact"))
    floors = base.withColumn("whole", F.floor("exact"))
    by_rest = everything.orderBy((F.col("exact") - F.col("whole")).desc(), label)
    extra = F.row_number().over(by_rest) <= F.col("draws") - F.sum("whole").over(everything)
    return floors.select(label, (F.col("whole") + extra.cast("int")).cast("bigint").alias("quota"))


def prefix_counts(hashed: DataFrame, label: str, order: str = "_h") -> DataFrame:
    """Rows per class and prefix of the hash column."""
    prefix = F.substring(order, 1, HASH_DIGITS).alias("prefix")
    return hashed.groupBy(F.col(label).alias("label"), prefix).agg(F.count(F.lit(1)).alias("n"))


def hash_cuts(
    hashed: DataFrame, histogram: DataFrame, label: str, quotas: DataFrame, order: str = "_h"
) -> DataFrame:
    """For each (label, part, quota) the hash of the quota-th row of that class in hash order.

    The histogram of hash prefixes tells which prefix holds the cut, and only rows with that
    prefix are ranked, so no task sees a whole class. The result has one row per quota; several
    steps read it, so it becomes a constant table.
    """
    upto = Window.partitionBy("label").orderBy("prefix")
    sums = histogram.withColumn("upto", F.sum("n").over(upto))
    held = sums.join(F.broadcast(quotas), "label").where(
        (F.col("quota") <= F.col("upto")) & (F.col("quota") > F.col("upto") - F.col("n"))
    )
    spots = held.select("label", "prefix", "part", (F.col("quota") - F.col("upto") + F.col("n")).alias("spot"))
    rows = hashed.select(
        F.col(label).alias("label"), F.col(order).alias("cut"), F.substring(order, 1, HASH_DIGITS).alias("prefix")
    )
    near = rows.join(F.broadcast(spots), ["label", "prefix"])
    ranks = Window.partitionBy("label", "part").orderBy("cut")
    found = near.withColumn("r", F.row_number().over(ranks)).where(F.col("r") == F.col("spot"))
    cuts = found.select("label", "part", "cut")
    return hashed.sparkSession.createDataFrame(cuts.collect(), cuts.schema)


def _hashed(df: DataFrame, key: str, seed: int, settled: bool) -> DataFrame:
    hashed = df.withColumn("_h", hash_order(F.col(key), seed))
    return settle_wide(hashed) if settled else hashed


def with_test_flag(
    df: DataFrame, label: str, key: str, seed: int, share: float, settled: bool = False
) -> DataFrame:
    """Add ``is_test`` for an exact stratified share of unique keys; rows are not shuffled.

    ``settled`` writes the rows once with their hash, for a table that is costly to derive.
    """
    hashed = _hashed(df, key, seed, settled)
    histogram = prefix_counts(hashed, label)
    counts = histogram.groupBy("label").agg(F.sum("n").alias("n"))
    quotas = shared_quotas(counts, "label", share).withColumn("part", F.lit(0))
    cuts = hash_cuts(hashed, histogram, label, quotas).select(F.col("label").alias(label), "cut")
    flagged = hashed.join(F.broadcast(cuts), label, "left")
    return flagged.select(*df.columns, F.coalesce(F.col("_h") <= F.col("cut"), F.lit(False)).alias("is_test"))


def with_folds(df: DataFrame, label: str, key: str, seed: int, k: int, settled: bool = False) -> DataFrame:
    """Add ``fold`` 0..k-1: equal stratified parts in hash order, rows not shuffled."""
    hashed = _hashed(df, key, seed, settled)
    histogram = prefix_counts(hashed, label)
    counts = histogram.groupBy("label").agg(F.sum("n").alias("n"))
    part = F.explode(F.sequence(F.lit(1), F.lit(k - 1))).alias("part")
    quota = F.floor(F.col("n") * F.col("part") / F.lit(k)).cast("bigint").alias("quota")
    quotas = counts.select("label", "n", part).select("label", "part", quota)
    cuts = hash_cuts(hashed, histogram, label, quotas.where(F.col("quota") > 0))
    empty = quotas.where(F.col("quota") == 0).select("label", "part", F.lit("").alias("cut"))
    per_class = cuts.unionByName(empty).groupBy(F.col("label").alias(label)).agg(F.collect_list("cut").alias("cuts"))
    return hashed.join(F.broadcast(per_class), label, "left").select(
        *df.columns, F.size(F.filter("cuts", lambda c: c < F.col("_h"))).alias("fold")
    )

"""Joins and running sums that stay balanced when one key holds much of the data."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hitloom.session import settle

HOT_SHARE = 1.0 / 1024  # a key above this share is split; at most 1024 such keys can exist
SALTS = 64


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(and_, (left[k] == right[k] for k in keys))


def hot_keys(df: DataFrame, keys: list[str], sizes: DataFrame | None = None) -> DataFrame:
    """Keys that hold more than ``HOT_SHARE`` of all rows: at most ``1 / HOT_SHARE`` rows.

    ``sizes`` may pass in row counts per key (columns ``keys`` + ``n``) that are already known.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")) if sizes is None else sizes
    total = counted.agg(F.sum("n").alias("total")).scalar()
    return counted.where(F.col("n") > total * F.lit(HOT_SHARE)).select(*keys)


def salted_join(
    many: DataFrame,
    few: DataFrame,
    keys: list[str],
    how: str = "inner",
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Equi-join in which rows of ``many`` with a hot key spread over ``SALTS`` tasks.

    The matching rows of ``few`` are repeated once per salt. Rows of ``many`` with a NULL key
    match nothing, so they spread by their own hash. ``how`` is inner or left.
    """
    hot = hot_keys(many, keys, sizes).withColumn("_hot", F.lit(True))
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in many.columns]), F.lit(SALTS)).cast("int")
    null_key = reduce(or_, (F.col(f"`{k}`").isNull() for k in keys))
    left = many.join(F.broadcast(hot), keys, "left").withColumn(
        "_salt", F.when(F.col("_hot") | null_key, spread).otherwise(F.lit(0))
    )
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(
        F.array(F.lit(0))
    )
    right = few.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.explode(salts))
    joined = left.drop("_hot").join(right.drop("_hot"), [*keys, "_salt"], how)
    order = [c for c in many.columns] + [c for c in few.columns if c not in keys]
    return joined.select(*[F.col(f"`{c}`") for c in order])


def running_sums(
    cells: DataFrame,
    order: str,
    sums: dict[str, str],
    ranges: int,
    groups: list[str] | None = None,
    descending: bool = False,
) -> DataFrame:
    """Add, for each ``sums[column]``, the total of ``column`` over the rows before this one.

    Order is by ``order`` within ``groups`` and must be unique there. Rows are dealt in order into
    ``ranges`` parts of about equal size, whatever the values; a part is one window group, and the
    totals of the parts before it come from a table with one row per part and group. Callers let
    ``ranges`` grow with the rows, so no window holds more than a fixed number of them.
    """
    groups = groups or []
    # Written, since where Spark cuts the ranges is decided anew whenever they are computed.
    dealt = cells.repartitionByRange(max(1, ranges), *groups, order)
    placed = settle(dealt.withColumn("_range", F.spark_partition_id()))

    def sort(column: str) -> Column:
        return F.col(column).desc() if descending else F.col(column).asc()

    before = (Window.unboundedPreceding, -1)
    inner = Window.partitionBy(*groups, "_range").orderBy(sort(order)).rowsBetween(*before)
    outer = Window.partitionBy(*groups).orderBy(sort("_range")).rowsBetween(*before)
    totals = placed.groupBy(*groups, "_range").agg(*[F.sum(c).alias(c) for c in sums])
    starts = totals.select(
        *groups,
        "_range",
        *[F.coalesce(F.sum(c).over(outer), F.lit(0)).alias(f"_from_{c}") for c in sums],
    )
    joined = placed.join(starts, [*groups, "_range"])
    kept = [F.col(c) for c in cells.columns]
    return joined.select(
        *kept,
        *[
            (F.col(f"_from_{c}") + F.coalesce(F.sum(c).over(inner), F.lit(0))).alias(n)
            for c, n in sums.items()
        ],
    )

"""Exact quantiles without holding a column in one task."""

from __future__ import annotations

from math import ceil, floor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.operators.skew import running_sums

ACCURACY = 10_000
RANGE_ROWS = 200_000
MARGIN = 4.0 / ACCURACY  # wider than the rank error of the sketch


def _bracketed(df: DataFrame, number: dict, asked: list[tuple[str, float]]) -> list[tuple]:
    """(column, p, lo, hi, total, below, inside) per asked quantile whose column has values; its ranks lie in lo..hi.

    A sketch proposes brackets, one aggregate counts the values below and inside them, and those
    that miss a rank are proposed again wider, at last from the least to the greatest value.
    """
    done, margin = [], MARGIN
    while asked:
        sides: dict[str, list[float]] = {}
        for c, p in asked:
            sides.setdefault(c, []).extend((max(0.0, p - margin), min(1.0, p + margin)))
        found = df.agg(*[F.percentile_approx(number[c], x, ACCURACY).alias(c) for c, x in sides.items()]).first()
        ends = {c: iter(found[c]) for c in sides if found[c]}
        spans = [(c, p, next(ends[c]), next(ends[c])) for c, p in asked if c in ends]
        if not spans:
            break
        cells = [
            F.struct(F.count(x).alias("total"), F.count_if(x < lo).alias("below"), F.count_if(x.between(lo, hi)).alias("inside"))
            for x, lo, hi in ((number[c], lo, hi) for c, _, lo, hi in spans)
        ]
        asked = []
        for (c, p, lo, hi), k in zip(spans, df.agg(F.array(*cells).alias("k")).first()["k"]):
            spot = (k["total"] - 1) * p
            if margin >= 1 or (k["below"] <= floor(spot) and ceil(spot) < k["below"] + k["inside"]):
                done.append((c, p, lo, hi, k["total"], k["below"], k["inside"]))
            else:
                asked.append((c, p))
        margin = max(16 * margin, 4.0 / ACCURACY)
    return done


def exact_quantiles(df: DataFrame, columns: list[str], shares: list[float], rows_per_range: int = RANGE_ROWS) -> DataFrame:
    """Interpolated quantiles per column, as (feature, p, value); NULLs are left out.

    Each quantile is bracketed by two values (see :func:`_bracketed`); the few values inside are
    grouped and ranked in ranges of at most about ``rows_per_range`` rows, so ranking sees about
    ``2 * MARGIN`` of the rows, each value once, and no task a whole bracket.
    """
    spark = df.sparkSession
    number = {c: F.col(c).cast("double") for c in columns}
    found = _bracketed(df, number, [(c, p) for c in columns for p in dict.fromkeys(shares)])
    if not found:
        return spark.createDataFrame([], "feature string, p double, value double")
    place = {c: i for i, c in enumerate(columns)}
    brackets = [(place[c], p, number[c], lo, hi) for c, p, lo, hi, *_ in found]
    outside = spark.createDataFrame(
        [(place[c], float(p), total, below) for c, p, _, _, total, below, _ in found], "i int, p double, total long, below long"
    )
    cells = [
        F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p"), F.when(x.between(lo, hi), x).alias("v"))
        for i, p, x, lo, hi in brackets
    ]
    inside = df.select(F.explode(F.array(*cells)).alias("c")).select("c.*").where(F.col("v").isNotNull())
    grouped = inside.groupBy("i", "p", "v").agg(F.count(F.lit(1)).alias("n"))
    ranges = -(-sum(inside for *_, inside in found) // rows_per_range)
    ranked = running_sums(grouped, "v", {"n": "before"}, ranges, ["i", "p"]).join(F.broadcast(outside), ["i", "p"])
    spot = (F.col("total") - 1) * F.col("p")
    low, high = F.floor(spot), F.ceil(spot)
    last = F.col("below") + F.col("before") + F.col("n")

    def at(rank):
        return F.max(F.when((last - F.col("n") <= rank) & (rank < last), F.col("v")))

    picked = ranked.groupBy("i", "p").agg(
        at(low).alias("a"), at(high).alias("b"), F.max(spot - low).alias("part")
    )
    name = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("i") + 1)
    value = F.col("a") + (F.col("b") - F.col("a")) * F.col("part")
    return picked.select(name.alias("feature"), "p", value.alias("value"))

"""Counts, shares, histograms, correlations and profiles."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.operators.quantiles import exact_quantiles




def rate_by_year(
    df: DataFrame, label: str = "is_hit", year: str = "release_year", weight: str | None = None
) -> DataFrame:
    """Mean label per year, rows without year or label dropped. ``weight`` counts a row that
    often."""
    w = F.lit(1) if weight is None else F.col(weight)
    rows = df.dropna(subset=[year, label])
    return rows.groupBy(F.col(year).cast("int").alias(year)).agg(
        F.sum(w).cast("bigint").alias("n"),
        F.sum(w * F.col(label)).cast("bigint").alias("hits"),
        (F.sum(w * F.col(label)).cast("double") / F.sum(w)).alias("hit_rate"),
    )


def class_histogram(df: DataFrame, column: str, label: str = "is_hit", bins: int = 25) -> DataFrame:
    """Equal-width histogram of a column per class; the range is a scalar subquery."""
    span = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi")).alias("s")).scalar()
    lo, hi = span["lo"], span["hi"]
    position = F.floor((F.col(column) - lo) / ((hi - lo) / F.lit(float(bins)))) + 1
    bin_ = F.when(lo == hi, F.lit(1)).otherwise(F.least(position, F.lit(bins)))
    rows = df.where(F.col(column).isNotNull())
    return rows.groupBy(bin_.cast("bigint").alias("bin"), F.col(label)).agg(
        F.count(F.lit(1)).alias("n")
    )


def correlations(df: DataFrame, columns: list[str], digits: int = 2) -> DataFrame:
    """Pearson correlation of every pair on its complete rows, one pass, long form.

    A row is spread to its complete pairs and folded at once by partial aggregation; the shuffle
    carries one row per pair and task. A constant column has no correlation.
    """
    number = [F.col(c).cast("double") for c in columns]
    pairs = combinations_with_replacement(range(len(columns)), 2)
    cells = [
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), number[i].alias("x"), number[j].alias("y"))
        for i, j in pairs
    ]
    spread = df.select(F.explode(F.array(*cells)).alias("c")).select("c.*").dropna()
    moments = spread.groupBy("i", "j").agg(
        F.covar_pop("x", "y").alias("xy"),
        # Partial sums leave a trace of spread in a constant column, so its limits decide.
        F.when(F.min("x") < F.max("x"), F.stddev_pop("x")).alias("sx"),
        F.when(F.min("y") < F.max("y"), F.stddev_pop("y")).alias("sy"),
    )
    wanted = df.sparkSession.createDataFrame(
        [(i, j, a, b) for i, a in enumerate(columns) for j, b in enumerate(columns)],
        "a int, b int, feature_a string, feature_b string",
    )
    known = wanted.withColumns({"i": F.least("a", "b"), "j": F.greatest("a", "b")})
    r = F.try_divide("xy", F.col("sx") * F.col("sy"))
    return known.join(F.broadcast(moments), ["i", "j"], "left").select(
        "feature_a", "feature_b", F.bround(r, digits).alias("corr")
    )


def scatter(df: DataFrame, hover: tuple[str, ...] = ("track_name", "artist_name", "genre", "release_date")) -> DataFrame:
    """Two numeric columns, the label and the hover columns that a table has."""
    numbers = [n for n, t in df.dtypes if t in ("double", "float", "int", "bigint")]
    x = "danceability" if "danceability" in df.columns else numbers[0]
    y = "energy" if "energy" in df.columns else numbers[1]
    return df.select(
        F.col(x).alias("x"), F.col(y).alias("y"), "is_hit", *[c for c in hover if c in df.columns]
    )


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per value, NULLs left out."""
    return df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("count"))


def total_by(df: DataFrame, group: str, column: str, name: str) -> DataFrame:
    return df.dropna(subset=[group]).groupBy(group).agg(F.sum(column).alias(name))


def top(df: DataFrame, k: int, by: Column, *ties: str) -> DataFrame:
    """First k rows by a column, ties in the order of the given columns."""
    return df.orderBy(by, *ties).limit(k)


def histogram_of_totals(df: DataFrame, group: str, column: str, k: int = 50) -> DataFrame:
    """How many groups reach each total; the k highest totals."""
    totals = total_by(df, group, column, "total")
    return top(totals.groupBy("total").agg(F.count(F.lit(1)).alias("count")), k, F.col("total").desc())


def singles_share(df: DataFrame, group: str = "artist_name") -> DataFrame:
    """Groups with exactly one row against the other groups."""
    sizes = value_counts(df, group)
    return sizes.agg(
        F.count_if(F.col("count") == 1).alias("single"),
        F.count_if(F.col("count") > 1).alias("several"),
        F.count(F.lit(1)).alias("groups"),
    )


def top_share(df: DataFrame, group: str, k: int) -> DataFrame:
    """Rows of the k largest groups, of all groups, and of the others."""
    sizes = value_counts(df, group)
    best = top(sizes, k, F.col("count").desc(), group).agg(
        F.sum("count").alias("top_rows"), F.count(F.lit(1)).alias("top_groups")
    )
    whole = sizes.agg(F.struct(F.sum("count").alias("r"), F.count(F.lit(1)).alias("g")).alias("s")).scalar()
    return best.select(
        "top_rows",
        whole["r"].alias("all_rows"),
        (whole["r"] - F.col("top_rows")).alias("other_rows"),
        "top_groups",
        (whole["g"] - F.col("top_groups")).alias("other_groups"),
    )


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles per column."""
    cells = df.select(F.posexplode(F.array(*[F.col(c).cast("double") for c in columns])).alias("i", "v"))
    name = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("i") + 1)
    simple = cells.groupBy("i").agg(
        F.count("v").alias("count"),
        F.avg("v").alias("mean"),
        F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
    )
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    wide = quartiles.groupBy("feature").agg(
        *[F.max(F.when(F.col("p") == p, F.col("value"))).alias(n) for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))]
    )
    return simple.withColumn("feature", name).join(wide, "feature", "left").select(
        "feature", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Type, NULL count and row count of every column."""
    cells = [
        F.struct(
            F.lit(n).alias("column"),
            F.lit(t).alias("type"),
            F.count_if(F.col(f"`{n}`").isNull()).alias("nulls"),
            F.count(F.lit(1)).alias("rows"),
        )
        for n, t in df.dtypes
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that equal an earlier row (NULLs equal each other)."""
    return (
        df.groupBy(*df.columns)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"), F.sum("n").alias("rows"))
    )


def run_summary(df: DataFrame, flag: str = "billboard_matched") -> DataFrame:
    """Rows and matched rows, NULL flags counted as unmatched."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.coalesce(F.col(flag), F.lit(0)) == 1).alias("matched")
    )


def class_counts(df: DataFrame, label: str = "is_hit") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))

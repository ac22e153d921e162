"""Two-sample tests of hits against misses, all features in one table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.contracts import TEST_FEATURES
from hitloom.functions.numeric import lenient_double
from hitloom.functions.tails import student_p, u_p
from hitloom.operators.coercion import test_label
from hitloom.operators.ranking import rank_statistics


# Fixed value: the size of the smaller group up to which U is judged by its exact law, if nothing ties.
EXACT_ROWS = 8


def _tested(df: DataFrame, label: Column, features: list[str]) -> DataFrame:
    return df.select(
        label.alias("y"), *[lenient_double(F.col(f)).alias(f) for f in features if f in df.columns]
    )


def two_sample_moments(df: DataFrame, features: list[str], label: str = "is_hit") -> DataFrame:
    """Sizes, means and sample variances per feature and class, one pass, one row per feature."""
    rows = _tested(df, test_label(df, label), features)

    def spread(x: Column) -> Column:
        """Sample variance; a constant has none at all, where sums of rounded squares leave a trace."""
        return F.when(F.min(x) == F.max(x), F.when(F.count(x) > 1, F.lit(0.0))).otherwise(F.var_samp(x))

    def moments(f: str) -> Column:
        x = F.col(f)
        hit, miss = F.when(F.col("y") == 1, x), F.when(F.col("y") == 0, x)
        return F.struct(
            F.lit(f).alias("feature"),
            F.count(hit).alias("n_hit"),
            F.count(miss).alias("n_miss"),
            F.avg(hit).alias("mean_hit"),
            F.avg(miss).alias("mean_miss"),
            spread(hit).alias("var_hit"),
            spread(miss).alias("var_miss"),
        )

    present = [f for f in features if f in df.columns]
    return rows.agg(F.array(*[moments(f) for f in present]).alias("m")).select(F.inline("m"))


def welch(moments: DataFrame) -> DataFrame:
    """Welch's t and its degrees of freedom from class moments."""
    a, b = F.col("var_hit") / F.col("n_hit"), F.col("var_miss") / F.col("n_miss")
    t = F.try_divide(F.col("mean_hit") - F.col("mean_miss"), F.sqrt(a + b))
    df = F.try_divide(
        (a + b) * (a + b), a * a / (F.col("n_hit") - 1) + b * b / (F.col("n_miss") - 1)
    )
    return moments.withColumns({"welch_t_stat": t, "welch_df": df})


def effect_size(moments: DataFrame) -> DataFrame:
    """Cohen's d with the pooled sample variance; NULL where that is not positive."""
    n1, n0 = F.col("n_hit"), F.col("n_miss")
    pooled = ((n1 - 1) * F.col("var_hit") + (n0 - 1) * F.col("var_miss")) / (n1 + n0 - 2)
    d = (F.col("mean_hit") - F.col("mean_miss")) / F.sqrt(pooled)
    return moments.withColumn("cohens_d", F.when((n1 > 1) & (n0 > 1) & (pooled > 0), d))


def mann_whitney(df: DataFrame, features: list[str], label: str = "is_hit") -> DataFrame:
    """U of the hits per feature with its continuity- and tie-corrected z."""
    rows = _tested(df, test_label(df, label), features)
    stats = rank_statistics(rows, [f for f in features if f in df.columns], "y")
    n1, n0 = F.col("n_pos").cast("double"), F.col("n_neg").cast("double")
    n = n1 + n0
    spread = F.sqrt(n1 * n0 / 12 * (n + 1 - F.col("tie_sum") / (n * (n - 1))))
    larger = F.greatest(F.col("u"), n1 * n0 - F.col("u"))
    z = F.try_divide(larger - n1 * n0 / 2 - 0.5, spread)
    exact = (F.least("n_pos", "n_neg") <= EXACT_ROWS) & (F.col("tie_sum") == 0)
    return stats.select(
        "feature", "n_pos", "n_neg", F.col("u").alias("mannwhitney_u_stat"), F.greatest(z, F.lit(0.0)).alias("z"),
        F.coalesce(exact, F.lit(False)).alias("exact"),
    )


def hypothesis_table(
    df: DataFrame, features: list[str] | tuple[str, ...] = TEST_FEATURES, label: str = "is_hit", p_values: bool = True
) -> DataFrame:
    """One row per feature: status, sizes, means, Welch t, Mann-Whitney U, p-values, Cohen's d."""
    present = [f for f in features if f in df.columns]
    spark = df.sparkSession
    order = spark.createDataFrame([(i, f, f in present) for i, f in enumerate(features)], "o int, feature string, present boolean")
    if not present:
        return order.select("feature", F.lit("missing_column").alias("status"))
    moments = effect_size(welch(two_sample_moments(df, present, label)))
    ranks = mann_whitney(df, present, label).select("feature", "mannwhitney_u_stat", "z", "exact")
    joined = F.broadcast(order).join(moments, "feature", "left").join(ranks, "feature", "left")
    enough = (F.col("n_hit") > 1) & (F.col("n_miss") > 1)
    status = F.when(~F.col("present"), "missing_column").when(enough, "ok").otherwise("insufficient_samples")
    tested = {
        "mean_hit": F.col("mean_hit"),
        "mean_miss": F.col("mean_miss"),
        "mean_diff_hit_minus_miss": F.col("mean_hit") - F.col("mean_miss"),
        "welch_t_stat": F.col("welch_t_stat"),
        "mannwhitney_u_stat": F.col("mannwhitney_u_stat"),
        "cohens_d": F.col("cohens_d"),
    }
    if p_values:
        tested["welch_t_p_value"] = student_p(F.col("welch_t_stat"), F.col("welch_df"))
        tested["mannwhitney_u_p_value"] = u_p(*[F.col(c) for c in ("mannwhitney_u_stat", "n_hit", "n_miss", "exact", "z")])
        tested["status_p"] = F.when(F.col("exact"), "exact").otherwise("asymptotic")
    return joined.withColumn("status", status).select(
        "feature", "status", "n_hit", "n_miss", *[F.when(enough, v).alias(k) for k, v in tested.items()]
    )

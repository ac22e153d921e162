"""Imputation, scaling and encoding as a saved, JVM-side pipeline."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.contracts import FeatureContract, FrameSettings
from hitloom.operators.coercion import coerce, contract_issues, model_columns, with_time_features
from hitloom.operators.filters import audio_columns, audio_complete, audio_dropped, recent_years
from hitloom.operators.quantiles import exact_quantiles


def training_frame(
    df: DataFrame, contract: FeatureContract, settings: FrameSettings = FrameSettings()
) -> tuple[DataFrame, list[str], list[str]]:
    """Coerced, dated and filtered rows, with the numeric and categorical model columns.

    Rows without a label cannot be learned from and are dropped; nothing runs here.
    """
    shaped = with_time_features(coerce(df, contract), contract)
    issues = contract_issues(shaped, contract)
    if issues:
        raise ValueError("; ".join(issues))
    kept = audio_complete(recent_years(shaped, settings.years_back), settings.max_audio_missing)
    numeric, categorical = model_columns(kept, contract)
    labelled = kept.dropna(subset=[contract.label])
    return labelled.withColumn(contract.label, F.col(contract.label).cast("int")), numeric, categorical


def audio_summary(
    df: DataFrame, contract: FeatureContract, settings: FrameSettings = FrameSettings()
) -> tuple[list[str], DataFrame]:
    """The audio columns of a training table, and how many rows :func:`training_frame` drops for missing ones (one row)."""
    recent = recent_years(with_time_features(coerce(df, contract), contract), settings.years_back)
    return audio_columns(recent), audio_dropped(recent, settings.max_audio_missing)


def numeric_statistics(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact median, and mean and population deviation after median imputation, per column."""
    medians = exact_quantiles(df, columns, [0.5]).select("feature", F.col("value").alias("median"))
    known = medians.agg(F.map_from_entries(F.collect_list(F.struct("feature", "median")))).scalar()
    filled = [F.coalesce(F.col(c).cast("double"), F.element_at(known, c)) for c in columns]
    cells = [
        F.struct(
            F.lit(c).alias("feature"), F.avg(x).alias("mean"), F.when(F.min(x) < F.max(x), F.stddev_pop(x)).otherwise(F.min(x) * 0).alias("std"), F.max(F.element_at(known, c)).alias("median")
        )
        for c, x in zip(columns, filled)
    ]
    return df.agg(F.array(*cells).alias("s")).select(F.inline("s"))


def modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Most frequent value per column, the smallest on ties: (feature, mode)."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    counted = (
        df.select(F.explode(pairs).alias("c"))
        .select("c.*")
        .dropna()
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.min_by("value", F.struct((-F.col("n")).alias("n"), "value"))
    return counted.groupBy("feature").agg(best.alias("mode"))


@dataclass(frozen=True)
class Prepared:
    """Fitted preparation: the pipeline that adds ``features``, and what it learned."""

    model: PipelineModel
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    names: tuple[str, ...]

    def transform(self, df: DataFrame) -> DataFrame:
        missing = sorted({*self.numeric, *self.categorical} - set(df.columns))
        if missing:
            raise ValueError(f"columns {missing} are needed to prepare features")
        return self.model.transform(df)


def _number(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fit_preparation(
    train: DataFrame, numeric: list[str], categorical: list[str], scale: bool = True
) -> Prepared:
    """Median and mode imputation, population scaling (or none) and one-hot encoding.

    Unseen categories become all zeros. The fitted form is SQL plus Spark's own encoders, so
    scoring stays in the JVM and the whole model can be saved.
    """
    stats = {r["feature"]: r for r in numeric_statistics(train, numeric).collect()}
    common = {r["feature"]: r["mode"] for r in modes(train, categorical).collect()} if categorical else {}
    parts = []
    for c in numeric:
        s = stats[c]
        if s["median"] is None and s["mean"] is not None:
            raise ValueError(f"{c} has values but no median")
        filled = f"coalesce(CAST(`{c}` AS DOUBLE), {_number(s['median'] if s['median'] is not None else 0.0)})"
        if scale:
            filled = f"({filled} - {_number(s['mean'] or 0.0)}) / {_number(s['std'] or 1.0)}"
        parts.append(f"{filled} AS `num__{c}`")
    parts += [f"coalesce(CAST(`{c}` AS STRING), {_text(common.get(c) or '')}) AS `cat__{c}`" for c in categorical]
    impute = SQLTransformer(statement="SELECT *, " + ", ".join(parts) + " FROM __THIS__")
    stages = [impute]
    if categorical:
        cats = [f"cat__{c}" for c in categorical]
        index = [f"index__{c}" for c in categorical]
        hot = [f"hot__{c}" for c in categorical]
        stages += [
            StringIndexer(inputCols=cats, outputCols=index, handleInvalid="keep", stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True, handleInvalid="error"),
        ]
    else:
        hot = []
    stages.append(VectorAssembler(inputCols=[f"num__{c}" for c in numeric] + hot, outputCol="features"))
    temporary = [f"num__{c}" for c in numeric] + [x for c in categorical for x in (f"cat__{c}", f"index__{c}", f"hot__{c}")]
    model = Pipeline(stages=stages).fit(train)
    keep = SQLTransformer(statement="SELECT * EXCEPT (" + ", ".join(f"`{c}`" for c in temporary) + ") FROM __THIS__")
    model = PipelineModel(stages=[*model.stages, keep])
    labels = model.stages[1].labelsArray if categorical else []
    names = [f"num__{c}" for c in numeric]
    names += [f"cat__{c}_{value}" for c, values in zip(categorical, labels) for value in values]
    return Prepared(model, tuple(numeric), tuple(categorical), tuple(names))


def feature_groups(prepared: Prepared) -> list[str]:
    """For each transformed feature the raw column it came from."""
    groups = []
    for name in prepared.names:
        raw = name.split("__", 1)[1]
        owners = [c for c in prepared.categorical if raw == c or raw.startswith(f"{c}_")]
        groups.append(raw if name.startswith("num__") else max(owners, key=len, default=raw))
    return groups


def long_onehot(df: DataFrame, key: str, column: str) -> DataFrame:
    """One-hot rows (key, feature, value 1.0) of a column after mode imputation."""
    common = modes(df, [column]).select("mode").scalar()
    filled = F.coalesce(F.col(column).cast("string"), common)
    return df.select(
        key, F.concat(F.lit(f"cat__{column}_"), filled).alias("feature"), F.lit(1.0).alias("value")
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (classes * n_c) per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    both = counts.agg(F.struct(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).alias("s")).scalar()
    return counts.withColumn("weight", both["n"].cast("double") / (both["k"] * F.col("n")))

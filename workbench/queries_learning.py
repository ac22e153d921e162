"""Preparation, oversampling, models, search, attributions and streaming."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from hitloom.contracts import (
    ExplainSettings,
    FeatureContract,
    ForestSettings,
    FrameSettings,
    LinearSettings,
    NetSettings,
    REPORT_KEYS,
)
from hitloom.functions.numeric import harmonic_f1, sigmoid
from hitloom.operators import attribution as at, matching as m, oversampling as ov, preparation as pp
from hitloom.operators.eda import class_counts
from hitloom.operators.metrics import binary_metrics, confusion_counts
from hitloom.operators.neighbours import nearest_neighbours
from hitloom.operators.network import Net, shapes, unpack
from hitloom.plans import explaining as ex, scoring as sc, training as tr, tuning as tu
from hitloom.session import settle, shared_folder
from hitloom.streaming import snapshots as st
from workbench import views as v
from workbench.queries_songs import SONG_CHART
from workbench.registry import big, query, r, real

NUMERIC = ("energy", "tempo", "danceability", "valence")
LINES = FeatureContract(ids=("row_key",), numeric=NUMERIC)
RARE = FeatureContract(ids=("row_key",), numeric=("tempo", "danceability", "valence"))
RARE_SQL = "rare AS (SELECT * REPLACE ((energy >= 48)::INT AS is_hit) FROM train)"


def _rare(spark, sf):
    return v.train(spark, sf).withColumn("is_hit", (F.col("energy") >= 48).cast("int"))


@query(
    "impute_scale",
    v.ctes(v.TRAIN)
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, {r('max(md)', 'median')}, {r(f'avg(coalesce({c}, md))', 'mean', 4)}, {r(f'stddev_pop(coalesce({c}, md))', 'std', 4)}
  FROM train, (SELECT median({c}) AS md FROM train)"""
        for c in NUMERIC
    ),
)
def impute_scale(spark, sf):
    found = pp.numeric_statistics(v.train(spark, sf), list(NUMERIC))
    return found.select("feature", real("median"), real("mean", digits=4), real("std", digits=4))


HOLED = "holed AS (SELECT song_ord, CASE WHEN song_ord % 7 <> 0 THEN genre END AS genre FROM songs)"


def _holed(spark, sf):
    return v.songs(spark, sf).select("song_ord", F.when(F.col("song_ord") % 7 != 0, F.col("genre")).alias("genre"))


@query(
    "onehot_long",
    v.ctes(v.SONGS, HOLED)
    + """SELECT song_ord, 'cat__genre_' || coalesce(genre, (SELECT genre FROM holed WHERE genre IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, genre LIMIT 1)) AS feature,
  1.0::DOUBLE AS value FROM holed""",
)
def onehot_long(spark, sf):
    return pp.long_onehot(_holed(spark, sf), "song_ord", "genre")


@query(
    "train_frame",
    v.ctes(v.TRAIN)
    + """SELECT row_key, is_hit, year(release_date)::BIGINT AS release_year, month(release_date)::BIGINT AS release_month, energy, valence, genre FROM train
  WHERE year(release_date) >= (SELECT max(year(release_date)) FROM train) - 4 AND (valence IS NULL)::INT / 4.0 <= 0.2""",
)
def train_frame(spark, sf):
    rows, numeric, categorical = pp.training_frame(v.train(spark, sf), LINES, FrameSettings(4, 0.2))
    return rows.select("row_key", "is_hit", big("release_year"), big("release_month"), "energy", "valence", *categorical)


@query(
    "scaled_rows",
    v.ctes(v.TRAIN)
    + f"""SELECT row_key, {r('(energy - me) / se', 'energy', 5)}, {r('(coalesce(valence, md) - mv) / sv', 'valence', 5)}, (genre = 'F')::INT::DOUBLE AS f, (genre = 'O')::INT::DOUBLE AS o
  FROM train, (SELECT avg(energy) AS me, stddev_pop(energy) AS se, max(md) AS md, avg(coalesce(valence, md)) AS mv, stddev_pop(coalesce(valence, md)) AS sv
    FROM train, (SELECT median(valence) AS md FROM train))""",
)
def scaled_rows(spark, sf):
    """Transformed features of the whole table."""
    df = v.train(spark, sf)
    x = vector_to_array("features")
    prepared = pp.fit_preparation(df, ["energy", "valence"], ["genre"])
    return prepared.transform(df).select(
        "row_key", real(x[0], "energy", 5), real(x[1], "valence", 5), x[2].alias("f"), x[3].alias("o")
    )


@query(
    "tree_rows",
    v.ctes(v.TRAIN)
    + f"""SELECT row_key, energy, coalesce(valence, (SELECT median(valence) FROM train)) AS valence, (genre = 'F')::INT::DOUBLE AS f, (genre = 'O')::INT::DOUBLE AS o FROM train""",
)
def tree_rows(spark, sf):
    """Preparation for trees: imputed and one-hot, not scaled."""
    df = v.train(spark, sf)
    x = vector_to_array("features")
    rows = pp.fit_preparation(df, ["energy", "valence"], ["genre"], scale=False).transform(df)
    return rows.select("row_key", x[0].alias("energy"), x[1].alias("valence"), x[2].alias("f"), x[3].alias("o"))


@query(
    "transformed_names",
    v.ctes(v.TRAIN)
    + """SELECT row_number() OVER (ORDER BY place, name) - 1 AS position, name FROM (
  SELECT i AS place, 'num__' || c AS name FROM (SELECT unnest([0, 1]) AS i, unnest(['energy', 'valence']) AS c)
  UNION ALL SELECT DISTINCT 2, 'cat__flag_' || flag FROM train UNION ALL SELECT DISTINCT 3, 'cat__genre_' || genre FROM train)""",
)
def transformed_names(spark, sf):
    """Names of the transformed features in their order; categories as the table has them."""
    names = pp.fit_preparation(v.train(spark, sf), ["energy", "valence"], ["flag", "genre"]).names
    return spark.createDataFrame(list(enumerate(names)), "position bigint, name string")


@query(
    "median_baseline",
    v.ctes(v.TRAIN, "filled AS (SELECT energy, coalesce(valence, (SELECT median(valence) FROM train)) AS valence, genre FROM train)")
    + f"""SELECT 'num__energy' AS feature, {r('(median(energy) - avg(energy)) / stddev_pop(energy)', 'median', 5)} FROM filled
  UNION ALL SELECT 'num__valence', {r('(median(valence) - avg(valence)) / stddev_pop(valence)', 'median', 5)} FROM filled
  UNION ALL SELECT 'cat__genre_' || g, {r("median((genre = g)::INT)", 'median', 5)} FROM filled, (SELECT DISTINCT genre AS g FROM filled) GROUP BY g""",
)
def median_baseline(spark, sf):
    """Where integrated gradients start: the median of every transformed feature over all rows."""
    df = v.train(spark, sf)
    prepared = pp.fit_preparation(df, ["energy", "valence"], ["genre"])
    values = at.median_baseline(ex.transformed(df, prepared), prepared.names)
    rows = spark.createDataFrame([(n, float(x)) for n, x in zip(prepared.names, values)], "feature string, median double")
    return rows.select("feature", real("median", digits=5))


@query(
    "validation_split",
    v.ctes(
        v.TRAIN,
        "sizes AS (SELECT is_hit, count(*) AS n FROM train GROUP BY 1)",
        "wanted AS (SELECT ceil(sum(n) * 0.2::DOUBLE)::BIGINT AS t, sum(n)::BIGINT AS n FROM sizes)",
    )
    + "SELECT ceil(t * 1.0::DOUBLE)::BIGINT AS test, ceil((n - t) * 0.1::DOUBLE)::BIGINT AS validation, (n - t - ceil((n - t) * 0.1::DOUBLE))::BIGINT AS fitting FROM wanted",
)
def validation_split(spark, sf):
    """Rows of the test, validation and fitting parts that the network sees."""
    df = v.train(spark, sf)
    rows = tr.net_rows(df, "row_key", LINES, NetSettings())
    parts = rows.parts.select("row_key", F.col("is_test").alias("held")).unionByName(
        rows.split.test.select("row_key", F.lit(None).cast("boolean").alias("held"))
    )
    return parts.agg(
        F.count_if(F.col("held").isNull()).alias("test"), F.count_if("held").alias("validation"),
        F.count_if(~F.col("held")).alias("fitting"),
    )


@query(
    "smote_settings",
    v.ctes(v.TRAIN, RARE_SQL, "c AS (SELECT count(*) AS n FROM rare GROUP BY is_hit)")
    + "SELECT min(n) AS minority, max(n) AS majority, min(n) > 1 AS use, greatest(1, least(5, min(n) - 1))::BIGINT AS k, max(n) - min(n) AS to_add FROM c",
)
def smote_settings(spark, sf):
    return ov.plan_table(class_counts(_rare(spark, sf)))


def _rare_vectors(spark, sf):
    df = _rare(spark, sf)
    prepared = pp.fit_preparation(df, ["tempo", "danceability", "valence"], [])
    return settle(prepared.transform(df).select("row_key", "is_hit", "features"))


@query(
    "smote_counts",
    v.ctes(v.TRAIN, RARE_SQL) + "SELECT is_hit, (SELECT max(n) FROM (SELECT count(*) AS n FROM rare GROUP BY is_hit)) AS n FROM rare GROUP BY is_hit",
)
def smote_counts(spark, sf):
    """Class sizes after oversampling: both equal the majority."""
    return class_counts(ov.oversample(_rare_vectors(spark, sf), "is_hit", "row_key", 5, 42))


@query("smote_rows")
def smote_rows(spark, sf):
    made = ov.synthetic_rows(_rare_vectors(spark, sf), "is_hit", "row_key", 5, 42)
    return made.select(vector_to_array("features").alias("features"), "is_hit")


@query(
    "knn_distance",
    # Rows lie on lines of equal y, a whole unit apart. Where the fifth on a row's own line is nearer, no
    # other line matters; the few remaining rows are compared with all.
    v.ctes(
        v.TRAIN,
        "p AS (SELECT row_key, tempo / 1000.0::DOUBLE AS x, danceability * 100 AS y FROM train)",
        "lines AS (SELECT row_key, x, y, list(x) OVER (PARTITION BY y ORDER BY x, row_key ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING EXCLUDE CURRENT ROW) AS near FROM p)",
        "own AS (SELECT row_key, x, y, list_sort([abs(x - z) for z in near])[5] AS kth FROM lines)",
    )
    + f"""SELECT row_key, {r('kth', 'kth')} FROM own WHERE kth < 0.9
  UNION ALL SELECT a.row_key, {r('list_sort(min(sqrt(pow(a.x - z.x, 2) + pow(a.y - z.y, 2)), 5))[5]', 'kth')}
  FROM own a JOIN p z ON a.row_key <> z.row_key WHERE a.kth IS NULL OR a.kth >= 0.9 GROUP BY a.row_key""",
)
def knn_distance(spark, sf):
    """Distance of every row to its fifth-nearest other row."""
    rows = v.train(spark, sf)
    vec = F.array(F.col("tempo") / 1000.0, F.col("danceability") * 100)
    near = nearest_neighbours(rows.select(F.col("row_key").alias("key"), vec.alias("vec")), 5)
    away = F.zip_with("vec", F.element_at("near", 5), lambda p, q: (p - q) * (p - q))
    kth = F.sqrt(F.aggregate(away, F.lit(0.0), lambda s, d: s + d))
    return near.select(F.col("key").alias("row_key"), real(kth, "kth"))


@query(
    "class_weights",
    v.ctes(v.TRAIN)
    + f"SELECT is_hit, count(*) AS n, {r('(SELECT count(*) FROM train) / (2.0 * count(*))', 'weight')} FROM train GROUP BY 1",
)
def class_weights(spark, sf):
    return pp.class_weights(v.train(spark, sf), "is_hit").select("is_hit", "n", real("weight"))


@query(
    "metrics_row",
    v.ctes(v.TRAIN)
    + f"""SELECT 'score' AS model, tn, fp, fn, tp, {r('(tn + tp) / (tn + fp + fn + tp)', 'accuracy')}, {r('tp / (tp + fp)', 'precision')}, {r('tp / (tp + fn)', 'recall')},
  {r('2 * tp / (2 * tp + fp + fn)', 'f1')}, {r('u / ((tp + fn)::DOUBLE * (tn + fp))', 'roc_auc')}
FROM (SELECT count(*) FILTER (is_hit = 0 AND score < 0.6) AS tn, count(*) FILTER (is_hit = 0 AND score >= 0.6) AS fp,
    count(*) FILTER (is_hit = 1 AND score < 0.6) AS fn, count(*) FILTER (is_hit = 1 AND score >= 0.6) AS tp FROM train),
  (SELECT sum(pos * (below + neg / 2.0::DOUBLE)) AS u FROM (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM
    (SELECT score, count(*) FILTER (is_hit = 1) AS pos, count(*) FILTER (is_hit = 0) AS neg FROM train GROUP BY 1)))""",
)
def metrics_row(spark, sf):
    """All metrics of a scored table as one row."""
    df = v.train(spark, sf)
    scored = df.select("is_hit", (F.col("score") >= 0.6).cast("int").alias("prediction"), F.col("score").alias("probability"))
    found = tr.evaluate(scored, "is_hit")
    (tn, fp), (fn, tp) = found["confusion_matrix"]
    names = ("accuracy", "precision", "recall", "f1", "roc_auc")
    row = ("score", tn, fp, fn, tp, *[found[n] for n in names])
    schema = "model string, tn bigint, fp bigint, fn bigint, tp bigint, " + ", ".join(f"{n} double" for n in names)
    return spark.createDataFrame([row], schema).select("model", "tn", "fp", "fn", "tp", *[real(n) for n in names])


@query(
    "metric_report",
    v.ctes(v.TRAIN)
    + """SELECT i::BIGINT AS position, m AS metric, round(x::DOUBLE, 6) AS value FROM (SELECT unnest([0, 4, 6, 7]) AS i, unnest(['n_rows', 'accuracy', 'precision', 'recall']) AS m, unnest([n, (tn + tp) / n, tp / (tp + fp), tp / (tp + fn)]) AS x
FROM (SELECT count(*) AS n, count(*) FILTER (is_hit = 0 AND score < 0.6) AS tn, count(*) FILTER (is_hit = 0 AND score >= 0.6) AS fp,
    count(*) FILTER (is_hit = 1 AND score < 0.6) AS fn, count(*) FILTER (is_hit = 1 AND score >= 0.6) AS tp FROM train))""",
)
def metric_report(spark, sf):
    """The key metrics that a run has, in their fixed order."""
    df = v.train(spark, sf).withColumn("prediction", (F.col("score") >= 0.6).cast("int"))
    m = binary_metrics(confusion_counts(df)).first()
    metrics = {"recall": m.recall, "precision": m.precision, "accuracy": m.accuracy, "n_rows": m.tn + m.fp + m.fn + m.tp, "model": "score"}
    rows = tr.report(metrics, spark, REPORT_KEYS)
    return rows.select(big("position"), "metric", F.round(F.col("value").cast("double"), 6).alias("value"))


def _predictions(run, df):
    return run.score(df).select(run.split.key, "prediction", real("probability"))


@query("logreg_score")
def logreg_score(spark, sf):
    df = v.train(spark, sf)
    run = tr.train_linear(df, "row_key", LINES, LinearSettings(oversample=False))
    frame, _, _ = pp.training_frame(df, LINES)
    return _predictions(run, frame)


@query("logreg_oversampled")
def logreg_oversampled(spark, sf):
    df = _rare(spark, sf)
    run = tr.train_linear(df, "row_key", RARE)
    frame, _, _ = pp.training_frame(df, RARE)
    return _predictions(run, frame)


@query("rf_score")
def rf_score(spark, sf):
    df = v.train(spark, sf)
    run = tr.train_forest(df, "row_key", LINES, ForestSettings(trees=20, depth=6, oversample=False))
    frame, _, _ = pp.training_frame(df, LINES)
    return _predictions(run, frame)


DOC_COLUMNS = FeatureContract(ids=("doc_id",), date="release_date", numeric=("energy", "tempo"), categorical=("genre", "artist_name"))


def _docs(spark, sf):
    """Documents as a training table; the date column of the contract is unknown."""
    return v.docs(spark, sf).withColumn("release_date", F.lit(None).cast("string"))


@query("mlp_score")
def mlp_score(spark, sf):
    df = _docs(spark, sf)
    run = tr.train_net(df, "doc_id", DOC_COLUMNS)
    frame, _, _ = pp.training_frame(df, DOC_COLUMNS)
    return _predictions(run, frame)


FIXED = {(0, 0): 1.0, (0, 1): 0.5}  # weights of the one unit in use, of energy and tempo


def _fixed_net():
    """A network of known weights: logit = 1.5 max(max(energy + tempo / 2 + 1, 0) - 0.2, 0) - 1."""
    parts = unpack(flat := np.zeros(sum(int(np.prod(s)) for s in shapes(2))), 2)
    for (unit, feature), w in FIXED.items():
        parts[0][feature, unit] = w
    parts[1][0], parts[2][0, 0], parts[3][0], parts[4][0, 0], parts[5][0] = 1.0, 1.0, -0.2, 1.5, -1.0
    return Net(flat, 2, 0.5)


@query(
    "score_song",
    v.ctes(
        v.SONGS,
        "wanted AS (SELECT DISTINCT lower(p_name) AS t, lower(p_brand) AS a FROM part)",
        "picked AS (SELECT min(song_ord) AS song_ord FROM songs, wanted WHERE lower(trim(track_name)) = t AND lower(trim(artist_name)) = a GROUP BY t, a)",
        """fits AS (SELECT md, avg(coalesce(energy, md)) AS me, stddev_pop(coalesce(energy, md)) AS se, avg(tempo) AS mt, stddev_pop(tempo) AS st
  FROM songs, (SELECT median(energy) AS md FROM songs) GROUP BY md)""",
        """scored AS (SELECT song_ord, track_name, artist_name, 1 / (1 + exp(-(1.5 * greatest(greatest((coalesce(energy, md) - me) / se + (tempo - mt) / st / 2 + 1, 0) - 0.2, 0) - 1))) AS p
  FROM songs JOIN picked USING (song_ord), fits)""",
    )
    + f"SELECT song_ord, track_name, artist_name, (p >= 0.5)::INT AS prediction, {r('p', 'probability')} FROM scored",
)
def score_song(spark, sf):
    """Songs asked for by name, scored by a network of known weights on preparation fitted to all songs."""
    songs, part = v.songs(spark, sf), v.table(spark, sf, "part")
    contract = FeatureContract(numeric=("energy", "tempo"), categorical=())
    wanted = part.select(F.col("p_name").alias("track"), F.col("p_brand").alias("artist")).distinct()
    prepared = pp.fit_preparation(songs, ["energy", "tempo"], [])
    found = sc.score_songs(songs, wanted, prepared, _fixed_net(), "song_ord", contract)
    return found.select("song_ord", "track_name", "artist_name", "prediction", real("probability"))


def _search_rows(spark, run):
    rows = [(i, str({k: x for k, x in s.items() if k != "score"}), s["score"]) for i, s in enumerate(run.metrics["search"])]
    return spark.createDataFrame(rows, "draw int, params string, score double")


@query("logreg_tuned")
def logreg_tuned(spark, sf):
    run = tu.tune_linear(_docs(spark, sf), "doc_id", DOC_COLUMNS)
    return _search_rows(spark, run)


@query("rf_tuned")
def rf_tuned(spark, sf):
    space = {"trees": (5, 10), "depth": (None, 4), "min_leaf": (1, 5)}
    run = tu.tune_forest(_docs(spark, sf), "doc_id", DOC_COLUMNS, ForestSettings(oversample=False), tu.Search(2, 2), space)
    return _search_rows(spark, run)


@query("mlp_tuned")
def mlp_tuned(spark, sf):
    space = {"batch_size": (16, 32, 64), "epochs": (2, 3), "lr": (1e-3, 5e-3)}
    run = tu.tune_net(_docs(spark, sf), "doc_id", DOC_COLUMNS, NetSettings(), 2, space)
    return _predictions(run, pp.training_frame(_docs(spark, sf), DOC_COLUMNS)[0])


WEIGHTS = {"energy": 0.5, "tempo": -0.0002, "danceability": 3.0}


@query(
    "linear_shap",
    v.ctes(v.TRAIN, "m AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}" for c in WEIGHTS) + " FROM train)")
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, {r(f'avg(abs({w}::DOUBLE * ({c} - m_{c})))', 'mean_abs_shap')} FROM train, m" for c, w in WEIGHTS.items()),
)
def linear_shap(spark, sf):
    df = v.train(spark, sf)
    values = at.linear_values(df, df, WEIGHTS, "row_key")
    return at.importance(values).select("feature", real("mean_abs_shap"))


@query(
    "topk",
    v.ctes(v.TRAIN, "m AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}" for c in WEIGHTS) + " FROM train)")
    + "SELECT * FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, {r(f'avg(abs({w}::DOUBLE * ({c} - m_{c})))', 'mean_abs_shap')} FROM train, m" for c, w in WEIGHTS.items())
    + ") ORDER BY mean_abs_shap DESC, feature LIMIT 2",
)
def topk(spark, sf):
    df = v.train(spark, sf)
    values = at.linear_values(df, df, WEIGHTS, "row_key")
    return at.top_importance(values, 2).select("feature", real("mean_abs_shap"))


PIECES = (("energy", "energy", 0), ("tempo", "price", 1), ("danceability", "price", 1))
VALUES_SQL = """vals AS (SELECT row_key, unnest(['energy', 'tempo', 'danceability']) AS feature, unnest([energy * 0.5, tempo * -0.0002::DOUBLE, danceability * 3]) AS value FROM train),
grouped AS (SELECT row_key, CASE feature WHEN 'energy' THEN 'energy' ELSE 'price' END AS feature_group, sum(value) AS attribution FROM vals GROUP BY ALL)"""


def _values(spark, sf):
    df = v.train(spark, sf)
    cells = [F.struct(F.lit(c).alias("feature"), (F.col(c) * w).alias("value")) for c, w in WEIGHTS.items()]
    return df.select("row_key", F.inline(F.array(*cells)))


@query(
    "attr_group",
    v.ctes(v.TRAIN, VALUES_SQL)
    + f"""SELECT row_key, feature_group, {r('attribution', 'attribution')}, {r('abs(attribution)', 'abs_attribution')},
  row_number() OVER (PARTITION BY row_key ORDER BY abs(attribution) DESC, feature_group) AS rank FROM grouped""",
)
def attr_group(spark, sf):
    groups = spark.createDataFrame(PIECES, at.GROUP_SCHEMA)
    found = at.grouped_values(_values(spark, sf), groups, "row_key")
    return found.select("row_key", "feature_group", real("attribution"), real("abs_attribution"), big("rank"))


@query(
    "attr_conservation",
    v.ctes(v.TRAIN, VALUES_SQL)
    + f"""SELECT {r('max(abs(a - g))', 'max_abs_diff')} FROM (SELECT row_key, sum(value) AS a FROM vals GROUP BY 1)
  JOIN (SELECT row_key, sum(attribution) AS g FROM grouped GROUP BY 1) USING (row_key)""",
)
def attr_conservation(spark, sf):
    values = _values(spark, sf)
    grouped = at.grouped_values(values, spark.createDataFrame(PIECES, at.GROUP_SCHEMA), "row_key")
    return at.conservation(values, grouped, "row_key").select(real("max_abs_diff"))


@query(
    "probability_rules",
    v.ctes(v.TRAIN) + f"SELECT row_key, {r('1 / (1 + exp(-(score * 8 - 4)))', 'p')}, (1 / (1 + exp(-(score * 8 - 4))) >= 0.5)::INT AS hit, {r('2 * score * danceability / (score + danceability + 1e-8)', 'f1')} FROM train",
)
def probability_rules(spark, sf):
    """Sigmoid, threshold decision and F1 with a small constant."""
    df, p = v.train(spark, sf), sigmoid(F.col("score") * 8 - 4)
    f1 = harmonic_f1(F.col("score"), F.col("danceability"))
    return df.select("row_key", real(p, "p"), (p >= 0.5).cast("int").alias("hit"), real(f1, "f1"))


EXPLAIN = ExplainSettings(max_samples=0)  # all rows


def _net(spark, sf):
    df = _docs(spark, sf)
    run = tr.train_net(df, "doc_id", DOC_COLUMNS)
    return run, pp.training_frame(df, DOC_COLUMNS)[0]


@query("perm_importance")
def perm_importance(spark, sf):
    run, frame = _net(spark, sf)
    return ex.net_importance(run.prepared, run.classifier, frame, "doc_id", "is_hit", EXPLAIN)


@query("ig_attr")
def ig_attr(spark, sf):
    run, frame = _net(spark, sf)
    return ex.net_local(run.prepared, run.classifier, frame, frame, "doc_id", EXPLAIN)[1]


@query("mlp_shap")
def mlp_shap(spark, sf):
    run, _ = _net(spark, sf)
    return ex.net_summary(run, explained=0)


@query("forest_shap")
def forest_shap(spark, sf):
    run = tr.train_forest(_docs(spark, sf), "doc_id", DOC_COLUMNS, ForestSettings(trees=10, depth=5, oversample=False))
    return ex.forest_summary(run)


@query("logreg_shap")
def logreg_shap(spark, sf):
    run = tr.train_linear(v.train(spark, sf), "row_key", LINES, LinearSettings(oversample=False))
    return ex.linear_summary(run, explained=0)


STREAM_SQL = (
    v.ctes(*SONG_CHART)
    + f"""SELECT st AS song_track, sa AS song_artist, {r('max(score)', 'best')}, sum(1 + (rank <= 50)::INT)::BIGINT AS n, min(rank)::DOUBLE AS rank_best, max(weeks_on_chart)::DOUBLE AS weeks_max
  FROM (SELECT *, {v.SCORE} AS score FROM (SELECT DISTINCT st, sa FROM song_keys), (SELECT DISTINCT ct, ca FROM chart_keys)) JOIN chart_keys USING (ct, ca)
  WHERE score >= 0.75::DOUBLE GROUP BY ALL"""
)


def _streamed(spark, sf, files_per_batch):
    """Two charts landed as 52 files out of date order, some entries twice."""
    base = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    landed = settle(v.chart(spark, sf).withColumnsRenamed(
        {"track_name": "title", "artist_name": "artist", "weeks_on_chart": "weeks", "peak_rank": "peakPos", "last_week_rank": "lastPos"}
    ).select("chart_date", "rank", "title", "artist", "weeks", "peakPos", "lastPos"))
    upper = landed.where("rank <= 50").withColumn("chart_name", F.lit("upper"))
    both = landed.withColumn("chart_name", F.lit(None).cast("string")).unionByName(upper)
    both.repartition(40, "chart_date").write.json(f"{base}/landed")
    both.where(F.month("chart_date") == 3).repartition(12, "chart_date").write.mode("append").json(f"{base}/landed")
    keys = m.with_match_key(v.songs(spark, sf)).select(*m.KEY).distinct()
    st.ingest(st.snapshot_stream(spark, f"{base}/landed", files_per_batch=files_per_batch), f"{base}/out", f"{base}/state").awaitTermination()
    found = st.current_aggregates(spark, f"{base}/out", keys)
    return found.select("song_track", "song_artist", real("best"), "n", "rank_best", "weeks_max")


@query("stream_ingest", STREAM_SQL)
def stream_ingest(spark, sf):
    return _streamed(spark, sf, 5)


@query("stream_ingest_by_file", STREAM_SQL)
def stream_ingest_by_file(spark, sf):
    """A batch per file, some fifty."""
    return _streamed(spark, sf, 1)

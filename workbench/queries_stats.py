"""Two-sample tests, metrics, preparation and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from hitloom.operators import hypothesis as hy, metrics as mt
from hitloom.operators.ranking import fixed_sample, with_folds, with_test_flag
from workbench import views as v
from workbench.registry import query, r, real

FEATURES = ["energy", "tempo", "danceability", "valence"]


def _moments_sql(extra):
    one = """SELECT '{c}' AS feature, count(*) FILTER (is_hit = 1 AND {c} IS NOT NULL) AS n1, count(*) FILTER (is_hit = 0 AND {c} IS NOT NULL) AS n0,
    avg({c}) FILTER (is_hit = 1) AS m1, avg({c}) FILTER (is_hit = 0) AS m0, var_samp({c}) FILTER (is_hit = 1) AS v1, var_samp({c}) FILTER (is_hit = 0) AS v0 FROM train"""
    return v.ctes(v.TRAIN, "mo AS (" + " UNION ALL ".join(one.format(c=c) for c in FEATURES) + ")") + extra


@query(
    "welch_t",
    _moments_sql(
        f"SELECT feature, n1 AS n_hit, n0 AS n_miss, {r('(m1 - m0) / sqrt(v1 / n1 + v0 / n0)', 'welch_t_stat')}, "
        + f"{r('pow(v1 / n1 + v0 / n0, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v0 / n0, 2) / (n0 - 1))', 'welch_df', 3)} FROM mo"
    ),
)
def welch_t(spark, sf):
    found = hy.welch(hy.two_sample_moments(v.train(spark, sf), FEATURES))
    return found.select("feature", "n_hit", "n_miss", real("welch_t_stat"), real("welch_df", digits=3))


@query(
    "cohens_d",
    _moments_sql(
        f"SELECT feature, {r('m1', 'mean_hit')}, {r('m0', 'mean_miss')}, {r('m1 - m0', 'diff', 5)}, {r('(m1 - m0) / sqrt(((n1 - 1) * v1 + (n0 - 1) * v0) / (n1 + n0 - 2))', 'cohens_d')} FROM mo"
    ),
)
def cohens_d(spark, sf):
    found = hy.effect_size(hy.two_sample_moments(v.train(spark, sf), FEATURES))
    return found.select(
        "feature", real("mean_hit"), real("mean_miss"), real(F.col("mean_hit") - F.col("mean_miss"), "diff", 5), real("cohens_d")
    )


def _u_sql(c):
    return f"""SELECT '{c}' AS feature, sum(pos * (below + neg / 2.0::DOUBLE)) AS u, sum(pos)::BIGINT AS n1, sum(neg)::BIGINT AS n0
  FROM (SELECT *, coalesce(sum(neg) OVER (ORDER BY {c} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM
    (SELECT {c}, count(*) FILTER (is_hit = 1) AS pos, count(*) FILTER (is_hit = 0) AS neg FROM train WHERE {c} IS NOT NULL GROUP BY 1))"""


U = "us AS (" + " UNION ALL ".join(_u_sql(c) for c in FEATURES) + ")"


@query("mannwhitney_u", v.ctes(v.TRAIN, U) + f"SELECT feature, n1 AS n_pos, n0 AS n_neg, {r('u', 'mannwhitney_u_stat', 1)} FROM us")
def mannwhitney_u(spark, sf):
    return hy.mann_whitney(v.train(spark, sf), FEATURES).select("feature", "n_pos", "n_neg", real("mannwhitney_u_stat", digits=1))


@query(
    "hypothesis_table",
    _moments_sql(
        ", "
        + U
        + f"""SELECT f.feature, CASE WHEN mo.feature IS NULL THEN 'missing_column' ELSE 'ok' END AS status, mo.n1 AS n_hit, mo.n0 AS n_miss,
  {r('m1', 'mean_hit')}, {r('m0', 'mean_miss')}, {r('m1 - m0', 'mean_diff_hit_minus_miss', 5)},
  {r('(m1 - m0) / sqrt(v1 / mo.n1 + v0 / mo.n0)', 'welch_t_stat')}, {r('u', 'mannwhitney_u_stat', 1)},
  {r('(m1 - m0) / sqrt(((mo.n1 - 1) * v1 + (mo.n0 - 1) * v0) / (mo.n1 + mo.n0 - 2))', 'cohens_d')}
FROM (VALUES ('danceability'), ('energy'), ('valence'), ('tempo'), ('loudness')) f(feature) LEFT JOIN mo USING (feature) LEFT JOIN us USING (feature)"""
    ),
)
def hypothesis_table(spark, sf):
    t = hy.hypothesis_table(v.train(spark, sf), p_values=False)
    return t.select(
        "feature", "status", "n_hit", "n_miss", real("mean_hit"), real("mean_miss"), real("mean_diff_hit_minus_miss", digits=5),
        real("welch_t_stat"), real("mannwhitney_u_stat", digits=1), real("cohens_d"),
    )


@query("pvalues")
def pvalues(spark, sf):
    t = hy.hypothesis_table(v.train(spark, sf))
    return t.select("feature", "status", real("welch_t_p_value", digits=9), real("mannwhitney_u_p_value", digits=9))


PRED = "scored AS (SELECT *, (score >= 0.6)::INT AS prediction FROM train)"
COUNTS = """counts AS (SELECT count(*) FILTER (is_hit = 0 AND prediction = 0) AS tn, count(*) FILTER (is_hit = 0 AND prediction = 1) AS fp,
  count(*) FILTER (is_hit = 1 AND prediction = 0) AS fn, count(*) FILTER (is_hit = 1 AND prediction = 1) AS tp FROM scored)"""


def _scored(spark, sf):
    return v.train(spark, sf).withColumn("prediction", (F.col("score") >= 0.6).cast("int"))


@query(
    "confusion",
    v.ctes(v.TRAIN, PRED)
    + "SELECT l.x AS label, p.x AS predicted, (SELECT count(*) FROM scored WHERE is_hit = l.x AND prediction = p.x) AS n FROM (VALUES (0), (1)) l(x), (VALUES (0), (1)) p(x)",
)
def confusion(spark, sf):
    return mt.confusion_cells(_scored(spark, sf))


@query(
    "cls_metrics",
    v.ctes(v.TRAIN, PRED, COUNTS)
    + f"""SELECT {r('(tn + tp) / (tn + fp + fn + tp)', 'accuracy')}, {r('tp / (tp + fp)', 'precision')}, {r('tp / (tp + fn)', 'recall')}, {r('2 * tp / (2 * tp + fp + fn)', 'f1')} FROM counts""",
)
def cls_metrics(spark, sf):
    found = mt.binary_metrics(mt.confusion_counts(_scored(spark, sf)))
    return found.select(real("accuracy"), real("precision"), real("recall"), real("f1"))


@query(
    "cls_report",
    v.ctes(
        v.TRAIN,
        PRED,
        COUNTS,
        """per AS (SELECT '0' AS class, tn / (tn + fn) AS p, tn / (tn + fp) AS q, 2 * tn / (2 * tn + fp + fn) AS f, tn + fp AS s FROM counts
  UNION ALL SELECT '1', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn), tp + fn FROM counts)""",
    )
    + f"""SELECT class, {r('p', 'precision')}, {r('q', 'recall')}, {r('f', 'f1')}, s::BIGINT AS support FROM (SELECT * FROM per
  UNION ALL SELECT 'accuracy', (tn + tp) / (tn + fp + fn + tp), (tn + tp) / (tn + fp + fn + tp), (tn + tp) / (tn + fp + fn + tp), tn + fp + fn + tp FROM counts
  UNION ALL SELECT 'macro avg', avg(p), avg(q), avg(f), sum(s) FROM per
  UNION ALL SELECT 'weighted avg', sum(p * s) / sum(s), sum(q * s) / sum(s), sum(f * s) / sum(s), sum(s) FROM per)""",
)
def cls_report(spark, sf):
    found = mt.class_report(mt.confusion_counts(_scored(spark, sf)))
    return found.select("class", real("precision"), real("recall"), real("f1"), "support")


@query(
    "roc_auc",
    v.ctes(v.TRAIN, "us AS (" + _u_sql("score") + ")") + f"SELECT n1 AS n_pos, n0 AS n_neg, {r('u / (n1::DOUBLE * n0)', 'roc_auc')} FROM us",
)
def roc_auc(spark, sf):
    return mt.roc_auc(v.train(spark, sf), "score").select("n_pos", "n_neg", real("roc_auc"))


CURVE = """cells AS (SELECT score, count(*) FILTER (is_hit = 1) AS pos, count(*) AS n FROM train GROUP BY 1),
cum AS (SELECT score AS threshold, sum(pos) OVER w AS tp, sum(n) OVER w AS k, sum(pos) OVER () AS hits FROM cells WINDOW w AS (ORDER BY score DESC)),
curve AS (SELECT threshold, tp::BIGINT AS tp, (k - tp)::BIGINT AS fp, tp / k AS p, tp / hits AS q, 2 * (tp / k) * (tp / hits) / (tp / k + tp / hits + 1e-8::DOUBLE) AS f1 FROM cum)"""


@query("pr_curve", v.ctes(v.TRAIN, CURVE) + f"SELECT threshold, tp, fp, {r('p', 'precision')}, {r('q', 'recall')}, {r('f1', 'f1')} FROM curve")
def pr_curve(spark, sf):
    c = mt.threshold_curve(v.train(spark, sf), "score")
    return c.select("threshold", "tp", "fp", real("precision"), real("recall"), real("f1"))


@query(
    "pr_best_threshold",
    v.ctes(v.TRAIN, CURVE) + f"SELECT threshold, {r('f1', 'f1')} FROM curve ORDER BY curve.f1 DESC, threshold LIMIT 1",
)
def pr_best_threshold(spark, sf):
    return mt.best_threshold(v.train(spark, sf), "score").select("threshold", real("f1"))


RANKED = """counted AS (SELECT is_hit, count(*) AS n FROM train GROUP BY 1),
quota AS (SELECT is_hit, w + (row_number() OVER (ORDER BY e - w DESC, is_hit) <= d - sum(w) OVER ())::INT AS quota FROM (
  SELECT is_hit, ceil(0.2 * sum(n) OVER ()) AS d, n * ceil(0.2 * sum(n) OVER ()) / sum(n) OVER () AS e, floor(n * ceil(0.2 * sum(n) OVER ()) / sum(n) OVER ()) AS w FROM counted)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY is_hit ORDER BY md5('42_' || row_key)) AS r, count(*) OVER (PARTITION BY is_hit) AS n FROM train)"""


@query("stratified_split", v.ctes(v.TRAIN, RANKED) + "SELECT row_key, is_hit, r <= quota AS is_test FROM ranked JOIN quota USING (is_hit)")
def stratified_split(spark, sf):
    return with_test_flag(v.train(spark, sf), "is_hit", "row_key", 42, 0.2).select("row_key", "is_hit", "is_test")


@query(
    "fold_assign",
    v.ctes(v.TRAIN, RANKED)
    + "SELECT row_key, is_hit, ((r > floor(n * 1 / 5))::INT + (r > floor(n * 2 / 5))::INT + (r > floor(n * 3 / 5))::INT + (r > floor(n * 4 / 5))::INT) AS fold FROM ranked",
)
def fold_assign(spark, sf):
    return with_folds(v.train(spark, sf), "is_hit", "row_key", 42, 5).select("row_key", "is_hit", "fold")


@query("fixed_sample", v.ctes(v.TRAIN) + "SELECT row_key, energy FROM train ORDER BY md5('42_' || row_key), row_key LIMIT 300")
def fixed_sample_(spark, sf):
    return fixed_sample(v.train(spark, sf), 300, "row_key", 42).select("row_key", "energy")

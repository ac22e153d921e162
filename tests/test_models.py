from itertools import permutations

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from hitloom.contracts import ExplainSettings, FeatureContract, ForestSettings, LinearSettings, NetSettings
from hitloom.operators import attribution as at, forest as fo, logistic as lg, network as nw, oversampling as ov, preparation as pp
from hitloom.operators.neighbours import cells_of, cells_within, closest, nearest_neighbours, pivots_of, squares
from hitloom.plans import explaining as ex, scoring as sc, training as tr, tuning as tu
from hitloom.sources import sinks

CONTRACT = FeatureContract(ids=("k",), numeric=("energy", "tempo"), categorical=("genre",))


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(0)
    rows = []
    for k in range(400):
        a, b, g = rng.normal(), rng.normal() * 3 + 1, str(rng.choice(["pop", "pop_rock", "jazz"]))
        y = int(a + 0.3 * b + (g == "pop") + rng.normal() * 0.7 > 1.5)
        rows.append((k, float(a) if k % 9 else None, float(b), g if k % 7 else None, y, f"{2000 + k % 5}-02-03"))
    return spark.createDataFrame(rows, "k int, energy double, tempo double, genre string, is_hit int, release_date string").cache()


def arrays(df):
    return np.array([r.x for r in df.select("x").collect()])


def test_preparation(spark, table):
    prepared = pp.fit_preparation(table, ["energy", "tempo"], ["genre"])
    assert prepared.names == ("num__energy", "num__tempo", "cat__genre_jazz", "cat__genre_pop", "cat__genre_pop_rock")
    assert pp.feature_groups(prepared) == ["energy", "tempo", "genre", "genre", "genre"]
    x = arrays(prepared.transform(table).orderBy("k").select(vector_to_array("features").alias("x")))
    rows = table.orderBy("k").toPandas()
    energy = rows.energy.fillna(np.nanmedian(rows.energy)).to_numpy()
    np.testing.assert_allclose(x[:, 0], (energy - energy.mean()) / energy.std(), atol=1e-9)
    genre = rows.genre.fillna(rows.genre.mode()[0]).to_numpy()
    np.testing.assert_array_equal(x[:, 2:], np.stack([genre == g for g in ("jazz", "pop", "pop_rock")], 1).astype(float))
    new = spark.createDataFrame([(1.0, 2.0, "polka")], "energy double, tempo double, genre string")
    assert arrays(prepared.transform(new).select(vector_to_array("features").alias("x")))[0, 2:].tolist() == [0, 0, 0]
    with pytest.raises(ValueError):
        prepared.transform(new.drop("tempo"))


def test_quotes_in_categories(spark):
    df = spark.createDataFrame([(1.0, "r'n\\b"), (2.0, None), (3.0, "r'n\\b")], "a double, g string")
    prepared = pp.fit_preparation(df, ["a"], ["g"])
    assert arrays(prepared.transform(df).select(vector_to_array("features").alias("x")))[:, 1].tolist() == [1, 1, 1]


def test_training_frame(spark, table):
    with pytest.raises(ValueError):
        pp.training_frame(table.drop("tempo"), CONTRACT)
    frame, numeric, categorical = pp.training_frame(table, CONTRACT)
    assert numeric == ["energy", "tempo", "release_year", "release_month"] and categorical == ["genre"]


def test_logistic_regression_is_the_penalised_optimum(table):
    run = tr.train_linear(table, "k", CONTRACT, LinearSettings(oversample=False, c=0.5))
    train = run.prepared.transform(run.split.train).select(vector_to_array("features").alias("x"), "is_hit").collect()
    x, y = np.array([r.x for r in train]), np.array([r.is_hit for r in train])
    w, b = run.classifier.coefficients.toArray(), run.classifier.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    gradient = 0.5 * x.T @ (p - y) + w  # of C * sum(log loss) + |w|^2 / 2
    assert np.abs(gradient).max() < 2e-2 and abs((p - y).sum()) < 1e-2
    m = run.metrics
    (tn, fp), (fn, tp) = m["confusion_matrix"]
    assert m["n_rows"] == 400 and tn + fp + fn + tp == 80
    assert m["accuracy"] == pytest.approx((tn + tp) / 80) and m["roc_auc"] > 0.8


def test_save_and_load(spark, table, tmp_path):
    run = tr.train_linear(table, "k", CONTRACT, LinearSettings(oversample=False))
    paths = sinks.save_run(spark, str(tmp_path / "lr"), run.model, run.metrics, run.settings)
    frame, _, _ = pp.training_frame(table, CONTRACT)
    again = sinks.load_model(paths["model"]).transform(frame).orderBy("k").select("prediction").collect()
    assert [int(r.prediction) for r in again] == [r.prediction for r in run.score(frame).orderBy("k").collect()]
    assert sinks.read_document(spark, paths["metrics"])["roc_auc"] == run.metrics["roc_auc"]


@pytest.mark.parametrize("pivots,block", [(1, 4096), (9, 16)])
def test_neighbours_are_exact_with_copies(spark, pivots, block):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 6, (150, 2)).astype(float)
    x[:50] = x[0]  # a third of the rows are copies
    df = spark.createDataFrame([(str(i), r.tolist()) for i, r in enumerate(x)], "key string, vec array<double>")
    got = {r.key: np.array(r.near) for r in nearest_neighbours(df, 5, pivots, block).collect()}
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    for i in range(len(x)):
        np.testing.assert_allclose(np.sqrt(((got[str(i)] - x[i]) ** 2).sum(1)), np.sort(d[i])[:5])


def test_neighbours_over_many_cells(spark):
    """More than 1024 cells, clusters of very different density: exact, and most cells are not searched."""
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=(1500, 3)), 0.01 * rng.normal(size=(1500, 3)) + 2])
    df = spark.createDataFrame([(str(i), r.tolist()) for i, r in enumerate(x)], "key string, vec array<double>")
    got = {r.key: np.array(r.near) for r in nearest_neighbours(df, 4, 1300).collect()}
    d = np.sqrt(squares(x, x))
    np.fill_diagonal(d, np.inf)
    for i in range(len(x)):
        np.testing.assert_allclose(np.sqrt(((got[str(i)] - x[i]) ** 2).sum(1)), np.sort(d[i])[:4])


@pytest.mark.parametrize("spread", [1.0, 0.0])
def test_cells_left_out_hold_nothing(spread):
    rng = np.random.default_rng(9)
    x = np.round(spread * rng.normal(size=(800, 2)), 1)
    index = pivots_of(x[:60])
    outer, far, cell, reach = cells_of(x, index)
    np.maximum.at(index.outer_radius, outer, far)
    np.maximum.at(index.inner_radius, cell, reach)
    bound = np.full(len(x), 0.3)
    rows, cells = cells_within(x, bound, index)
    found = set(zip(rows.tolist(), cells.tolist()))
    i, j = np.nonzero(np.sqrt(squares(x, x)) <= 0.3)
    assert set(zip(i.tolist(), cell[j].tolist())) <= found and len(found) <= 800 * 60
    d = squares(x[:50], x)
    qi, xj, dist = closest(x[:50], np.full(50, np.inf), x, 5)
    for row in range(50):
        want = sorted((v, c) for c, v in enumerate(np.sqrt(d[row])))[:5]
        assert [(v, c) for v, c in zip(dist[qi == row], xj[qi == row])] == want


def test_synthetic_rows_lie_between_neighbours(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(90, 3))
    y = [int(i < 20) for i in range(90)]
    df = spark.createDataFrame([(i, r.tolist(), c) for i, (r, c) in enumerate(zip(x, y))], "k int, v array<double>, y int")
    from pyspark.ml.functions import array_to_vector

    rows = df.select("k", "y", array_to_vector("v").alias("features"))
    made = np.array([r.x for r in ov.synthetic_rows(rows, "y", "k", 4, 1).select(vector_to_array("features").alias("x")).collect()])
    assert len(made) == 50
    minority = x[:20]
    d = np.sqrt(((minority[:, None] - minority[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    near = np.argsort(d, 1)[:, :4]
    for point in made:
        found = False
        for i in range(20):
            for j in near[i]:
                step = minority[j] - minority[i]
                u = (point - minority[i]) @ step / (step @ step)
                found |= -1e-9 <= u <= 1 + 1e-9 and np.allclose(minority[i] + u * step, point, atol=1e-9)
        assert found
    sizes = {r.y: r["count"] for r in ov.oversample(rows, "y", "k", 4, 1).groupBy("y").count().collect()}
    assert sizes == {0: 70, 1: 70}


def test_oversampling_plan():
    assert ov.oversampling_plan({0: 10, 1: 1}) == (False, 5)
    assert ov.oversampling_plan({0: 10, 1: 3}) == (True, 2)
    assert ov.oversampling_plan({0: 10, 1: 9}) == (True, 5)
    assert ov.oversampling_plan({0: 10, 1: 9}, k=7) == (True, 7)
    assert ov.oversampling_plan({0: 10, 1: 9}, wanted=False) == (False, 5)


def numeric_gradient(f, x, h=1e-6):
    return np.array([(f(x + h * e) - f(x - h * e)) / (2 * h) for e in np.eye(len(x))])


def test_network_gradients():
    rng = np.random.default_rng(0)
    flat = nw.initial(4, 1)
    x, y = rng.normal(size=(7, 4)), rng.integers(0, 2, 7).astype(float)
    keep = np.ones((7, 32))

    def loss(w):
        p = nw.probabilities(w, x)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    got = nw.loss_gradient(flat, x, y, keep)
    np.testing.assert_allclose(got[::37], numeric_gradient(loss, flat)[::37], atol=1e-6)
    one = nw.input_gradient(flat, x[:1])[0]
    np.testing.assert_allclose(one, numeric_gradient(lambda v: nw.logits(flat, v[None])[0], x[0]), atol=1e-5)


@pytest.fixture(scope="module")
def net_run(table):
    return tr.train_net(table.repartition(2), "k", CONTRACT, NetSettings(epochs=15))


def test_network_learns_and_reloads(spark, table, net_run, tmp_path):
    assert net_run.metrics["roc_auc"] > 0.75
    tr.save_net(spark, str(tmp_path / "net"), net_run)
    prepared, net = tr.load_net(spark, str(tmp_path / "net"))
    frame, _, _ = pp.training_frame(table, CONTRACT)
    a = [r.probability for r in net_run.score(frame).orderBy("k").collect()]
    b = [r.probability for r in tr.score(frame, prepared, net).orderBy("k").collect()]
    assert a == b
    with pytest.raises(ValueError):
        tr.train_net(table, "k", CONTRACT, NetSettings(threshold_on="train"))


def test_single_songs(table, net_run):
    """Lookup, date from the year, month, probability and leading attributions of one song."""
    songs = table.withColumns({"track_name": F.concat(F.lit("Song "), (F.col("k") % 50).cast("string")), "artist_name": F.lit(" The Band ")})
    named = FeatureContract(ids=("track_name", "artist_name"), numeric=("energy", "tempo"), categorical=("genre",))
    one = sc.score_song(songs, net_run.prepared, net_run.classifier, "k", track="song  7", artist="the band", contract=named).collect()
    assert [r.k for r in one] == [7] and one[0].prediction == int(one[0].probability >= net_run.classifier.threshold)
    same = sc.score_song(songs, net_run.prepared, net_run.classifier, "k", row=7, contract=named).first()
    assert same == one[0]
    frame, _, _ = pp.training_frame(table, CONTRACT)
    assert net_run.score(frame.where("k = 7")).first().probability == pytest.approx(same.probability)
    dated = songs.drop("release_date").withColumn("release_year", F.lit(2003))
    assert sc.scoring_rows(dated, named).select("release_month").distinct().collect()[0][0] == 1
    wanted = songs.sparkSession.createDataFrame([("SONG 3", "the band"), ("song 9", "The  Band"), ("nobody", "x")], "track string, artist string")
    batch = sc.score_songs(songs, wanted, net_run.prepared, net_run.classifier, "k", named)
    assert sorted(r.k for r in batch.collect()) == [3, 9]
    top = sc.explain_song(songs, net_run.prepared, net_run.classifier, "k", row=7, contract=named, settings=ExplainSettings(max_samples=0, steps=16, top_k=2)).collect()
    assert [r["rank"] for r in top] == [1, 2]
    for bad in ({"row": 10_000}, {"track": "nobody"}, {}):
        with pytest.raises(ValueError):
            sc.score_song(songs, net_run.prepared, net_run.classifier, "k", contract=named, **bad)
    assert {"audio_feature_columns", "max_audio_missing_frac", "n_rows_dropped_audio_missing"} <= set(net_run.metrics)
    assert set(net_run.metrics["audio_feature_columns"]) == {"energy", "tempo"} and net_run.metrics["n_rows_dropped_audio_missing"] == 0


def test_integrated_gradients_are_complete(table, net_run):
    frame, _, _ = pp.training_frame(table, CONTRACT)
    rows = ex.transformed(frame.where("k < 12"), net_run.prepared, "k")
    net, base = net_run.classifier, np.zeros(net_run.classifier.width)
    valued = rows.select("x", at.integrated_gradients(net, base, 64, F.col("x")).alias("a")).collect()
    for r in valued:
        x = np.array([r.x])
        assert sum(r.a) == pytest.approx(nw.logits(net.weights, x)[0] - nw.logits(net.weights, base[None])[0], abs=0.05)


def test_explanations_of_the_network(spark, table, net_run, tmp_path):
    frame, _, _ = pp.training_frame(table, CONTRACT)
    settings = ExplainSettings(max_samples=100, repeats=3, steps=16, top_k=2)
    paths = ex.explain_net(net_run.prepared, net_run.classifier, frame, frame.where("k in (3, 8)"), "k", "is_hit", str(tmp_path), settings)
    overall = spark.read.option("header", True).csv(paths["global"]).collect()
    assert sorted(int(r["rank"]) for r in overall) == list(range(1, 1 + net_run.classifier.width))
    top = spark.read.option("header", True).csv(paths["local_top"]).collect()
    assert len(top) == 4 and {int(r["rank"]) for r in top} == {1, 2}
    meta = sinks.read_document(spark, paths["metadata"])
    assert meta["n_local_rows"] == 2 and meta["checks"]["max_abs_grouped_sum_diff"] < 1e-9
    with pytest.raises(ValueError):
        ex.net_local(net_run.prepared, net_run.classifier, frame.where("k < 0"), frame, "k", settings)
    summary = ex.net_summary(net_run, explained=30, background=20)
    assert 0 < summary.count() <= 15


@pytest.mark.parametrize("n", [1, 2, 12, 97, 1000])
def test_permutations_are_bijections(spark, n):
    drawn = [at.permutation_of(n, 42, r) for r in range(1, 6)]
    for a, b, size in drawn:
        assert sorted((a * i + b) % size for i in range(n)) == list(range(n))
    a, b, _ = 10**18 - 11, 10**18 - 3, 0
    row = spark.createDataFrame([(10**18 - 1, a, b, 10**18)], "i bigint, a bigint, b bigint, n bigint")
    assert row.select(at.multiplied("i", "a", "b", "n")).first()[0] == (a * (10**18 - 1) + b) % 10**18


def test_shuffle_of_importance_does_not_grow_with_features(spark):
    """The plan has the same exchanges for 2 features as for 40, and the drops are those of a model of one feature."""
    def made(width):
        rows = [(k, k % 2, [float(k % 2)] + [float(k % 7 + w) for w in range(width - 1)]) for k in range(200)]
        df = spark.createDataFrame(rows, "k int, y int, x array<double>")
        names = tuple(f"f{w}" for w in range(width))
        return at.permutation_importance(df, "k", "y", names, lambda x: x[0], 0.5, 3)

    few, many = made(2), made(40)
    count = [df._jdf.queryExecution().executedPlan().toString().count("Exchange") for df in (few, many)]
    assert count[0] == count[1]
    found = {r.feature: r.importance_mean for r in many.collect()}
    assert 0.3 < found["f0"] < 0.7 and all(v == 0 for f, v in found.items() if f != "f0")


def test_importance_broadcasts_no_rows(spark):
    """Rows meet their donors by sorting, however small the rows' files are."""
    df = spark.createDataFrame([(k, k % 2, [float(k % 2), 0.0]) for k in range(50)], "k int, y int, x array<double>")
    found = at.permutation_importance(df, "k", "y", ("f0", "f1"), lambda x: x[0], 0.5, 2)
    found.collect()
    ran = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in ran and "BroadcastHashJoin" not in ran


def test_constant_feature_has_no_permutation_importance(spark):
    df = spark.createDataFrame([(i, int(i % 3 == 0), [1.0, float(i % 3 == 0)]) for i in range(60)], "k int, y int, x array<double>")
    found = at.permutation_importance(df, "k", "y", ("const", "copy"), lambda x: x[1], 0.5, 4)
    rows = {r.feature: r for r in found.collect()}
    assert (rows["const"].importance_mean, rows["const"].importance_std, rows["const"].baseline_f1) == (0.0, 0.0, 1.0)
    assert rows["copy"].importance_mean > 0.3 and rows["copy"]["rank"] == 1


def test_forest_values(spark, table):
    run = tr.train_forest(table, "k", CONTRACT, ForestSettings(trees=4, depth=4, oversample=False))
    forest = fo.leaves(spark, run.classifier)
    ready = run.prepared.transform(run.split.test).limit(20)
    scored = run.classifier.transform(ready).select(vector_to_array("features").alias("x"), vector_to_array("probability")[1].alias("p")).collect()
    x, p = np.array([r.x for r in scored]), np.array([r.p for r in scored])
    rows, background = x[:5], x[5:17]

    def value(row):
        return np.mean([sum(v for f, lo, hi, v in tree if ((row[f] > lo) & (row[f] <= hi)).all()) for tree in forest])

    np.testing.assert_allclose([value(r) for r in x], p, atol=1e-12)
    got = fo.shapley(forest, rows, background)
    np.testing.assert_allclose(got.sum(1), p[:5] - p[5:17].mean(), atol=1e-10)
    # The definition: average gain of a feature over all orders, against every background row.
    used = list(range(x.shape[1]))
    want = np.zeros(len(used))
    orders = list(permutations(used))[::101]
    full = list(permutations(used))
    if len(full) <= 720:
        orders = full
        for z in background[:2]:
            for order in orders:
                mix = z.copy()
                before = value(mix)
                for j in order:
                    mix[j] = rows[0][j]
                    after = value(mix)
                    want[j] += (after - before) / len(orders) / 2
                    before = after
        np.testing.assert_allclose(fo.shapley(forest, rows[:1], background[:2])[0], want, atol=1e-10)
    summary = ex.forest_summary(run, background=20, explained=15, k=3).collect()
    assert len(summary) == 3 and summary[0].mean_abs_shap >= summary[-1].mean_abs_shap


def test_linear_summary(table):
    run = tr.train_linear(table, "k", CONTRACT, LinearSettings(oversample=False))
    rows = ex.linear_summary(run, k=2).collect()
    assert len(rows) == 2 and rows[0].mean_abs_shap >= rows[1].mean_abs_shap > 0


def _newton(x, y, c, passes=60):
    a = np.concatenate([np.ones((len(x), 1)), x], axis=1)
    w, ridge = np.zeros(a.shape[1]), np.append(0, np.full(x.shape[1], 1 / (c * len(x))))
    for _ in range(passes):
        p = 1 / (1 + np.exp(-a @ w))
        w = w - np.linalg.solve((a.T * (p * (1 - p))) @ a / len(a) + np.diag(ridge + 1e-15), a.T @ (p - y) / len(a) + ridge * w)
    return w


def test_candidates_fitted_together(spark):
    """Coefficients of all candidates at once equal those of separate fits, however the rows are partitioned."""
    rng = np.random.default_rng(3)
    rows, parts = [], {}
    for part, width in ((0, 3), (1, 4)):
        x = rng.normal(size=(400, width)) * ([1, 2, 0.2, 1][:width])
        y = (x @ [1, -0.5, 2, 0.3][:width] + rng.normal(size=400) > 0.4).astype(float)
        pick = rng.choice([-1, 3, 5], size=400)
        parts[part] = x, y, pick
        rows += [(v.tolist(), float(t), part, None if p < 0 else int(p)) for v, t, p in zip(x, y, pick)]
    df = spark.createDataFrame(rows, "x array<double>, y double, part int, pick int")
    models = [lg.Candidate(part, pick, c) for part in (0, 1) for pick in (3, 5) for c in (1e-3, 0.1, 1.0, 100.0)]
    models.append(lg.Candidate(7, None, 1.0))  # no rows
    found = lg.fit_many(df.repartition(3), models)
    for m, w in zip(models[:-1], found):
        x, y, pick = parts[m.part]
        use = (pick == -1) | (pick == m.pick)
        np.testing.assert_allclose(w, _newton(x[use], y[use], m.c), atol=1e-6)
    assert found[-1].tolist() == [0.0]
    again = lg.fit_many(df.repartition(8), models)
    for a, b in zip(found, again):
        np.testing.assert_allclose(a, b, atol=1e-6)
    x, y, pick = parts[1]
    tn, fp, fn, tp = lg.confusions(df.where("part = 1"), models[8:9], found[8:9])[0]
    hit = x @ found[8][1:] + found[8][0] > 0
    assert (tn, fp, fn, tp) == tuple(int(((y == a) & (hit == b)).sum()) for a, b in ((0, 0), (0, 1), (1, 0), (1, 1)))
    # Spark's own fit of the same candidate.
    from pyspark.ml.functions import array_to_vector

    own = df.where("part = 0 and pick is null").select(array_to_vector("x").alias("features"), F.col("y").alias("label"))
    model = tr.fit_linear(own, LinearSettings(c=0.1))
    alone = lg.fit_many(df.where("pick is null"), [lg.Candidate(0, None, 0.1)])[0]
    np.testing.assert_allclose([model.intercept, *model.coefficients], alone, atol=1e-4)


def test_network_does_not_depend_on_partitions(table):
    rows = table.select("k", "is_hit", F.array(F.coalesce("energy", F.lit(0.0)), "tempo").alias("x"))
    few = NetSettings(epochs=3)
    nets = [nw.train_network(rows.repartition(n), "k", "x", "is_hit", few) for n in (1, 2, 8)]
    assert len(set(map(tuple, (n.weights for n in nets)))) == 1
    sizes = [len(r.y) for r in nw.sharded(rows, "k", "x", "is_hit").select("y").collect()]
    assert sum(sizes) == 400 and len(sizes) == nw.LEAST_SHARDS


def test_search(table):
    linear = tu.tune_linear(table, "k", CONTRACT, LinearSettings(), tu.Search(2, 2, "roc_auc")).metrics
    assert linear["tuned"] and linear["best_cv_score"] == max(s["score"] for s in linear["search"])
    assert set(linear["best_params"]) == {"c", "neighbours"}
    space = {"trees": (3, 5), "depth": (None, 3), "min_leaf": (1, 4)}
    forest = tu.tune_forest(table, "k", CONTRACT, ForestSettings(oversample=False), tu.Search(2, 2), space).metrics
    assert forest["tune_n_iter"] == 2 and forest["best_params"]["trees"] in (3, 5)
    net = tu.tune_net(table, "k", CONTRACT, NetSettings(), 2, {"epochs": (1, 2), "lr": (0.005,)}).metrics
    assert net["best_score"] == max(c["score"] for c in net["search"])
    with pytest.raises(ValueError):
        tu.tune_linear(table, "k", CONTRACT, search=tu.Search(1, 2, "accuracy"))


def test_search_spaces():
    grid = tu.log_grid(-3, 2, 20)
    assert len(grid) == 20 and grid[0] == pytest.approx(1e-3) and grid[-1] == pytest.approx(100)
    drawn = tu.draw(tu.FOREST_SPACE, 100, 1)
    assert len(drawn) == 48 and len({str(d) for d in drawn}) == 48


def test_report(spark):
    rows = tr.report({"f1": 0.5, "model": "m"}, spark, ("model", "gone", "f1")).orderBy("position").collect()
    assert [(r.metric, r.value) for r in rows] == [("model", "m"), ("f1", "0.5")]

import pytest
from pyspark.sql import functions as F

from hitloom.contracts import ARTIST_CONTRACT, CHART_CONTRACT
from hitloom.operators import coercion as co, eda, filters as fl, hypothesis as hy
from hitloom.sources import sinks, snapshots, tables


def test_read_write_and_choose(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 'say "hi"', 1.5)], "Song string, Artist string, energy double")
    folder = str(tmp_path / "in")
    sinks.write_csv(df, f"{folder}/b.CSV")
    sinks.write_csv(df, f"{folder}/deep/a.csv")
    sinks.write_parquet(df, f"{folder}/t.parquet")
    back = co.canonical_names(tables.read_table(spark, f"{folder}/b.CSV"))
    assert back.columns == ["track_name", "artist_name", "energy"]
    assert tuple(back.first()) == ("a,b", 'say "hi"', "1.5")
    assert tables.read_table(spark, f"{folder}/t.parquet").first().energy == 1.5
    typed = tables.read_csv(spark, f"{folder}/b.CSV", "Song string, Artist string, energy double")
    assert typed.first().energy == 1.5
    with pytest.raises(ValueError):
        tables.read_table(spark, f"{folder}/x.txt")
    with pytest.raises(ValueError):
        tables.read_csv(spark, f"{folder}/t.parquet")
    with pytest.raises(Exception):
        tables.read_table(spark, f"{folder}/gone.csv")
    assert "/b.CSV/" in tables.first_csv(spark, folder)
    assert tables.choose_csv(spark, folder, hint="deep/a.csv").endswith("deep/a.csv")
    with pytest.raises(FileNotFoundError):
        tables.choose_csv(spark, folder, explicit="/no/such.csv")
    sourced = tables.with_source(tables.read_table(spark, f"{folder}/b.CSV"))
    assert "b.CSV" in sourced.first().kaggle_source_csv


def test_documents_and_summary(spark, tmp_path):
    path = sinks.write_document(spark, {"f1": 0.5, "cm": [[1, 2], [3, 4]]}, str(tmp_path / "m"))
    assert sinks.read_document(spark, path) == {"f1": 0.5, "cm": [[1, 2], [3, 4]]}
    df = spark.createDataFrame([(1,), (None,), (0,)], "billboard_matched int")
    assert tuple(eda.run_summary(df).first()) == (3, 1)


def test_landed_snapshots(spark, tmp_path):
    rows = [("2001-01-06", 1, "T", "A", 3, 1, 2), ("2001-01-13", 1, "U", "B", 1, 1, 0)]
    landed = spark.createDataFrame(rows, "chart_date string, rank int, title string, artist string, weeks int, peakPos int, lastPos int")
    for kind in ("json", "csv"):
        path = str(tmp_path / kind)
        landed.write.option("header", True).format(kind).save(path)
        got = snapshots.read_snapshots(spark, path, kind).orderBy("chart_date").collect()
        assert [(r.chart_name, r.track_name, r.weeks_on_chart, r.peak_rank) for r in got] == [("hot-100", "T", 3, 1), ("hot-100", "U", 1, 1)]


def test_alias_order(spark):
    df = spark.createDataFrame([(1, 2, 3)], "title int, `Song ` int, YR int")
    assert co.canonical_names(df).columns == ["title", "track_name", "release_year"]


def test_contracts(spark):
    df = spark.createDataFrame([("t",)], "track_name string")
    assert "missing columns" in co.contract_issues(df, CHART_CONTRACT)[0]
    with pytest.raises(ValueError):
        co.require_columns(df, "track_name", "artist_name")
    charted = spark.createDataFrame([(1, 0.5)], "billboard_matched int, danceability double")
    assert co.detect_contract(charted) is CHART_CONTRACT and co.detect_contract(df) is ARTIST_CONTRACT
    assert co.numeric_choices(charted, CHART_CONTRACT) == ["danceability"]
    assert len(ARTIST_CONTRACT.columns) == 16


def test_labels(spark):
    df = spark.createDataFrame([("1.9",), ("x",), (None,), ("-3",)], "billboard_matched string")
    assert [r.is_hit for r in co.with_label(df).collect()] == [1, 0, 0, 0]
    kept = df.withColumn("is_hit", F.lit(7))
    assert {r.is_hit for r in co.with_label(kept, keep_existing=True).collect()} == {7}
    with pytest.raises(ValueError):
        co.with_label(df.drop("billboard_matched").withColumn("a", F.lit(1)))
    with pytest.raises(ValueError):
        co.test_label(df.drop("billboard_matched").withColumn("a", F.lit(1)))


def test_filters(spark):
    df = spark.createDataFrame([(0, 1990), (1, 2000), (2, None)], "o int, release_year int")
    assert [r.o for r in fl.recent_years(df, 5).collect()] == [1]
    assert fl.recent_years(df, None).count() == 3
    empty = df.withColumn("release_year", F.lit(None).cast("int"))
    assert fl.recent_years(empty, 5).count() == 3
    assert fl.parse_ordinals(" ") == [0] and fl.parse_ordinals("3, 1,3") == [1, 3]
    with pytest.raises(ValueError):
        fl.at_ordinals(df, [0, 9], "o")
    songs = df.withColumns({"track_name": F.lit("A  b"), "artist_name": F.lit("X")})
    assert fl.named_song(songs, "a B", "x ", "o").first().o == 0
    with pytest.raises(ValueError):
        fl.named_song(songs, "nope", None, "o", required=True)


def test_explorers(spark):
    df = spark.createDataFrame([(1.0, 2.0, None, 1), (2.0, 4.0, 1.0, 0), (3.0, 6.0, 1.0, 0)], "a double, b double, c double, is_hit int")
    r = {(x.feature_a, x.feature_b): x["corr"] for x in eda.correlations(df, ["a", "b", "c"]).collect()}
    assert r["a", "b"] == 1.0 and r["a", "c"] is None and len(r) == 9
    flat = eda.class_histogram(df.withColumn("a", F.lit(5.0)), "a")
    assert {(x.bin, x.is_hit): x.n for x in flat.collect()} == {(1, 1): 1, (1, 0): 2}
    profile = {x.column: (x.nulls, x.rows) for x in eda.null_profile(df).collect()}
    assert profile["c"] == (1, 3)
    twice = df.union(df.limit(1))
    assert tuple(eda.duplicate_count(twice).first()) == (1, 4)


def test_hypothesis_table(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (1, 2.0, None), (0, 3.0, 1.0), (0, 5.0, 2.0)], "is_hit int, energy double, tempo double")
    rows = {r.feature: r for r in hy.hypothesis_table(df, ["energy", "tempo", "gone"]).collect()}
    assert rows["gone"].status == "missing_column" and rows["gone"].n_hit is None
    assert rows["tempo"].status == "insufficient_samples" and (rows["tempo"].n_hit, rows["tempo"].n_miss) == (1, 2)
    e = rows["energy"]
    assert (e.status, e.mean_hit, e.mean_miss, e.mannwhitney_u_stat) == ("ok", 1.5, 4.0, 0.0)
    # t = -2.5 / sqrt(0.25 + 1), df = 1.25^2 / (0.25^2 + 1)
    assert e.welch_t_stat == pytest.approx(-2.23606797749979)
    assert e.cohens_d == pytest.approx(-2.5 / (1.25**0.5))
    assert 0 < e.welch_t_p_value < 1 and 0 < e.mannwhitney_u_p_value < 1

import random

import pytest
from pyspark.sql import functions as F

from hitloom.operators import charts, matching as m

LEVELS = (0.01, 0.12, 0.3, 0.42, 0.54, 0.7, 0.72, 0.75, 0.82, 1.0)


def score(a, b):
    """The definition, pair by pair."""
    if not a[0] or not b[0]:
        return 0.0
    grade = lambda x, y, inside: 1.0 if x == y else inside if x in y or y in x else 0.0
    track = grade(a[0], b[0], 0.6)
    artist = grade(a[1], b[1], 0.4) if a[1] and b[1] else 0.0
    return 0.7 * track + 0.3 * artist


def words(rng):
    parts = ["a", "ab", "abc", "love", "the love", "love the", "b", "xy", "the"]
    return " ".join(rng.choice(parts) for _ in range(rng.randint(0, 3)))


@pytest.fixture(scope="module")
def keys(spark):
    rng = random.Random(7)
    songs = sorted({(words(rng), words(rng)) for _ in range(120)})
    titles = sorted({(words(rng), words(rng)) for _ in range(90)})
    schema = "track_norm string, artist_norm string"
    return songs, titles, spark.createDataFrame(songs, schema).cache(), spark.createDataFrame(titles, schema).cache()


@pytest.mark.parametrize("threshold", LEVELS)
def test_pairs_equal_all_pairs(keys, threshold):
    songs, titles, s, c = keys
    want = sorted((*a, *b, round(score(a, b), 9)) for a in songs for b in titles if score(a, b) >= threshold)
    got = sorted((*r[:4], round(r.score, 9)) for r in m.match_pairs(s, c, threshold).collect())
    assert got == want


def test_zero_threshold_is_refused(keys):
    with pytest.raises(ValueError):
        m.match_pairs(keys[2], keys[3], 0.0)


def test_best_song(spark, keys):
    songs, titles, _, c = keys
    order = list(range(len(songs)))
    random.Random(3).shuffle(order)
    numbered = dict(zip(songs, order))
    s = spark.createDataFrame([(*k, n) for k, n in numbered.items()], "track_norm string, artist_norm string, song_ord bigint")
    want = {}
    for t in titles:
        best = max(songs, key=lambda a: (score(a, t), -numbered[a]))
        want[t] = (round(score(best, t), 9), numbered[best])
    got = {(r.chart_track, r.chart_artist): (round(r.score, 9), r.song_ord) for r in m.best_song(s, c).collect()}
    assert got == want


def test_best_song_without_songs(spark, keys):
    none = spark.createDataFrame([], "track_norm string, artist_norm string, song_ord bigint")
    rows = m.best_song(none, keys[3].limit(3)).collect()
    assert {(r.score, r.song_ord) for r in rows} == {(-1.0, None)}


ENTRY = "track_name string, artist_name string, rank bigint, weeks_on_chart bigint, peak_rank bigint, last_week_rank bigint, chart_date string, date_ord bigint, row_ord bigint"


def test_song_hits_fields_and_repeats(spark):
    songs = spark.createDataFrame(
        [(1, "Song A (feat. B)", "X"), (2, "Song A (feat. B)", "X"), (3, "song a", None), (4, "Other", "Y")],
        "song_ord bigint, track_name string, artist_name string",
    )
    entries = spark.createDataFrame(
        [
            ("SONG A", "X", 5, 0, None, 7, "w2", 2, 5),
            ("Song-A", "X & Z", 3, 9, 2, 0, "w1", 1, 3),
            ("song a", "x", 5, 4, 0, 1, "w1", 1, 5),
            ("song a", "x", None, None, 4, 1, "w3", 3, 9),
        ],
        ENTRY,
    )
    once = {r.song_ord: r.asDict() for r in charts.song_hits(songs, entries, source="s.csv").collect()}
    hit = once[1]
    assert (hit["copies"], hit["billboard_snapshots_matched"], hit["billboard_matched"]) == (2, 4, 1)
    assert (hit["billboard_rank_best"], hit["billboard_rank_worst"]) == (3.0, 999.0)
    assert (hit["billboard_peak_rank_best"], hit["billboard_weeks_on_chart_max"]) == (2.0, 9.0)
    # Equal score and rank: the earlier snapshot leads, and its raw fields are kept.
    assert hit["billboard_chart_date_primary"] == "w1" and hit["billboard_peak_rank_primary"] == 0
    assert hit["kaggle_source_csv"] == "s.csv"
    assert once[3]["billboard_matched"] is None and once[3]["kaggle_source_csv"] is None
    assert (once[4]["billboard_matched"], once[4]["billboard_snapshots_matched"], once[4]["billboard_rank_best"]) == (0, 0, None)
    rows = charts.song_hits(songs, entries, repeats="rows")
    assert {r.song_ord: r["count"] for r in rows.groupBy("song_ord").count().collect()} == {1: 2, 2: 2, 3: 1, 4: 1}
    with pytest.raises(ValueError):
        charts.song_hits(songs, entries, repeats="twice")


def test_song_hits_do_not_depend_on_partitions(spark):
    songs = spark.createDataFrame([(i, f"t{i % 40}", f"a{i % 3}") for i in range(400)], "song_ord bigint, track_name string, artist_name string")
    entries = spark.createDataFrame([(f"t{i % 60}", f"a{i % 4}", i % 7 + 1, i % 5, i % 3, 0, f"w{i}", i, 1) for i in range(200)], ENTRY)
    first = charts.song_hits(songs, entries).orderBy("song_ord").collect()
    again = charts.song_hits(songs.repartition(5, F.rand(3)), entries.repartition(7)).orderBy("song_ord").collect()
    assert first == again


def test_chart_features_below_threshold_keep_score(spark):
    songs = spark.createDataFrame([(1, "alpha", "x", 0.5)], "song_ord bigint, track_name string, artist_name string, energy double")
    entries = spark.createDataFrame(
        [("alpha", "x", 1, 1, 1, 1, "w", 1, 1), ("alpha", "q", 200, 1, 1, 1, "w", 1, 2), ("zzz", "q", None, 1, 1, 1, "w", 1, 3)], ENTRY
    )
    rows = {r.row_ord: r for r in charts.chart_features(songs, entries, 0.75, "f.csv").collect()}
    assert (rows[1].kaggle_match_score, rows[1].energy, rows[1].is_hit) == (1.0, 0.5, 1)
    assert (rows[2].kaggle_match_score, rows[2].energy, rows[2].track_name_kaggle, rows[2].is_hit) == (0.7, None, None, 0)
    assert (rows[3].kaggle_match_score, rows[3].is_hit, rows[3].kaggle_csv) == (0.0, None, "f.csv")


def test_songs_need_title_and_artist(spark):
    from hitloom.operators.charts import chart_features, song_hits

    songs = spark.createDataFrame([("Blue", 1)], "track_name string, song_ord long")
    for plan in (song_hits, chart_features):
        with pytest.raises(ValueError, match="artist_name"):
            plan(songs, songs)

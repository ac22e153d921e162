"""Matching, chart aggregates and exploration."""

from __future__ import annotations

from pyspark.sql import functions as F

from hitloom.operators import charts, eda, matching as m
from hitloom.functions.calendar import on_sampling
from hitloom.operators.coercion import with_label, with_minutes
from hitloom.operators.ranking import mid_ranks, top_per_group
from hitloom.session import settle
from workbench import views as v
from workbench.registry import big, query, r, real

SONG_CHART = (v.SONGS, v.CHART, v.KEYED)


@query(
    "match_score",
    v.ctes(*SONG_CHART)
    + f"SELECT DISTINCT st, sa, ct, ca, {r(v.SCORE, 'score')} FROM song_keys JOIN chart_keys ON sa = ca",
)
def match_score(spark, sf):
    """Scores of all key pairs that share an artist."""
    s = m.with_match_key(v.songs(spark, sf)).select(F.col("track_norm").alias("st"), F.col("artist_norm").alias("sa")).distinct()
    c = m.with_match_key(v.chart(spark, sf)).select(F.col("track_norm").alias("ct"), F.col("artist_norm").alias("ca")).distinct()
    pairs = s.join(c, F.col("sa") == F.col("ca"))
    return pairs.withColumn("score", real(m.pair_score(F.col("st"), F.col("sa"), F.col("ct"), F.col("ca")), "score"))


def _fuzzy(threshold):
    def run(spark, sf):
        names = m.with_match_key(v.songs(spark, sf)).select(*m.KEY).distinct()
        titles = m.with_match_key(v.chart(spark, sf)).select(*m.KEY).distinct()
        pairs = m.match_pairs(settle(names), settle(titles), threshold)
        return pairs.select(*m.PAIR, real("score"))

    return run


def _fuzzy_sql(threshold):
    return v.ctes(*SONG_CHART) + f"""SELECT st AS song_track, sa AS song_artist, ct AS chart_track, ca AS chart_artist, {r('score', 'score')}
FROM (SELECT *, {v.SCORE} AS score FROM (SELECT DISTINCT st, sa FROM song_keys), (SELECT DISTINCT ct, ca FROM chart_keys)) WHERE score >= {threshold}::DOUBLE"""


query("fuzzy_all_75", _fuzzy_sql(0.75))(_fuzzy(0.75))
query("fuzzy_all_42", _fuzzy_sql(0.42))(_fuzzy(0.42))


@query(
    "fuzzy_best",
    v.ctes(*SONG_CHART)
    + f""", keys AS (SELECT DISTINCT ct, ca FROM chart_keys), firsts AS (SELECT st, sa, min(song_ord) AS song_ord FROM song_keys GROUP BY ALL),
best AS (SELECT ct, ca, score, song_ord FROM (SELECT *, {v.SCORE} AS score FROM keys, firsts)
  QUALIFY row_number() OVER (PARTITION BY ct, ca ORDER BY score DESC, song_ord) = 1)
SELECT c.chart_date, c.row_ord, {r('best.score', 'kaggle_match_score')},
  CASE WHEN best.score >= 0.75 THEN s.track_name END AS track_name_kaggle, CASE WHEN best.score >= 0.75 THEN s.artist_name END AS artist_name_kaggle,
  CASE WHEN best.score >= 0.75 THEN s.energy END AS energy, CASE WHEN best.score >= 0.75 THEN s.tempo END AS tempo, (c.rank <= 100)::BIGINT AS is_hit, 'songs' AS kaggle_csv
FROM chart_keys c JOIN best USING (ct, ca) JOIN songs s USING (song_ord)""",
)
def fuzzy_best(spark, sf):
    found = charts.chart_features(v.songs(spark, sf), v.chart(spark, sf), 0.75, "songs")
    return found.select(
        "chart_date", "row_ord", real("kaggle_match_score"), "track_name_kaggle", "artist_name_kaggle", "energy", "tempo", "is_hit", "kaggle_csv"
    )


# Scores of distinct keys; entries and songs meet through those that reach the threshold.
AGG = f"""pairs AS (
  SELECT * FROM (SELECT *, {v.SCORE} AS score FROM (SELECT DISTINCT st, sa FROM song_keys), (SELECT DISTINCT ct, ca FROM chart_keys))
  WHERE score >= 0.75::DOUBLE),
hits AS (
  SELECT song_ord, max(score) AS billboard_match_score_best, count(*) AS billboard_snapshots_matched,
    min(rank999) AS billboard_rank_best, max(rank999) AS billboard_rank_worst, min(peak999) AS billboard_peak_rank_best,
    max(weeks0) AS billboard_weeks_on_chart_max,
    first(struct_pack(rank := rank, weeks := weeks_on_chart, peak := peak_rank, last := last_week_rank, day := chart_date)
      ORDER BY score DESC, rank999, date_ord, row_ord) AS lead
  FROM (SELECT s.song_ord, c.*, score,
      CASE WHEN coalesce(c.rank, 0) = 0 THEN 999 ELSE c.rank END::DOUBLE AS rank999,
      CASE WHEN coalesce(c.peak_rank, 0) = 0 THEN 999 ELSE c.peak_rank END::DOUBLE AS peak999,
      coalesce(c.weeks_on_chart, 0)::DOUBLE AS weeks0
    FROM song_keys s JOIN pairs USING (st, sa) JOIN chart_keys c USING (ct, ca)) GROUP BY song_ord),
matches AS (
  SELECT track_name, artist_name, 'songs' AS kaggle_source_csv, h.* EXCLUDE (song_ord, billboard_snapshots_matched),
    (h.song_ord IS NOT NULL)::BIGINT AS billboard_matched, coalesce(h.billboard_snapshots_matched, 0) AS billboard_snapshots_matched
  FROM songs LEFT JOIN hits h USING (song_ord))"""


@query(
    "chart_agg",
    v.ctes(*SONG_CHART, AGG)
    + f"""SELECT DISTINCT track_name, artist_name, {r('billboard_match_score_best', 'score_best')}, billboard_matched, billboard_snapshots_matched,
  billboard_rank_best, billboard_rank_worst, billboard_peak_rank_best, billboard_weeks_on_chart_max FROM matches WHERE track_name IS NOT NULL AND artist_name IS NOT NULL""",
)
def chart_agg(spark, sf):
    hits = charts.song_hits(v.songs(spark, sf), v.chart(spark, sf)).dropna(subset=["track_name", "artist_name"])
    return hits.select(
        "track_name", "artist_name", real("billboard_match_score_best", "score_best"), "billboard_matched", "billboard_snapshots_matched",
        "billboard_rank_best", "billboard_rank_worst", "billboard_peak_rank_best", "billboard_weeks_on_chart_max",
    ).distinct()


@query(
    "primary_match",
    v.ctes(*SONG_CHART, AGG)
    + """SELECT DISTINCT track_name, artist_name, lead.rank AS billboard_rank_primary, lead.weeks AS billboard_weeks_on_chart_primary,
  lead.peak AS billboard_peak_rank_primary, lead.last AS billboard_last_week_rank_primary, lead.day AS billboard_chart_date_primary
  FROM matches WHERE billboard_matched = 1 AND track_name IS NOT NULL AND artist_name IS NOT NULL""",
)
def primary_match(spark, sf):
    hits = charts.song_hits(v.songs(spark, sf), v.chart(spark, sf)).where("billboard_matched = 1")
    return hits.select(
        "track_name", "artist_name", "billboard_rank_primary", "billboard_weeks_on_chart_primary",
        "billboard_peak_rank_primary", "billboard_last_week_rank_primary", "billboard_chart_date_primary",
    ).distinct()


@query(
    "left_merge_fanout",
    v.ctes(*SONG_CHART, AGG)
    + """SELECT k.song_ord, k.track_name, k.artist_name, m.kaggle_source_csv, m.billboard_matched, m.billboard_snapshots_matched, m.billboard_rank_best
  FROM songs k LEFT JOIN matches m ON k.track_name = m.track_name AND k.artist_name = m.artist_name""",
)
def left_merge_fanout(spark, sf):
    hits = charts.song_hits(v.songs(spark, sf), v.chart(spark, sf), source="songs", repeats="rows")
    return hits.select(
        "song_ord", "track_name", "artist_name", "kaggle_source_csv", "billboard_matched", "billboard_snapshots_matched", "billboard_rank_best"
    )


@query(
    "run_summary",
    v.ctes(*SONG_CHART, AGG)
    + """SELECT count(*) AS rows, count(*) FILTER (coalesce(m.billboard_matched, 0) = 1) AS matched
  FROM songs k LEFT JOIN matches m ON k.track_name = m.track_name AND k.artist_name = m.artist_name""",
)
def run_summary(spark, sf):
    hits = charts.song_hits(v.songs(spark, sf), v.chart(spark, sf), repeats="rows")
    return eda.run_summary(hits)


@query(
    "hit_rate_by_year",
    v.ctes(v.SONGS, v.CHART, v.KEYED.replace("FROM chart)", "FROM chart WHERE day(chart_date) <= 7)"), AGG)
    + f"""SELECT release_year::BIGINT AS release_year, count(*) AS n, sum(coalesce(m.billboard_matched, 0))::BIGINT AS hits, {r('avg(coalesce(m.billboard_matched, 0))', 'hit_rate')}
  FROM songs k LEFT JOIN matches m ON k.track_name = m.track_name AND k.artist_name = m.artist_name GROUP BY release_year""",
)
def hit_rate_by_year(spark, sf):
    """Songs matched to the monthly chart snapshots; share of hits per release year."""
    monthly = v.chart(spark, sf).where(on_sampling(F.col("chart_date"), "monthly"))
    hits = charts.song_hits(v.songs(spark, sf), monthly)
    return eda.rate_by_year(with_label(hits), weight="copies").select(
        big("release_year"), "n", "hits", real("hit_rate")
    )


@query(
    "hist_by_class",
    v.ctes(v.TRAIN)
    + """SELECT least(floor((tempo - lo) / ((hi - lo) / 25.0::DOUBLE)) + 1, 25)::BIGINT AS bin, is_hit::BIGINT AS is_hit, count(*) AS n
  FROM train, (SELECT min(tempo) AS lo, max(tempo) AS hi FROM train) GROUP BY ALL""",
)
def hist_by_class(spark, sf):
    return eda.class_histogram(v.train(spark, sf), "tempo").select("bin", big("is_hit"), "n")


NUMERIC = ["energy", "tempo", "danceability", "valence"]


@query(
    "corr_matrix",
    v.ctes(v.TRAIN, "wide AS (SELECT *, 1.0::DOUBLE AS loudness FROM train)")
    + " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{c}' AS feature_b, "
        + (f"round_even(corr({a}, {c}), 2)" if "loudness" not in (a, c) else "max(CASE WHEN FALSE THEN loudness END)")
        + " + 0.0::DOUBLE AS corr FROM wide"
        for a in NUMERIC + ["loudness"]
        for c in NUMERIC + ["loudness"]
    ),
)
def corr_matrix(spark, sf):
    """A constant column has no correlation, not an error."""
    df = v.train(spark, sf).withColumn("loudness", F.lit(1.0))
    found = eda.correlations(df, NUMERIC + ["loudness"])
    return found.select("feature_a", "feature_b", (F.col("corr") + F.lit(0.0)).alias("corr"))


@query("scatter", v.ctes(v.TRAIN) + "SELECT danceability AS x, energy AS y, is_hit, genre, release_date FROM train")
def scatter(spark, sf):
    found = eda.scatter(v.train(spark, sf))
    return found.withColumn("release_date", F.col("release_date").cast("timestamp_ntz"))


@query("value_counts", v.ctes(v.SONGS) + "SELECT artist_name, count(*) AS count FROM songs WHERE artist_name IS NOT NULL GROUP BY 1")
def value_counts(spark, sf):
    return eda.value_counts(v.songs(spark, sf), "artist_name")


@query("value_counts2", v.ctes(v.SONGS) + "SELECT track_name, spotify_popularity, count(*) AS count FROM songs GROUP BY 1, 2")
def value_counts2(spark, sf):
    return eda.value_counts(v.songs(spark, sf), "track_name", "spotify_popularity")


@query(
    "sum_by_group",
    v.ctes(v.SONGS)
    + "SELECT artist_name, sum(spotify_popularity)::BIGINT AS popularity FROM songs WHERE artist_name IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20",
)
def sum_by_group(spark, sf):
    totals = eda.total_by(v.songs(spark, sf), "artist_name", "spotify_popularity", "popularity")
    return eda.top(totals, 20, F.col("popularity").desc(), "artist_name")


@query("duration_by_year", v.ctes(v.SONGS) + f"SELECT release_year::BIGINT AS release_year, {r('sum(duration_ms / 60000.0::DOUBLE)', 'minutes')} FROM songs GROUP BY 1")
def duration_by_year(spark, sf):
    minutes = eda.total_by(with_minutes(v.songs(spark, sf)), "release_year", "duration_min", "minutes")
    return minutes.select(big("release_year"), real("minutes"))


@query(
    "hist_of_sums",
    "SELECT total, count(*) AS count FROM (SELECT o_custkey, count(*) AS total FROM orders GROUP BY 1) GROUP BY 1 ORDER BY 1 DESC LIMIT 50",
)
def hist_of_sums(spark, sf):
    orders = v.table(spark, sf, "orders").withColumn("one", F.lit(1))
    return eda.histogram_of_totals(orders, "o_custkey", "one")


@query(
    "shares",
    """WITH sizes AS (SELECT o_custkey, count(*) AS count FROM orders GROUP BY 1), best AS (SELECT * FROM sizes ORDER BY count DESC, o_custkey LIMIT 50)
SELECT (SELECT sum(count) FROM best)::BIGINT AS top_rows, sum(count)::BIGINT AS all_rows, (sum(count) - (SELECT sum(count) FROM best))::BIGINT AS other_rows,
  (SELECT count(*) FROM best) AS top_groups, count(*) - (SELECT count(*) FROM best) AS other_groups FROM sizes""",
)
def shares(spark, sf):
    return eda.top_share(v.table(spark, sf, "orders"), "o_custkey", 50)


@query(
    "single_shares",
    """SELECT count(*) FILTER (c = 1) AS single, count(*) FILTER (c > 1) AS several, count(*) AS groups
FROM (SELECT count(*) AS c FROM orders GROUP BY o_custkey)""",
)
def single_shares(spark, sf):
    return eda.singles_share(v.table(spark, sf, "orders"), "o_custkey")


@query(
    "describe",
    v.ctes(v.TRAIN)
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, count({c}) AS count, {r(f'avg({c})', 'mean', 4)}, {r(f'stddev_samp({c})', 'std', 4)}, min({c}) AS min,
  {r(f'quantile_cont({c}, 0.25)', 'q25', 4)}, {r(f'quantile_cont({c}, 0.5)', 'q50', 4)}, {r(f'quantile_cont({c}, 0.75)', 'q75', 4)}, max({c}) AS max FROM train"""
        for c in NUMERIC
    ),
)
def describe(spark, sf):
    found = eda.describe(v.train(spark, sf), NUMERIC)
    rounded = [real(c, digits=4) for c in ("mean", "std", "q25", "q50", "q75")]
    return found.select("feature", "count", "min", "max", *rounded)


@query(
    "null_profile",
    v.ctes(v.SONGS)
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column, count(*) FILTER ({c} IS NULL) AS nulls, count(*) AS rows FROM songs"
        for c in ("song_ord", "track_name", "artist_name", "release_year", "genre", "danceability", "energy", "tempo", "spotify_popularity", "duration_ms")
    ),
)
def null_profile(spark, sf):
    return eda.null_profile(v.songs(spark, sf)).select("column", "nulls", "rows")


DUP = "SELECT p_name, p_brand, CASE WHEN p_size > 25 THEN p_size END AS p_size FROM part"


@query("dup_count", f"SELECT (count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM ({DUP}))))::BIGINT AS duplicates, count(*) AS rows FROM ({DUP})")
def dup_count(spark, sf):
    p = v.table(spark, sf, "part")
    return eda.duplicate_count(p.select("p_name", "p_brand", F.when(F.col("p_size") > 25, F.col("p_size")).alias("p_size")))


@query("distinct_rows", "SELECT DISTINCT p_name, p_brand, p_type FROM part")
def distinct_rows(spark, sf):
    return v.table(spark, sf, "part").select("p_name", "p_brand", "p_type").dropDuplicates()


@query("class_counts", v.ctes(v.TRAIN) + "SELECT is_hit, count(*) AS n FROM train GROUP BY 1")
def class_counts(spark, sf):
    return eda.class_counts(v.train(spark, sf))


@query("mid_rank", "SELECT l_quantity AS value, n, (lo + hi) / 2.0::DOUBLE AS mid_rank FROM (SELECT l_quantity, count(*) AS n, min(rn) AS lo, max(rn) AS hi FROM (SELECT l_quantity, row_number() OVER (ORDER BY l_quantity) AS rn FROM lineitem) GROUP BY 1)")
def mid_rank(spark, sf):
    return mid_ranks(v.table(spark, sf, "lineitem"), "l_quantity")


@query(
    "rank_first",
    v.ctes(v.SONGS)
    + "SELECT genre, song_ord, rank FROM (SELECT genre, song_ord, row_number() OVER (PARTITION BY genre ORDER BY danceability DESC, song_ord) AS rank FROM songs) WHERE rank <= 15",
)
def rank_first(spark, sf):
    top = top_per_group(v.songs(spark, sf), ["genre"], F.col("danceability").desc(), ["song_ord"], 15)
    return top.select("genre", "song_ord", big("rank"))

"""Sources, names, types, labels, filters and text rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from hitloom.contracts import CHART_CONTRACT
from hitloom.functions import calendar as cal
from hitloom.functions import text as tx
from hitloom.functions.numeric import or_default
from hitloom.operators import charts, coercion as co, filters as fl, matching as m
from hitloom.sources import snapshots, tables
from workbench import views as v
from workbench.registry import b, big, query, r, real

SPEC = CHART_CONTRACT


@query("scan_songs", f"SELECT {b('p_partkey', 'part_key')}, p_name, {b('p_size', 'p_size')} FROM part")
def scan_songs(spark, sf):
    parts = tables.read_table(spark, f"{sf}/part.parquet")
    return parts.select(big("p_partkey", "part_key"), "p_name", big("p_size"))


@query(
    "alias_rename",
    v.ctes(v.SONGS) + "SELECT song_ord, track_name, artist_name, release_year::BIGINT AS release_year, spotify_popularity FROM songs",
)
def alias_rename(spark, sf):
    raw = v.songs(spark, sf).withColumnsRenamed(
        {"track_name": " Song ", "artist_name": "ARTIST", "release_year": "Yr", "spotify_popularity": "popularity"}
    )
    return co.canonical_names(raw).select(
        "song_ord", "track_name", "artist_name", big("release_year"), "spotify_popularity"
    )


TEXTED = """texted AS (SELECT song_ord, CASE song_ord % 3 WHEN 0 THEN ' ' || tempo::VARCHAR || ' ' WHEN 1 THEN 'n/a' ELSE tempo::VARCHAR END AS tempo_text,
  CASE WHEN song_ord % 4 = 0 THEN '0.5' WHEN song_ord % 4 = 1 THEN '1' WHEN song_ord % 4 = 2 THEN 'x' ELSE '0' END AS label_text,
  CASE WHEN song_ord % 2 = 0 THEN release_year::VARCHAR || '-03-01' ELSE 'soon' END AS date_text FROM songs)"""


def _texted(spark, sf):
    s, o = v.songs(spark, sf), F.col("song_ord")
    tempo = F.format_string("%.1f", "tempo")
    return s.select(
        "song_ord",
        F.when(o % 3 == 0, F.concat(F.lit(" "), tempo, F.lit(" "))).when(o % 3 == 1, F.lit("n/a")).otherwise(tempo).alias("tempo"),
        F.when(o % 4 == 0, "0.5").when(o % 4 == 1, "1").when(o % 4 == 2, "x").otherwise("0").alias("is_hit"),
        F.when(o % 2 == 0, F.concat(F.col("release_year").cast("string"), F.lit("-03-01"))).otherwise("soon").alias("release_date"),
    )


@query(
    "coerce_types",
    v.ctes(v.SONGS, TEXTED)
    + f"""SELECT song_ord, {r('try_cast(trim(tempo_text) AS DOUBLE)', 'tempo', 1)},
  CASE WHEN try_cast(label_text AS DOUBLE) = floor(try_cast(label_text AS DOUBLE)) THEN try_cast(label_text AS DOUBLE)::BIGINT END AS is_hit,
  try_cast(date_text AS TIMESTAMP) AS release_date FROM texted""",
)
def coerce_types(spark, sf):
    return co.coerce(_texted(spark, sf), SPEC).select(
        "song_ord", real("tempo", digits=1), "is_hit", F.col("release_date").cast("timestamp_ntz").alias("release_date")
    )


FLAGGED = "flagged AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN 'bad' ELSE (o_totalprice / 100000.0::DOUBLE)::VARCHAR END AS billboard_matched, 1990 + o_custkey % 300 AS release_year FROM orders)"


def _flagged(spark, sf):
    o = v.table(spark, sf, "orders")
    key = F.col("o_orderkey")
    return o.select(
        "o_orderkey",
        F.when(key % 5 == 0, F.lit(None)).when(key % 5 == 1, "bad").otherwise((F.col("o_totalprice") / 100000.0).cast("string")).alias("billboard_matched"),
        (F.lit(1990) + F.col("o_custkey") % 300).alias("release_year"),
    )


@query(
    "derive_label",
    v.ctes(FLAGGED)
    + """SELECT o_orderkey, greatest(0, least(1, trunc(coalesce(try_cast(billboard_matched AS DOUBLE), 0))))::BIGINT AS is_hit,
  CASE WHEN release_year BETWEEN 1678 AND 2262 THEN make_date(release_year::BIGINT, 1, 1) END AS release_date FROM flagged""",
)
def derive_label(spark, sf):
    return co.with_label(_flagged(spark, sf)).select("o_orderkey", big("is_hit"), "release_date")


@query(
    "derive_label_if_absent",
    v.ctes(FLAGGED)
    + """SELECT o_orderkey, (o_orderkey % 2)::INTEGER AS is_hit, CASE WHEN release_year BETWEEN 1678 AND 2262 THEN make_date(release_year::BIGINT, 1, 1) END AS release_date FROM flagged""",
)
def derive_label_if_absent(spark, sf):
    """A label that is there stays, whatever the match flag says; the date is still made."""
    labelled = _flagged(spark, sf).withColumn("is_hit", (F.col("o_orderkey") % 2).cast("int"))
    return co.with_label(labelled, keep_existing=True).select("o_orderkey", "is_hit", "release_date")


@query(
    "derive_label_clip",
    v.ctes(FLAGGED)
    + "SELECT o_orderkey, CASE WHEN try_cast(billboard_matched AS DOUBLE) IS NOT NULL THEN least(greatest(try_cast(billboard_matched AS DOUBLE), 0), 1) END AS y FROM flagged",
)
def derive_label_clip(spark, sf):
    df = _flagged(spark, sf)
    return df.select("o_orderkey", co.test_label(df).alias("y"))


@query(
    "synth_date",
    v.ctes(v.SONGS)
    + "SELECT song_ord, CASE WHEN song_ord % 13 <> 0 THEN make_date(release_year::BIGINT, 1, 1) END AS release_date FROM songs",
)
def synth_date(spark, sf):
    s = v.songs(spark, sf)
    year = F.when(F.col("song_ord") % 13 != 0, F.col("release_year").cast("string")).otherwise("unknown")
    return co.with_release_date(s.select("song_ord", year.alias("release_year"))).select("song_ord", "release_date")


@query(
    "time_features",
    v.ctes(v.TRAIN)
    + f"SELECT row_key, {b('year(release_date)', 'release_year')}, {b('month(release_date)', 'release_month')}, {b('isodow(release_date) - 1', 'release_dow')} FROM train",
)
def time_features(spark, sf):
    df = co.with_time_features(v.train(spark, sf), SPEC, weekday=True)
    return df.select("row_key", big("release_year"), big("release_month"), big("release_dow"))


@query(
    "scoring_month",
    v.ctes(v.TRAIN) + f"SELECT row_key, 1900::BIGINT AS release_year, {b('month(release_date)', 'release_month')} FROM train",
)
def scoring_month(spark, sf):
    df = v.train(spark, sf).withColumn("release_year", F.lit(1900))
    return co.with_scoring_month(df, SPEC).select("row_key", big("release_year"), big("release_month"))


@query(
    "chart_casts",
    v.ctes(v.CHART)
    + """SELECT chart_date, row_ord, 'billboard_hot_100_appearance' AS hit_definition, (rank <= 100)::BIGINT AS is_hit,
  rank::DOUBLE AS chart_rank, weeks_on_chart::DOUBLE AS chart_weeks_on, peak_rank::DOUBLE AS chart_peak_rank,
  last_week_rank::DOUBLE AS chart_last_week_rank FROM chart""",
)
def chart_casts(spark, sf):
    return charts.chart_casts(v.chart(spark, sf)).select(
        "chart_date", "row_ord", "hit_definition", "is_hit", "chart_rank", "chart_weeks_on", "chart_peak_rank", "chart_last_week_rank"
    )


@query(
    "bulk_rename",
    v.ctes(v.SONGS)
    + 'SELECT song_ord, genre AS "Genre", danceability AS "Danceability", energy AS "Energy", tempo AS "Tempo", duration_ms AS "Duration_MS" FROM songs',
)
def bulk_rename(spark, sf):
    return co.display_names(v.songs(spark, sf)).select("song_ord", "Genre", "Danceability", "Energy", "Tempo", "Duration_MS")


@query("duration_min", v.ctes(v.SONGS) + f"SELECT song_ord, {r('duration_ms / 60000.0::DOUBLE', 'duration_min')} FROM songs")
def duration_min(spark, sf):
    return co.with_minutes(v.songs(spark, sf)).select("song_ord", real("duration_min"))


@query("label_scheme", v.ctes(v.TRAIN) + f"SELECT row_key, {b('is_hit', 'label01')}, {b('CASE WHEN is_hit = 1 THEN 1 ELSE 2 END', 'label12')} FROM train")
def label_scheme(spark, sf):
    y = F.col("is_hit")
    return v.train(spark, sf).select("row_key", big(co.label_view(y), "label01"), big(co.label_view(y, "12"), "label12"))


@query(
    "recent_window",
    v.ctes(v.TRAIN)
    + "SELECT row_key, year(release_date)::BIGINT AS release_year FROM train WHERE year(release_date) >= (SELECT max(year(release_date)) FROM train) - 3",
)
def recent_window(spark, sf):
    df = co.with_time_features(v.train(spark, sf), SPEC)
    return fl.recent_years(df, 3).select("row_key", big("release_year"))


@query(
    "audio_missing",
    v.ctes(v.SONGS)
    + "SELECT song_ord, energy, danceability FROM songs WHERE ((energy IS NULL)::INT + (danceability IS NULL)::INT + (tempo IS NULL)::INT) / 3.0::DOUBLE <= 0.3",
)
def audio_missing(spark, sf):
    return fl.audio_complete(v.songs(spark, sf), 0.3).select("song_ord", "energy", "danceability")


@query(
    "audio_missing_count",
    v.ctes(v.SONGS) + "SELECT count(*) FILTER (energy IS NULL) AS n_rows_dropped_audio_missing FROM songs",
)
def audio_missing_count(spark, sf):
    return fl.audio_dropped(v.songs(spark, sf), 0.3)


@query("complete_case", v.ctes(v.TRAIN) + "SELECT row_key, valence, energy FROM train WHERE valence IS NOT NULL AND is_hit IS NOT NULL")
def complete_case(spark, sf):
    return v.train(spark, sf).dropna(subset=["valence", "is_hit"]).select("row_key", "valence", "energy")


@query("threshold_filter", v.ctes(v.SONGS) + "SELECT song_ord, track_name, spotify_popularity FROM songs WHERE spotify_popularity >= 45")
def threshold_filter(spark, sf):
    return v.songs(spark, sf).where("spotify_popularity >= 45").select("song_ord", "track_name", "spotify_popularity")


@query(
    "one_song_artists",
    "SELECT o_custkey AS artist, 1::BIGINT AS songs FROM orders GROUP BY o_custkey HAVING count(*) = 1",
)
def one_song_artists(spark, sf):
    from hitloom.operators.eda import value_counts

    counts = value_counts(v.table(spark, sf, "orders"), "o_custkey")
    return counts.where("count = 1").select(F.col("o_custkey").alias("artist"), F.col("count").alias("songs"))


def lookup_sql(c: str) -> str:
    return f"trim(regexp_replace(lower(coalesce({c}, '')), '\\s+', ' ', 'g'))"


@query(
    "lookup_name",
    v.ctes(v.SONGS)
    + f"""SELECT c.c_custkey, min(s.song_ord) AS song_ord FROM (SELECT c_custkey, lower(p_name) || '  ' AS track, ' Brand#' || (c_custkey % 25 + 1) AS artist
    FROM customer JOIN part ON c_custkey = p_partkey) c
  JOIN songs s ON {lookup_sql('c.track')} = {lookup_sql('s.track_name')} AND {lookup_sql('c.artist')} = {lookup_sql('s.artist_name')} GROUP BY 1""",
)
def lookup_name(spark, sf):
    c = v.table(spark, sf, "customer")
    p = v.table(spark, sf, "part").select(F.col("p_partkey").alias("c_custkey"), "p_name")
    asked = c.join(p, "c_custkey").select(
        "c_custkey",
        F.concat(F.lower("p_name"), F.lit("  ")).alias("track"),
        F.concat(F.lit(" Brand#"), (F.col("c_custkey") % 25 + 1).cast("string")).alias("artist"),
    )
    return fl.named_songs(v.songs(spark, sf), asked, "song_ord").select("c_custkey", "song_ord")


@query(
    "lookup_first_song",
    v.ctes(v.SONGS)
    + f"SELECT song_ord, track_name, artist_name FROM songs WHERE {lookup_sql('track_name')} = 'small ring' ORDER BY song_ord LIMIT 1",
)
def lookup_first_song(spark, sf):
    return fl.named_song(v.songs(spark, sf), " Small  RING", None, "song_ord").select("song_ord", "track_name", "artist_name")


@query("lookup_rows", v.ctes(v.SONGS) + "SELECT song_ord, track_name FROM songs WHERE song_ord IN (0, 2, 5)")
def lookup_rows(spark, sf):
    return fl.at_ordinals(v.songs(spark, sf), fl.parse_ordinals("5, 0,2,2"), "song_ord").select("song_ord", "track_name")


@query("normalize_text", v.ctes(v.SONGS) + f"SELECT song_ord, {v.norm_sql('track_name')} AS track_norm, {v.norm_sql('artist_name')} AS artist_norm FROM songs")
def normalize_text(spark, sf):
    return m.with_match_key(v.songs(spark, sf)).select("song_ord", "track_norm", "artist_norm")


@query("lookup_norm", f"SELECT c_custkey, {lookup_sql('upper(c_name) || chr(9) || c_mktsegment')} AS name FROM customer")
def lookup_norm(spark, sf):
    text = F.concat(F.upper("c_name"), F.lit("\t"), F.col("c_mktsegment"))
    return v.table(spark, sf, "customer").select("c_custkey", tx.lookup_text(text).alias("name"))


@query(
    "blank_or_zero",
    v.ctes(v.CHART) + "SELECT chart_date, row_ord, CASE WHEN coalesce(last_week_rank, 0) = 0 THEN 999.0::DOUBLE ELSE last_week_rank::DOUBLE END AS rank_or_999 FROM chart",
)
def blank_or_zero(spark, sf):
    return v.chart(spark, sf).select("chart_date", "row_ord", or_default(F.col("last_week_rank"), 999).alias("rank_or_999"))


YEARS = "years AS (SELECT DISTINCT year(o_orderdate)::BIGINT AS y FROM orders)"


def _years(spark, sf):
    return v.table(spark, sf, "orders").select(F.year("o_orderdate").alias("y")).distinct()


def _saturday(day: str) -> str:
    return f"({day}) + ((6 - dayofweek({day}) + 7) % 7)::INTEGER"


@query("sat_yearly", v.ctes(YEARS) + f"SELECT CAST({_saturday('make_date(y, 6, 15)')} AS DATE) AS chart_date FROM years")
def sat_yearly(spark, sf):
    return cal.calendar_of_years(_years(spark, sf), "yearly").select("chart_date")


@query("sat_monthly", v.ctes(YEARS) + f"SELECT CAST({_saturday('make_date(y, mm, 1)')} AS DATE) AS chart_date FROM years, range(1, 13) t(mm)")
def sat_monthly(spark, sf):
    return cal.calendar_of_years(_years(spark, sf), "monthly").select("chart_date")


@query(
    "sat_weekly",
    v.ctes(YEARS) + "SELECT d::DATE AS chart_date FROM (SELECT unnest(generate_series(make_date(y, 1, 1)::TIMESTAMP, make_date(y, 12, 31)::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM years) WHERE dayofweek(d) = 6",
)
def sat_weekly(spark, sf):
    return cal.calendar_of_years(_years(spark, sf), "weekly").select("chart_date")


@query(
    "parse_dates",
    """SELECT o_orderkey, unnest(list_filter(list_transform(string_split(replace(strftime(o_orderdate, '%Y-%m-%d') || ' ; ' || o_orderpriority || ', ,' || o_orderstatus, ';', ','), ','), lambda x: trim(x)), lambda x: x <> '')) AS item FROM orders""",
)
def parse_dates(spark, sf):
    o = v.table(spark, sf, "orders")
    text = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" ; "), F.col("o_orderpriority"), F.lit(", ,"), F.col("o_orderstatus"))
    return o.select("o_orderkey", F.explode(tx.listed_values(text)).alias("item"))


@query(
    "snapshots_union",
    v.ctes(v.CHART)
    + "SELECT chart_date, row_ord, track_name, artist_name, rank FROM chart WHERE day(chart_date) <= 7",
)
def snapshots_union(spark, sf):
    """Snapshots of the monthly calendar of the charted years, in (date, row) order columns."""
    entries = v.chart(spark, sf)
    years = entries.select(F.year("chart_date").alias("y")).distinct()
    wanted = cal.calendar_of_years(years, "monthly")
    return snapshots.on_calendar(entries, wanted).select("chart_date", "row_ord", "track_name", "artist_name", "rank")


@query(
    "snapshot_fields",
    v.ctes(v.CHART) + "SELECT 'hot-100' AS chart_name, chart_date, rank, track_name, artist_name, weeks_on_chart, peak_rank, last_week_rank FROM chart",
)
def snapshot_fields(spark, sf):
    landed = v.chart(spark, sf).withColumnsRenamed(
        {"track_name": "title", "artist_name": "artist", "weeks_on_chart": "weeks", "peak_rank": "peakPos", "last_week_rank": "lastPos"}
    )
    return snapshots.entry_columns(landed.drop("chart_name", "date_ord", "row_ord"))


@query(
    "sql_view_join",
    v.ctes(v.SONGS) + "SELECT genre, count(*) AS n, sum(spotify_popularity)::BIGINT AS popularity FROM songs GROUP BY genre",
)
def sql_view_join(spark, sf):
    return tables.sql(
        spark, "SELECT genre, count(*) AS n, sum(spotify_popularity) AS popularity FROM {songs} GROUP BY genre", songs=v.songs(spark, sf)
    )

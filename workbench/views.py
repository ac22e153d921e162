"""Song, chart and training views derived from the test tables.

Spark views come as functions of (spark, folder); DuckDB views as CTE text. Both say the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hitloom.functions.calendar import week_ending
from hitloom.sources.tables import dealt

LINE_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def songs(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as songs: names in five spellings, some NULLs, many repeated (track, artist)."""
    p = table(spark, folder, "part")
    key, name, brand = F.col("p_partkey"), F.col("p_name"), F.col("p_brand")
    track = (
        F.when(key % 5 == 0, F.upper(name))
        .when(key % 5 == 1, F.concat(name, F.lit(" (feat. "), brand, F.lit(")")))
        .when(key % 5 == 2, F.replace(name, F.lit(" "), F.lit("-")))
        .when(key % 5 == 3, F.concat(name, F.lit(" remix")))
        .otherwise(name)
    )
    return p.select(
        key.alias("song_ord"),
        track.alias("track_name"),
        F.when(key % 97 != 0, brand).alias("artist_name"),
        (F.lit(1995) + key % 7).cast("int").alias("release_year"),
        F.col("p_type").alias("genre"),
        ((key * 37 % 101) / F.lit(100.0)).alias("danceability"),
        F.when(key % 11 != 0, F.col("p_size").cast("double")).alias("energy"),
        F.col("p_retailprice").alias("tempo"),
        F.col("p_size").cast("bigint").alias("spotify_popularity"),
        (F.lit(120000) + key * 7919 % 240000).alias("duration_ms"),
    )


def chart(spark: SparkSession, folder: str) -> DataFrame:
    """Weekly chart of (part name, brand) by quantity shipped."""
    lines = table(spark, folder, "lineitem").select("l_partkey", "l_shipdate", "l_quantity")
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand")
    weekly = (
        lines.withColumn("chart_date", week_ending(F.col("l_shipdate")))
        .groupBy("chart_date", "l_partkey")
        .agg(F.sum("l_quantity").alias("q"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("chart_date", "p_name", "p_brand")
        .agg(F.sum("q").alias("q"))
    )
    week = Window.partitionBy("chart_date").orderBy(F.col("q").desc(), "p_name", "p_brand")
    top = weekly.withColumn("rank", F.row_number().over(week))
    run = Window.partitionBy("p_name", "p_brand").orderBy("chart_date")
    upto = run.rowsBetween(Window.unboundedPreceding, 0)
    last_week = F.lag("chart_date").over(run) == F.date_sub("chart_date", 7)
    return top.select(
        F.lit("hot-100").alias("chart_name"),
        "chart_date",
        F.unix_date("chart_date").cast("bigint").alias("date_ord"),
        F.col("rank").cast("bigint").alias("row_ord"),
        F.col("rank").cast("bigint").alias("rank"),
        F.col("p_name").alias("track_name"),
        F.col("p_brand").alias("artist_name"),
        F.count(F.lit(1)).over(upto).alias("weeks_on_chart"),
        F.min("rank").over(upto).cast("bigint").alias("peak_rank"),
        F.when(last_week, F.lag("rank").over(run)).otherwise(0).cast("bigint").alias("last_week_rank"),
    )


def train(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as a training table: label, four numerics, two categories, a date, a key."""
    l = dealt(table(spark, folder, "lineitem"), *LINE_KEY)
    hole = (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 11 == 0
    return l.select(
        F.concat_ws("-", *[F.col(c).cast("string") for c in LINE_KEY]).alias("row_key"),
        (F.col("l_returnflag") == "R").cast("int").alias("is_hit"),
        F.col("l_quantity").alias("energy"),
        F.col("l_extendedprice").alias("tempo"),
        F.col("l_discount").alias("danceability"),
        F.when(~hole, F.col("l_tax")).alias("valence"),
        F.col("l_linestatus").alias("genre"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_shipdate").alias("release_date"),
        (
            ((F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729) % 1000) / F.lit(1000.0)
        ).alias("score"),
    )


def docs(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a partial label."""
    d = table(spark, folder, "documents")
    return d.join(table(spark, folder, "labels"), "doc_id", "left").select(
        "doc_id",
        F.coalesce("quality", F.lit(0)).alias("is_hit"),
        F.col("quality").alias("raw_label"),
        F.col("n_chars").cast("double").alias("energy"),
        F.length("text").cast("double").alias("tempo"),
        F.col("lang").alias("genre"),
        F.col("source").alias("artist_name"),
    )


SONGS = """songs AS (
  SELECT p_partkey AS song_ord,
    CASE p_partkey % 5 WHEN 0 THEN upper(p_name) WHEN 1 THEN p_name || ' (feat. ' || p_brand || ')'
      WHEN 2 THEN replace(p_name, ' ', '-') WHEN 3 THEN p_name || ' remix' ELSE p_name END AS track_name,
    CASE WHEN p_partkey % 97 <> 0 THEN p_brand END AS artist_name,
    CAST(1995 + p_partkey % 7 AS INTEGER) AS release_year, p_type AS genre,
    (p_partkey * 37 % 101) / 100.0::DOUBLE AS danceability,
    CASE WHEN p_partkey % 11 <> 0 THEN p_size::DOUBLE END AS energy,
    p_retailprice AS tempo, p_size::BIGINT AS spotify_popularity,
    120000 + p_partkey * 7919 % 240000 AS duration_ms
  FROM part)"""

CHART = """weekly AS (
  SELECT CAST(l_shipdate AS DATE) + CAST((6 - dayofweek(CAST(l_shipdate AS DATE))) AS INTEGER) AS chart_date,
    p_name, p_brand, sum(l_quantity) AS q
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY chart_date ORDER BY q DESC, p_name, p_brand) AS rank FROM weekly),
chart AS (
  SELECT 'hot-100' AS chart_name, CAST(chart_date AS DATE) AS chart_date,
    date_diff('day', DATE '1970-01-01', CAST(chart_date AS DATE)) AS date_ord, rank AS row_ord, rank,
    p_name AS track_name, p_brand AS artist_name,
    count(*) OVER upto AS weeks_on_chart, min(rank) OVER upto AS peak_rank,
    CASE WHEN lag(chart_date) OVER run = CAST(chart_date AS DATE) - 7 THEN lag(rank) OVER run ELSE 0 END AS last_week_rank
  FROM ranked
  WINDOW run AS (PARTITION BY p_name, p_brand ORDER BY chart_date),
    upto AS (PARTITION BY p_name, p_brand ORDER BY chart_date ROWS UNBOUNDED PRECEDING))"""

TRAIN = """train AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_key,
    CAST(l_returnflag = 'R' AS INTEGER) AS is_hit, l_quantity AS energy, l_extendedprice AS tempo,
    l_discount AS danceability,
    CASE WHEN (l_orderkey * 7 + l_linenumber) % 11 <> 0 THEN l_tax END AS valence,
    l_linestatus AS genre, l_returnflag AS flag, l_shipdate AS release_date,
    ((l_orderkey * 7919 + l_linenumber * 104729) % 1000) / 1000.0::DOUBLE AS score
  FROM lineitem)"""


def norm_sql(column: str) -> str:
    """Match text of a column, in DuckDB."""
    low = f"lower(coalesce({column}, ''))"
    cut = f"regexp_replace({low}, '\\b(ft|feat|featuring)\\b.*$', '')"
    words = f"regexp_replace({cut}, '[^a-z0-9\\s]', ' ', 'g')"
    return f"trim(regexp_replace({words}, '\\s+', ' ', 'g'))"


KEYED = f"""song_keys AS (
  SELECT *, {norm_sql('track_name')} AS st, {norm_sql('artist_name')} AS sa FROM songs),
chart_keys AS (
  SELECT *, {norm_sql('track_name')} AS ct, {norm_sql('artist_name')} AS ca FROM chart)"""

SCORE = """CASE WHEN st = '' OR ct = '' THEN 0.0::DOUBLE ELSE
    0.7::DOUBLE * CASE WHEN st = ct THEN 1.0::DOUBLE WHEN contains(st, ct) OR contains(ct, st) THEN 0.6::DOUBLE ELSE 0.0::DOUBLE END
  + 0.3::DOUBLE * CASE WHEN sa <> '' AND sa = ca THEN 1.0::DOUBLE
      WHEN sa <> '' AND ca <> '' AND (contains(sa, ca) OR contains(ca, sa)) THEN 0.4::DOUBLE ELSE 0.0::DOUBLE END END"""


def ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"

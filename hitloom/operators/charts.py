"""Chart aggregates per song and song features per chart entry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.contracts import AUDIO_COLUMNS, CHART_FEATURE_LITERAL, MATCH_THRESHOLD
from hitloom.functions.numeric import lenient_double, or_default
from hitloom.operators.coercion import require_columns
from hitloom.operators.matching import KEY, best_song, match_pairs, with_match_key
from hitloom.operators.skew import salted_join
from hitloom.session import settle

# Stand-ins for a missing rank and missing weeks, and the output names.
NO_RANK, NO_WEEKS = 999, 0
ENTRY_FIELDS = ("rank", "weeks_on_chart", "peak_rank", "last_week_rank", "chart_date")
HIT_COLUMNS = (
    "billboard_match_score_best",
    "billboard_matched",
    "billboard_snapshots_matched",
    "billboard_rank_best",
    "billboard_rank_worst",
    "billboard_peak_rank_best",
    "billboard_weeks_on_chart_max",
    "billboard_rank_primary",
    "billboard_weeks_on_chart_primary",
    "billboard_peak_rank_primary",
    "billboard_last_week_rank_primary",
    "billboard_chart_date_primary",
)
RAW = ["track_name", "artist_name"]


def entry_summaries(
    entries: DataFrame, count: Column | None = None, weeks: str = "weeks_on_chart", peak: str = "peak_rank"
) -> DataFrame:
    """Chart entries folded to one row per normalised key.

    The fold keeps what song aggregates need: the number of entries, extremes, and the leading
    entry (lowest rank, then earliest by ``date_ord``, ``row_ord``). ``count`` says how often a row
    counts (default: once), ``weeks`` and ``peak`` name the columns of the extremes.
    """
    keyed = with_match_key(entries)
    rank = or_default(F.col("rank"), NO_RANK)
    lead = F.struct(rank.alias("r"), "date_ord", "row_ord", *ENTRY_FIELDS)
    return keyed.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n") if count is None else F.sum(count).alias("n"),
        F.min(rank).alias("rank_best"),
        F.max(rank).alias("rank_worst"),
        F.min(or_default(F.col(peak), NO_RANK)).alias("peak_best"),
        F.max(or_default(F.col(weeks), NO_WEEKS)).alias("weeks_max"),
        F.min(lead).alias("lead"),
    )


def key_aggregates(song_keys: DataFrame, charted: DataFrame, threshold: float) -> DataFrame:
    """Chart aggregates of every distinct song key with at least one match."""
    pairs = match_pairs(song_keys, charted.select(*KEY), threshold)
    sides = pairs.withColumnsRenamed({"chart_track": "track_norm", "chart_artist": "artist_norm"})
    first = F.min(F.struct((-F.col("score")).alias("s"), "lead")).alias("first")
    return sides.join(charted, KEY).groupBy("song_track", "song_artist").agg(
        F.max("score").alias("best"),
        F.sum("n").alias("n"),
        F.min("rank_best").alias("rank_best"),
        F.max("rank_worst").alias("rank_worst"),
        F.min("peak_best").alias("peak_best"),
        F.max("weeks_max").alias("weeks_max"),
        first,
    )


def song_names(songs: DataFrame) -> DataFrame:
    """Distinct raw names of the songs with their match key and number of rows."""
    return with_match_key(songs.groupBy(*RAW).agg(F.count(F.lit(1)).alias("copies")))


def name_lookup(names: DataFrame, charted: DataFrame, threshold: float) -> DataFrame:
    """Chart aggregates per raw (track_name, artist_name)."""
    aggregates = key_aggregates(settle(names.select(*KEY).distinct()), charted, threshold)
    # A song without a usable title matches nothing; its key would only crowd one task.
    usable = F.when(F.col("track_norm") != "", F.col("track_norm"))
    joined = names.withColumn("song_track", usable).join(
        aggregates.withColumnRenamed("song_artist", "artist_norm"), ["song_track", "artist_norm"], "left"
    )
    lead = F.col("first.lead")
    values = (
        F.col("best"),
        F.col("best").isNotNull().cast("bigint"),
        F.coalesce("n", F.lit(0)).cast("bigint"),
        F.col("rank_best"),
        F.col("rank_worst"),
        F.col("peak_best"),
        F.col("weeks_max"),
        lead["rank"],
        lead["weeks_on_chart"],
        lead["peak_rank"],
        lead["last_week_rank"],
        lead["chart_date"],
    )
    return joined.select(*RAW, "copies", *[v.alias(n) for n, v in zip(HIT_COLUMNS, values)])


def song_hits(
    songs: DataFrame,
    entries: DataFrame,
    threshold: float = MATCH_THRESHOLD,
    source: str | None = None,
    repeats: str = "once",
) -> DataFrame:
    """Songs with their chart aggregates and 0/1 match flag.

    Songs join to aggregates by raw names, so a song without both names gets NULLs. A
    (track, artist) pair that m song rows share joins to m equal aggregate rows in the
    row-to-row join this table is defined by. ``repeats="once"`` keeps one output row per song
    and says m in ``copies``; ``repeats="rows"`` emits the m rows. They are made by repeating
    the joined row, never by pairing the rows of a group.
    """
    if repeats not in ("once", "rows"):
        raise ValueError(f"repeats is 'once' or 'rows', not {repeats!r}")
    require_columns(songs, *RAW)
    names, charted = settle(song_names(songs)), settle(entry_summaries(entries))
    known = name_lookup(names.dropna(subset=RAW), charted, threshold)
    sizes = names.select(*RAW, F.col("copies").alias("n"))
    hits = salted_join(songs, known, RAW, "left", sizes=sizes)
    hits = hits.withColumn("copies", F.coalesce("copies", F.lit(1)))
    if source is not None:
        found = F.when(F.col("billboard_matched").isNotNull(), F.lit(source))
        hits = hits.withColumn("kaggle_source_csv", found)
    if repeats == "once":
        return hits
    again = F.sequence(F.lit(1).cast("bigint"), F.col("copies"))
    return hits.withColumn("_n", F.explode(again)).drop("_n", "copies")


def chart_casts(entries: DataFrame) -> DataFrame:
    """Label and numeric chart columns of chart entries."""
    rank = lenient_double(F.col("rank"))
    return entries.withColumns(
        {
            "hit_definition": F.lit(CHART_FEATURE_LITERAL),
            "is_hit": F.when(rank.isNotNull(), (rank <= 100).cast("bigint")),
            "chart_rank": rank,
            "chart_weeks_on": lenient_double(F.col("weeks_on_chart")),
            "chart_peak_rank": lenient_double(F.col("peak_rank")),
            "chart_last_week_rank": lenient_double(F.col("last_week_rank")),
        }
    )


def best_matches(songs: DataFrame, entries: DataFrame) -> DataFrame:
    """Chart entries with the score and ordinal of their best song (N:1)."""
    per_key = with_match_key(songs).groupBy(*KEY).agg(F.min("song_ord").alias("song_ord"))
    keyed = settle(with_match_key(entries))  # read for its keys, their counts and its rows
    best = best_song(settle(per_key), settle(keyed.select(*KEY).distinct()))
    named = best.withColumnsRenamed(
        {"chart_track": "track_norm", "chart_artist": "artist_norm", "score": "kaggle_match_score"}
    )
    return salted_join(keyed, named, KEY, "left").drop(*KEY)


def chart_features(
    songs: DataFrame,
    entries: DataFrame,
    threshold: float = MATCH_THRESHOLD,
    source: str | None = None,
) -> DataFrame:
    """Chart entries with the audio columns of their best song, if it scores enough.

    The best score stays on every row; an entry below the threshold keeps chart columns only.
    """
    require_columns(songs, *RAW)
    audio = [c for c in AUDIO_COLUMNS if c in songs.columns]
    payload = songs.select(
        "song_ord",
        F.col("track_name").alias("track_name_kaggle"),
        F.col("artist_name").alias("artist_name_kaggle"),
        *audio,
    )
    # Written once: the join below reads it for its hot keys, their total and its rows.
    matched = settle(best_matches(songs, entries).withColumn(
        "song_ord", F.when(F.col("kaggle_match_score") >= threshold, F.col("song_ord"))
    ))
    joined = salted_join(matched, payload, ["song_ord"], "left").drop("song_ord")
    if source is not None:
        joined = joined.withColumn("kaggle_csv", F.lit(source))
    return chart_casts(joined)

"""Score-threshold joins between songs and chart entries.

A pair scores 0.7 per track plus 0.3 per artist, where equal text counts 1, text inside the
other text counts 0.6 (track) or 0.4 (artist). Only nine scores exist, so a threshold selects a
few kinds of pair, and each kind is an equi-join: on the text itself, or on a part that the
contained text and the containing text must share. Both sides are reduced to distinct keys
first; no kind produces a candidate that the next filter rejects wholesale.

A text inside another one is looked up by its longest prefix on a ladder of lengths (powers of
two) among the other's substrings of those lengths, which is at least half of it, so that few
candidates fail the final test. A plan depends on the threshold only, never on sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.functions.text import holds, ladder_parts, ladder_prefix, match_text
from hitloom.operators.skew import salted_join
from hitloom.session import settle

# Weights and grades of the match score.
TRACK_WEIGHT, ARTIST_WEIGHT = 0.7, 0.3
TRACK_INSIDE, ARTIST_INSIDE = 0.6, 0.4

KEY = ["track_norm", "artist_norm"]


def with_match_key(df: DataFrame, track: str = "track_name", artist: str = "artist_name") -> DataFrame:
    """Add the normalised text pair that songs and entries are matched on."""
    return df.withColumns(
        {"track_norm": match_text(F.col(track)), "artist_norm": match_text(F.col(artist))}
    )


def pair_score(a_track: Column, a_artist: Column, b_track: Column, b_artist: Column) -> Column:
    """Score of two keys; 0 when either has no track."""
    track_inside = holds(a_track, b_track) | holds(b_track, a_track)
    artist_inside = holds(a_artist, b_artist) | holds(b_artist, a_artist)
    track = F.when(a_track == b_track, 1.0).when(track_inside, TRACK_INSIDE).otherwise(0.0)
    artist = (
        F.when((a_artist != "") & (a_artist == b_artist), 1.0)
        .when(artist_inside, ARTIST_INSIDE)
        .otherwise(0.0)
    )
    usable = (a_track != "") & (b_track != "")
    return F.when(usable, F.lit(TRACK_WEIGHT) * track + F.lit(ARTIST_WEIGHT) * artist).otherwise(0.0)


def containments(left: DataFrame, right: DataFrame, text: str, same: list[str]) -> DataFrame:
    """Pairs of texts of which one lies strictly inside the other: (*same, l_text, r_text).

    Both inputs are distinct on ``same + [text]``; pairs agree on ``same``.
    """
    inside = _inside(left, right, text, same)
    around = _inside(right, left, text, same)
    return inside.select(*same, F.col("inner").alias("l_text"), F.col("outer").alias("r_text")).union(
        around.select(*same, F.col("outer").alias("l_text"), F.col("inner").alias("r_text"))
    )


def _inside(inner: DataFrame, outer: DataFrame, text: str, same: list[str], carried: tuple[str, ...] = ()) -> DataFrame:
    """Pairs (inner, outer) with ``inner`` strictly inside ``outer``, with columns of either side that are ``carried``.

    A substring that many outer texts share makes a skewed partition, which adaptive execution splits.
    """
    own = F.col(text)
    needles = inner.where(own != "").select(
        *same, own.alias("inner"), ladder_prefix(own).alias("part"), *[c for c in carried if c in inner.columns]
    )
    hay = outer.where(own != "").select(
        *same, own.alias("outer"), F.explode(ladder_parts(own)).alias("part"), *[c for c in carried if c in outer.columns]
    )
    found = hay.join(needles, [*same, "part"])
    return found.where(F.contains("outer", "inner") & (F.col("outer") != F.col("inner"))).select(*same, "inner", "outer", *carried)


def first_related(songs: DataFrame, texts: DataFrame, text: str) -> DataFrame:
    """For each of ``texts`` the least ``song_ord`` of the songs whose text holds it or lies in it.

    Both are distinct on ``text``. What a join finds is folded at once in the task that finds it, so a
    word that a million titles hold sends one row per task.
    """
    first = F.min("song_ord").alias("song_ord")
    held = _inside(texts, songs, text, [], ("song_ord",)).groupBy(F.col("inner").alias(text)).agg(first)
    holding = _inside(songs, texts, text, [], ("song_ord",)).groupBy(F.col("outer").alias(text)).agg(first)
    return held.unionByName(holding).groupBy(text).agg(first)


def _named(keys: DataFrame, side: str) -> DataFrame:
    return keys.where(F.col("track_norm") != "").select(
        F.col("track_norm").alias(f"{side}_track"), F.col("artist_norm").alias(f"{side}_artist")
    )


def match_pairs(songs: DataFrame, entries: DataFrame, threshold: float) -> DataFrame:
    """All key pairs that score at least ``threshold``.

    Inputs hold distinct (track_norm, artist_norm); the result is
    (song_track, song_artist, chart_track, chart_artist, score), each pair once.
    """
    if threshold <= 0:
        raise ValueError("a threshold of 0 or less selects every pair; use a positive one")
    s, c = _named(songs, "song"), _named(entries, "chart")
    kinds = []
    if threshold <= 0.70:
        kinds.append(_join_on(s, c, "track"))
    else:
        kinds.append(_same_key(s, c))
        if threshold <= 0.82:
            kinds.append(_same_one_inside_other(s, c, "track", "artist"))
    if threshold <= 0.42:
        kinds.append(_track_inside(s, c))
    elif threshold <= 0.72:
        kinds.append(_same_one_inside_other(s, c, "artist", "track"))
        if threshold <= 0.54:
            kinds.append(_both_inside(s, c, related_texts(s, c, "track")))
    unrelated_track = ~(
        F.contains("song_track", "chart_track") | F.contains("chart_track", "song_track")
    )
    if threshold <= 0.30:
        named = F.col("song_artist") != ""
        kinds.append(_join_on(s.where(named), c, "artist").where(unrelated_track))
    if threshold <= 0.12:
        kinds.append(_artist_inside(s, c).where(unrelated_track))
    pairs = kinds[0]
    for other in kinds[1:]:
        pairs = pairs.unionByName(other)
    score = pair_score(*[F.col(x) for x in ("song_track", "song_artist", "chart_track", "chart_artist")])
    return pairs.withColumn("score", score).where(F.col("score") >= threshold)


PAIR = ["song_track", "song_artist", "chart_track", "chart_artist"]


def _same_key(s: DataFrame, c: DataFrame) -> DataFrame:
    named = F.col("song_artist") != ""
    on = (F.col("song_track") == F.col("chart_track")) & (F.col("song_artist") == F.col("chart_artist"))
    return s.where(named).join(c, on).select(*PAIR)


def _join_on(s: DataFrame, c: DataFrame, part: str) -> DataFrame:
    left = s.withColumn("_on", F.col(f"song_{part}"))
    right = c.withColumn("_on", F.col(f"chart_{part}"))
    return salted_join(left, right, ["_on"]).select(*PAIR)


def _same_one_inside_other(s: DataFrame, c: DataFrame, same: str, inside: str) -> DataFrame:
    """Keys equal in one part (non-empty) whose other parts contain one another."""
    s = s.where(F.col(f"song_{same}") != "")
    a, b = F.col(f"song_{inside}"), F.col(f"chart_{inside}")
    left = s.select(F.col(f"song_{same}").alias("_same"), a.alias("_text"))
    right = c.select(F.col(f"chart_{same}").alias("_same"), b.alias("_text"))
    return containments(left, right, "_text", ["_same"]).select(
        F.col("_same").alias(f"song_{same}"),
        F.col("l_text").alias(f"song_{inside}"),
        F.col("_same").alias(f"chart_{same}"),
        F.col("r_text").alias(f"chart_{inside}"),
    )


def related_texts(s: DataFrame, c: DataFrame, part: str) -> DataFrame:
    """Distinct texts of one part of the keys that contain one another."""
    left = s.select(F.col(f"song_{part}").alias("_text")).distinct()
    right = c.select(F.col(f"chart_{part}").alias("_text")).distinct()
    related = containments(left, right, "_text", [])
    return settle(
        related.select(F.col("l_text").alias(f"song_{part}"), F.col("r_text").alias(f"chart_{part}"))
    )


def _track_inside(s: DataFrame, c: DataFrame) -> DataFrame:
    related = related_texts(s, c, "track")
    with_song = settle(salted_join(s, related, ["song_track"]))
    return salted_join(with_song, c, ["chart_track"]).select(*PAIR)


def _artist_inside(s: DataFrame, c: DataFrame) -> DataFrame:
    related = related_texts(s, c, "artist")
    with_song = settle(salted_join(s, related, ["song_artist"]))
    return salted_join(with_song, c, ["chart_artist"]).select(*PAIR)


def _both_inside(s: DataFrame, c: DataFrame, related: DataFrame) -> DataFrame:
    """Track inside track and artist inside artist, without pairing all artists of two tracks."""
    # The chart key moves to the song track it relates to, so that both sides share that text.
    moved = settle(
        salted_join(c, related, ["chart_track"]).select(
            "song_track", F.col("chart_artist").alias("_text"), "chart_track"
        )
    )
    left = s.select("song_track", F.col("song_artist").alias("_text"))
    right = moved.select("song_track", "_text").distinct()
    artists = containments(left, right, "_text", ["song_track"]).select(
        "song_track", F.col("l_text").alias("song_artist"), F.col("r_text").alias("_text")
    )
    return artists.join(moved, ["song_track", "_text"]).select(
        "song_track", "song_artist", "chart_track", F.col("_text").alias("chart_artist")
    )


def best_song(songs: DataFrame, entries: DataFrame) -> DataFrame:
    """For each chart key the best-scoring song, earliest ordinal first.

    ``songs`` has one row per key with its first ``song_ord``; ``entries`` is distinct keys. The
    result is (chart_track, chart_artist, score, song_ord); a key that no song relates to gets
    the first song of all at score 0, or score -1 and no song if there are no songs. Songs that
    share only a track or only an artist, or hold or lie in one, are represented by their first one,
    so no kind lists all songs of a group.
    """
    first = F.min("song_ord").alias("song_ord")
    s = songs.where(F.col("track_norm") != "").select(
        F.col("track_norm").alias("song_track"),
        F.col("artist_norm").alias("song_artist"),
        "song_ord",
    )
    c = _named(entries, "chart")
    by_key = s.select("song_track", "song_artist")
    exact = [
        _same_key(by_key, c),
        _same_one_inside_other(by_key, c, "track", "artist"),
        _same_one_inside_other(by_key, c, "artist", "track"),
        _both_inside(by_key, c, related_texts(s, c, "track")),
    ]
    found = exact[0]
    for other in exact[1:]:
        found = found.unionByName(other)
    score = pair_score(*[F.col(x) for x in PAIR])
    ranked = found.withColumn("score", score).join(s, ["song_track", "song_artist"])
    ranked = ranked.select("chart_track", "chart_artist", "score", "song_ord")

    per_track = s.groupBy("song_track").agg(first)
    per_artist = s.where(F.col("song_artist") != "").groupBy("song_artist").agg(first)
    same_track = salted_join(c, per_track.withColumnRenamed("song_track", "chart_track"), ["chart_track"])
    same_artist = salted_join(
        c, per_artist.withColumnRenamed("song_artist", "chart_artist"), ["chart_artist"]
    )
    near_track, near_artist = (
        salted_join(c, first_related(own.withColumnRenamed(f"song_{part}", f"chart_{part}"), c.select(f"chart_{part}").distinct(), f"chart_{part}"), [f"chart_{part}"])
        for own, part in ((per_track, "track"), (per_artist, "artist"))
    )
    kinds = (
        (same_track, TRACK_WEIGHT),
        (near_track, TRACK_WEIGHT * TRACK_INSIDE),
        (same_artist, ARTIST_WEIGHT),
        (near_artist, ARTIST_WEIGHT * ARTIST_INSIDE),
    )
    for rows, value in kinds:
        least = rows.select("chart_track", "chart_artist", F.lit(value).alias("score"), "song_ord")
        ranked = ranked.unionByName(least)
    best = ranked.groupBy("chart_track", "chart_artist").agg(
        F.max(F.struct("score", (-F.col("song_ord")).alias("neg"))).alias("best")
    )
    earliest = songs.agg(F.min("song_ord").alias("o")).scalar()
    keys = entries.select(
        F.col("track_norm").alias("chart_track"), F.col("artist_norm").alias("chart_artist")
    )
    none = F.when(earliest.isNotNull(), F.lit(0.0)).otherwise(F.lit(-1.0))
    return keys.join(best, ["chart_track", "chart_artist"], "left").select(
        "chart_track",
        "chart_artist",
        F.coalesce("best.score", none).alias("score"),
        F.coalesce(-F.col("best.neg"), earliest).alias("song_ord"),
    )

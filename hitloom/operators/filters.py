"""Row filters and look-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.contracts import AUDIO_COLUMNS
from hitloom.functions.numeric import lenient_double
from hitloom.functions.text import lookup_text


def recent_years(df: DataFrame, years_back: int | None, year: str = "release_year") -> DataFrame:
    """Rows of the last years before the latest one; the latest year is a scalar subquery."""
    if years_back is None or year not in df.columns:
        return df
    number = lenient_double(F.col(year))
    latest = df.agg(F.max(number).alias("y")).scalar()
    recent = number >= F.floor(latest) - years_back
    return df.where(latest.isNull() | recent)


def audio_columns(df: DataFrame, columns: tuple[str, ...] = AUDIO_COLUMNS) -> list[str]:
    return [c for c in columns if c in df.columns]


def missing_share(df: DataFrame, columns: tuple[str, ...] = AUDIO_COLUMNS):
    present = audio_columns(df, columns)
    if not present:
        return None
    holes = sum((F.col(c).isNull().cast("int") for c in present), F.lit(0))
    return holes / F.lit(float(len(present)))


def audio_complete(df: DataFrame, most_missing: float | None) -> DataFrame:
    """Rows of which at most a share of the audio columns is missing."""
    share = missing_share(df)
    if most_missing is None or share is None:
        return df
    return df.where(share <= most_missing)


def audio_dropped(df: DataFrame, most_missing: float | None) -> DataFrame:
    """How many rows :func:`audio_complete` drops, as a one-row table."""
    share = missing_share(df)
    dropped = F.lit(False) if most_missing is None or share is None else share > most_missing
    return df.agg(F.count_if(dropped).alias("n_rows_dropped_audio_missing"))


def at_ordinals(df: DataFrame, wanted: list[int], ordinal: str) -> DataFrame:
    """Rows by ordinal; an ordinal that does not occur raises."""
    rows = df.where(F.col(ordinal).isin(sorted(set(wanted))))
    found = {r[0] for r in rows.select(ordinal).distinct().collect()}
    unknown = sorted(set(wanted) - found)
    if unknown:
        raise ValueError(f"no row has ordinal {unknown}")
    return rows


def parse_ordinals(text: str) -> list[int]:
    """Ordinals of a list like "0,2,5"; an empty list means the first row."""
    return sorted({int(part) for part in text.split(",") if part.strip()}) or [0]


def named_song(
    df: DataFrame, track: str, artist: str | None, ordinal: str, required: bool = False
) -> DataFrame:
    """First row whose track (and artist) equal the given names up to case and blanks."""
    rows = df.where(lookup_text(F.col("track_name")) == lookup_text(F.lit(track)))
    if artist:
        rows = rows.where(lookup_text(F.col("artist_name")) == lookup_text(F.lit(artist)))
    first = rows.orderBy(ordinal).limit(1)
    if required and first.isEmpty():
        raise ValueError(f"no song is called {track!r}" + (f" by {artist!r}" if artist else ""))
    return first


def named_songs(df: DataFrame, wanted: DataFrame, ordinal: str) -> DataFrame:
    """Batch form: for every wanted (track, artist) the first song of that name.

    The first ordinal per name is an aggregate, so a name that many songs share is no hot group.
    """
    names = {"_t": lookup_text(F.col("track_name")), "_a": lookup_text(F.col("artist_name"))}
    first = df.withColumns(names).groupBy("_t", "_a").agg(F.min(ordinal).alias(ordinal))
    asked = {"_t": lookup_text(F.col("track")), "_a": lookup_text(F.col("artist"))}
    return wanted.withColumns(asked).join(first, ["_t", "_a"]).drop("_t", "_a")

"""Scores of single songs, looked up by ordinal or name, with their leading attributions."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.contracts import CHART_CONTRACT, ExplainSettings, FeatureContract
from hitloom.operators.coercion import with_release_date, with_scoring_month, with_time_features
from hitloom.operators.filters import at_ordinals, named_song, named_songs
from hitloom.operators.preparation import Prepared
from hitloom.plans.explaining import net_local
from hitloom.plans.training import score


def scoring_rows(rows: DataFrame, contract: FeatureContract = CHART_CONTRACT) -> DataFrame:
    """Rows as the model wants them: 1 January where there is a year but no date, and the month.

    The year stays as the table has it; a table without one gets that of the date.
    """
    dated = with_release_date(rows)
    return with_scoring_month(dated, contract) if "release_year" in dated.columns else with_time_features(dated, contract)


def score_rows(
    rows: DataFrame, prepared: Prepared, classifier: Any, contract: FeatureContract = CHART_CONTRACT, *kept: str
) -> DataFrame:
    """Ids (and ``kept``) of the rows with the 0/1 ``prediction`` and the ``probability`` of a hit."""
    scored = score(scoring_rows(rows, contract), prepared, classifier)
    ids = [c for c in contract.ids if c in rows.columns]
    return scored.select(*dict.fromkeys((*kept, *ids)), "prediction", "probability")


def find_song(
    songs: DataFrame, ordinal: str, row: int | None = None, track: str | None = None, artist: str | None = None
) -> DataFrame:
    """The song with ordinal ``row``, or the first one of that name; raises if there is none."""
    if row is not None:
        return at_ordinals(songs, [row], ordinal)
    if not track:
        raise ValueError("say which song: its ordinal, or its track and, if wanted, artist")
    return named_song(songs, track, artist, ordinal, required=True)


def score_song(
    songs: DataFrame, prepared: Prepared, classifier: Any, ordinal: str, *, row: int | None = None, track: str | None = None,
    artist: str | None = None, contract: FeatureContract = CHART_CONTRACT,
) -> DataFrame:
    """One row: the song's ids, prediction and probability."""
    return score_rows(find_song(songs, ordinal, row, track, artist), prepared, classifier, contract, ordinal)


def score_songs(
    songs: DataFrame, wanted: DataFrame, prepared: Prepared, classifier: Any, ordinal: str,
    contract: FeatureContract = CHART_CONTRACT,
) -> DataFrame:
    """For every wanted (track, artist) that has a song, its first song's ids, prediction and probability."""
    found = named_songs(songs, wanted, ordinal).select(ordinal).distinct()
    return score_rows(songs.join(found, ordinal, "left_semi"), prepared, classifier, contract, ordinal)


def explain_song(
    songs: DataFrame, prepared: Prepared, classifier: Any, ordinal: str, *, row: int | None = None, track: str | None = None,
    artist: str | None = None, contract: FeatureContract = CHART_CONTRACT, settings: ExplainSettings = ExplainSettings(),
) -> DataFrame:
    """The song's ``settings.top_k`` leading attributions per raw column, by rank; for the neural model."""
    asked = scoring_rows(find_song(songs, ordinal, row, track, artist), contract)
    _, grouped = net_local(prepared, classifier, asked, scoring_rows(songs, contract), ordinal, settings)
    return grouped.where(F.col("rank") <= settings.top_k).orderBy(ordinal, "rank")

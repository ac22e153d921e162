"""Table contracts and run settings."""

from __future__ import annotations

from dataclasses import dataclass, field

# Column names, aliases, defaults and literals of the data contract.
AUDIO_COLUMNS = (
    "danceability",
    "energy",
    "loudness",
    "speechiness",
    "acousticness",
    "instrumentalness",
    "liveness",
    "valence",
    "tempo",
)
TRACK_NAMES = ("track_name", "track", "song", "name", "title", "track name", "song_name")
ARTIST_NAMES = ("artist_name", "artist", "artists", "artist name", "artist(s)")
POPULARITY_NAMES = ("spotify_popularity", "popularity", "track_popularity", "song_popularity")
YEAR_NAMES = ("year", "release_year", "yr")
TEST_FEATURES = ("danceability", "energy", "valence", "tempo", "loudness")
CHART_FEATURE_LITERAL = "billboard_hot_100_appearance"
CHART_NAME = "hot-100"
MATCH_THRESHOLD = 0.75
REPORT_KEYS = (
    "n_rows",
    "recent_years_window",
    "n_features_numeric",
    "n_features_categorical",
    "accuracy",
    "f1",
    "precision",
    "recall",
    "roc_auc",
)
DISPLAY_NAMES = {
    "artist": "Artist",
    "song": "Track",
    "duration_ms": "Duration_MS",
    "explicit": "Explicit",
    "year": "Year",
    "popularity": "Popularity",
    "danceability": "Danceability",
    "energy": "Energy",
    "key": "Key",
    "loudness": "Loudness",
    "mode": "Mode",
    "speechiness": "Speechiness",
    "acousticness": "Acousticness",
    "instrumentalness": "Instrumentalness",
    "liveness": "Liveness",
    "valence": "Valence",
    "tempo": "Tempo",
    "genre": "Genre",
}


@dataclass(frozen=True)
class FeatureContract:
    """Which columns of a table are label, ids, date and model features."""

    label: str = "is_hit"
    ids: tuple[str, ...] = ("track_name", "artist_name")
    date: str = "release_date"
    numeric: tuple[str, ...] = AUDIO_COLUMNS + ("artist_popularity", "artist_followers")
    categorical: tuple[str, ...] = ("genre",)

    @property
    def columns(self) -> frozenset[str]:
        return frozenset((*self.ids, self.date, self.label, *self.numeric, *self.categorical))


ARTIST_CONTRACT = FeatureContract()
CHART_CONTRACT = FeatureContract(numeric=AUDIO_COLUMNS + ("duration_ms",))


@dataclass(frozen=True)
class FrameSettings:
    """Row filters applied before training; ``None`` switches a filter off."""

    years_back: int | None = None
    max_audio_missing: float | None = None


@dataclass(frozen=True)
class LinearSettings:
    test_size: float = 0.2
    seed: int = 42
    oversample: bool = True
    max_iter: int = 2000
    c: float = 1.0
    neighbours: int | None = None
    frame: FrameSettings = field(default_factory=FrameSettings)


@dataclass(frozen=True)
class ForestSettings:
    test_size: float = 0.2
    seed: int = 42
    oversample: bool = True
    trees: int = 200
    depth: int | None = 10
    min_leaf: int = 5
    neighbours: int | None = None
    frame: FrameSettings = field(default_factory=FrameSettings)


@dataclass(frozen=True)
class NetSettings:
    test_size: float = 0.2
    seed: int = 42
    batch_size: int = 32
    epochs: int = 100
    lr: float = 0.005
    validation: float = 0.1
    threshold_on: str = "validation"
    frame: FrameSettings = field(default_factory=FrameSettings)


@dataclass(frozen=True)
class ExplainSettings:
    max_samples: int = 512
    repeats: int = 5
    steps: int = 64
    baseline: str = "median"
    seed: int = 42
    top_k: int = 15

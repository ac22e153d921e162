"""Column names, lenient types, labels and dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitloom.contracts import (
    ARTIST_CONTRACT,
    ARTIST_NAMES,
    CHART_CONTRACT,
    DISPLAY_NAMES,
    POPULARITY_NAMES,
    TRACK_NAMES,
    YEAR_NAMES,
    FeatureContract,
)
from hitloom.functions.numeric import january_first, lenient_double, lenient_timestamp, unit_clip

# Canonical name of each alias list.
CANONICAL = (
    ("track_name", TRACK_NAMES),
    ("artist_name", ARTIST_NAMES),
    ("spotify_popularity", POPULARITY_NAMES),
    ("release_year", YEAR_NAMES),
)
TIME_COLUMNS = ("release_year", "release_month")


def canonical_names(df: DataFrame) -> DataFrame:
    """Rename known aliases (any case, blanks around) to the canonical column names."""
    present = {c.strip().lower(): c for c in df.columns}
    found = {
        name: next((present[a] for a in aliases if a in present), None)
        for name, aliases in CANONICAL
    }
    return df.withColumnsRenamed({old: new for new, old in found.items() if old and old != new})


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"columns {missing} are missing; the table has {df.columns}")
    return df


def contract_issues(df: DataFrame, contract: FeatureContract) -> list[str]:
    missing = sorted(contract.columns - set(df.columns))
    return [f"missing columns: {missing}"] if missing else []


def detect_contract(df: DataFrame) -> FeatureContract:
    """The chart contract for tables with a match flag and audio columns, else the artist one."""
    charted = {"billboard_matched", "danceability"} <= set(df.columns)
    return CHART_CONTRACT if charted else ARTIST_CONTRACT


def coerce(df: DataFrame, contract: FeatureContract) -> DataFrame:
    """Date, numeric and label columns by lenient parsing; what does not parse is NULL."""
    label = lenient_double(F.col(contract.label))
    parsed = {contract.date: lenient_timestamp(F.col(contract.date))}
    parsed |= {c: lenient_double(F.col(c)) for c in contract.numeric}
    parsed[contract.label] = F.when(label == F.floor(label), label).try_cast("bigint")
    return df.withColumns({c: e for c, e in parsed.items() if c in df.columns})


def with_time_features(df: DataFrame, contract: FeatureContract, weekday: bool = False) -> DataFrame:
    """Year and month of the date column; an existing year column is replaced."""
    if contract.date not in df.columns:
        return df
    day = lenient_timestamp(F.col(contract.date))
    added = {"release_year": F.year(day), "release_month": F.month(day)}
    if weekday:
        added["release_dow"] = F.weekday(day)
    return df.withColumns(added)


def with_scoring_month(df: DataFrame, contract: FeatureContract) -> DataFrame:
    """Month only, for scoring: the year stays as the table has it."""
    if contract.date not in df.columns:
        return df
    return df.withColumn("release_month", F.month(lenient_timestamp(F.col(contract.date))))


def with_release_date(df: DataFrame) -> DataFrame:
    """1 January of the release year where a table has no release date."""
    if "release_date" in df.columns or "release_year" not in df.columns:
        return df
    return df.withColumn("release_date", january_first(F.col("release_year")))


def hit_flag(matched: Column) -> Column:
    """Match flag as 0/1 label: missing or unreadable counts as 0, fractions are cut."""
    whole = F.coalesce(lenient_double(matched), F.lit(0.0)).try_cast("int")
    return F.least(F.greatest(whole, F.lit(0)), F.lit(1))


def with_label(df: DataFrame, keep_existing: bool = False) -> DataFrame:
    """Label from the match flag, and a release date where there is none."""
    if keep_existing and "is_hit" in df.columns:
        return with_release_date(df)
    if "billboard_matched" in df.columns:
        df = df.withColumn("is_hit", hit_flag(F.col("billboard_matched")))
    elif not keep_existing:
        raise ValueError("a label needs the column billboard_matched")
    return with_release_date(df)


def test_label(df: DataFrame, preferred: str = "is_hit") -> Column:
    """Label for two-sample tests: clipped to 0..1, fractions and NULLs kept."""
    for name in (preferred, "billboard_matched"):
        if name in df.columns:
            return unit_clip(lenient_double(F.col(name)))
    raise ValueError(f"neither {preferred} nor billboard_matched is a column")


def model_columns(df: DataFrame, contract: FeatureContract) -> tuple[list[str], list[str]]:
    """Numeric (with time features) and categorical model columns that a table has."""
    numeric = [c for c in (*contract.numeric, *TIME_COLUMNS) if c in df.columns]
    return numeric, [c for c in contract.categorical if c in df.columns]


def numeric_choices(df: DataFrame, contract: FeatureContract) -> list[str]:
    """Columns of numeric type that an explorer may plot, in table order."""
    wanted = {*contract.numeric, *TIME_COLUMNS}
    return [
        f.name for f in df.schema if f.name in wanted and isinstance(f.dataType, T.NumericType)
    ]


def display_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({k: n for k, n in DISPLAY_NAMES.items() if k in df.columns})


def with_minutes(df: DataFrame, column: str = "duration_ms", name: str = "duration_min") -> DataFrame:
    return df.withColumn(name, F.col(column) / F.lit(60000.0))


def label_view(label: Column, scheme: str = "01") -> Column:
    """The label as 0/1, or as hit 1 and miss 2."""
    if scheme not in ("01", "12"):
        raise ValueError(f"scheme is '01' or '12', not {scheme!r}")
    return label if scheme == "01" else F.when(label == 1, 1).otherwise(2)

"""Landed chart snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.contracts import CHART_NAME

# Source field -> chart column, and the schema of a landed entry.
FIELDS = {
    "title": "track_name",
    "artist": "artist_name",
    "weeks": "weeks_on_chart",
    "peakPos": "peak_rank",
    "lastPos": "last_week_rank",
}
LANDED = "chart_date date, rank bigint, title string, artist string, weeks bigint, peakPos bigint, lastPos bigint, chart_name string"
COLUMNS = (
    "chart_name",
    "chart_date",
    "rank",
    "track_name",
    "artist_name",
    "weeks_on_chart",
    "peak_rank",
    "last_week_rank",
)


def entry_columns(landed: DataFrame, chart_name: str = CHART_NAME) -> DataFrame:
    """Landed entries under the names of the chart table; those that name no chart are of ``chart_name``."""
    named = landed.withColumnsRenamed({k: n for k, n in FIELDS.items() if k in landed.columns})
    own = F.lit(chart_name)
    if "chart_name" in landed.columns:
        own = F.coalesce("chart_name", own)
    return named.withColumn("chart_name", own).select(*COLUMNS)


def read_snapshots(
    spark: SparkSession, path: str, kind: str = "json", chart_name: str = CHART_NAME
) -> DataFrame:
    """All snapshots under a path in one read; ``chart_date`` may be a partition folder."""
    landed = spark.read.schema(LANDED).format(kind).option("header", True).load(path)
    return entry_columns(landed, chart_name)


def on_calendar(entries: DataFrame, calendar: DataFrame) -> DataFrame:
    """Entries of the calendar's dates with ``date_ord`` (date order) and ``row_ord``.

    A calendar has at most 53 dates a year, so it is broadcast; with the entries partitioned by
    date the join also prunes folders.
    """
    dated = entries.drop("date_ord")
    dates = F.broadcast(calendar.select("date_ord", "chart_date"))
    out = dated.join(dates, "chart_date")
    return out if "row_ord" in out.columns else out.withColumn("row_ord", F.col("rank"))

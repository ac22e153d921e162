"""Chart calendars: which Saturdays a run reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.functions.text import listed_values

# Chart day, and the day of the year that stands for a whole year.
CHART_DAY = "SAT"
MID_YEAR = (6, 15)
SAMPLINGS = ("yearly", "monthly", "weekly")


def saturday_from(day: Column) -> Column:
    """First Saturday on or after a day."""
    return F.next_day(F.date_sub(day, 1), CHART_DAY)


def week_ending(moment: Column) -> Column:
    """The Saturday that closes the week of a moment."""
    return saturday_from(moment.cast("date"))


def chart_calendar(spark: SparkSession, first: int, last: int, sampling: str) -> DataFrame:
    """Chart dates of the years ``first``..``last``, in order, as (date_ord, chart_date)."""
    sampling = sampling.strip().lower()
    if sampling not in SAMPLINGS:
        raise ValueError(f"sampling is one of {SAMPLINGS}, not {sampling!r}")
    first, last = min(first, last), max(first, last)
    years = spark.range(first, last + 1).select(F.col("id").cast("int").alias("y"))
    return calendar_of_years(years, sampling)


def calendar_of_years(years: DataFrame, sampling: str) -> DataFrame:
    """Chart dates of a table of years (column ``y``); a year's dates never depend on
    another year, so the expansion needs no shuffle."""
    y = F.col("y")
    if sampling == "yearly":
        dates = F.array(saturday_from(F.make_date(y, F.lit(MID_YEAR[0]), F.lit(MID_YEAR[1]))))
    elif sampling == "monthly":
        months = F.sequence(F.lit(1), F.lit(12))
        dates = F.transform(months, lambda m: saturday_from(F.make_date(y, m, F.lit(1))))
    else:
        start = saturday_from(F.make_date(y, F.lit(1), F.lit(1)))
        end = F.make_date(y, F.lit(12), F.lit(31))
        dates = F.sequence(start, end, F.expr("interval 7 days"))
    day = F.explode(dates).alias("chart_date")
    out = years.select(day)
    ord_ = F.unix_date("chart_date").cast("bigint").alias("date_ord")
    return out.select(ord_, "chart_date")


def on_sampling(day: Column, sampling: str) -> Column:
    """Whether a date is on the calendar of its own year: a plain filter on chart dates."""
    sampling = sampling.strip().lower()
    if sampling not in SAMPLINGS:
        raise ValueError(f"sampling is one of {SAMPLINGS}, not {sampling!r}")
    if sampling == "yearly":
        return day == saturday_from(F.make_date(F.year(day), F.lit(MID_YEAR[0]), F.lit(MID_YEAR[1])))
    if sampling == "monthly":
        return day == saturday_from(F.trunc(day, "month"))
    return day == saturday_from(day)


def listed_calendar(spark: SparkSession, text: str) -> DataFrame:
    """Chart dates given as a text list, kept in the order of the list."""
    listed = spark.range(1).select(F.posexplode(listed_values(F.lit(text))).alias("n", "day"))
    return listed.select(
        F.col("n").cast("bigint").alias("date_ord"), F.col("day").try_cast("date").alias("chart_date")
    )


def run_calendar(
    spark: SparkSession, listed: str | None = None, years: tuple[int, int] | None = None, sampling: str = "monthly"
) -> DataFrame:
    """Chart dates of a run: those listed, if any are, else the sampled ones of the years."""
    if listed and listed.strip():
        return listed_calendar(spark, listed)
    if years is None:
        raise ValueError("give chart dates or a range of years")
    return chart_calendar(spark, *years, sampling)

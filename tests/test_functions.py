import pytest
from pyspark.sql import functions as F

from hitloom.functions import calendar as cal
from hitloom.functions.numeric import january_first, lenient_double, or_default, unit_clip
from hitloom.functions.tails import incomplete_beta, student_two_sided
from hitloom.functions.text import listed_values, lookup_text, match_text

TITLES = {
    "Crazy In Love (feat. JAY-Z)": "crazy in love",
    "Beyoncé ft. X": "beyonc",
    "Lift Me": "lift me",
    "Feat": "",
    "soft feature": "soft feature",
    "P!nk": "p nk",
    "a feat b\nc": "a feat b c",
    "éfeat me": "feat me",
    None: "",
    "  A   b ": "a b",
}


def test_match_text(spark):
    df = spark.createDataFrame([(k,) for k in TITLES], "t string")
    assert {r.t: r.n for r in df.select("t", match_text(F.col("t")).alias("n")).collect()} == TITLES


def test_lookup_text(spark):
    df = spark.createDataFrame([(" A\t b C! ",)], "t string")
    assert df.select(lookup_text(F.col("t"))).first()[0] == "a b c!"


def test_listed_values(spark):
    df = spark.createDataFrame([(" 2001-01-06; 2001-01-13 ,, x",)], "t string")
    assert df.select(listed_values(F.col("t"))).first()[0] == ["2001-01-06", "2001-01-13", "x"]


@pytest.mark.parametrize("sampling,size", [("yearly", 20), ("monthly", 240), ("weekly", 1044)])
def test_calendar_sizes(spark, sampling, size):
    days = cal.chart_calendar(spark, 2019, 2000, sampling)
    assert days.count() == size
    assert days.where(F.weekday("chart_date") != 5).count() == 0
    every = spark.range(7305).select(F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).alias("chart_date"))
    filtered = every.where(cal.on_sampling(F.col("chart_date"), sampling))
    assert filtered.exceptAll(days.select("chart_date")).count() == 0 and filtered.count() == size


def test_listed_dates_come_before_years(spark):
    listed = cal.run_calendar(spark, "2001-01-13", (2000, 2001))
    assert [str(r.chart_date) for r in listed.collect()] == ["2001-01-13"]
    assert cal.run_calendar(spark, " ", (2000, 2001), "yearly").count() == 2
    with pytest.raises(ValueError):
        cal.run_calendar(spark)


def test_calendar_arguments(spark):
    with pytest.raises(ValueError):
        cal.chart_calendar(spark, 2000, 2001, "daily")
    listed = cal.listed_calendar(spark, "2001-01-13;2001-01-06, ")
    assert [str(r.chart_date) for r in listed.orderBy("date_ord").collect()] == ["2001-01-13", "2001-01-06"]


def test_lenient_numbers(spark):
    df = spark.createDataFrame([("abc",), ("",), (" 1.5 ",), ("1e3",), ("NaN",), (None,)], "t string")
    assert [r[0] for r in df.select(lenient_double(F.col("t"))).collect()] == [None, None, 1.5, 1000.0, None, None]


def test_defaults_and_clip(spark):
    df = spark.createDataFrame([(None,), (0.0,), (3.0,), (-2.0,), (0.4,)], "x double")
    rows = df.select(or_default(F.col("x"), 999).alias("a"), unit_clip(F.col("x")).alias("b")).collect()
    assert [r.a for r in rows] == [999.0, 999.0, 3.0, -2.0, 0.4]
    assert [r.b for r in rows] == [None, 0.0, 1.0, 0.0, 0.4]


def test_january_first(spark):
    df = spark.createDataFrame([("2001",), ("2001.0",), ("2001.5",), ("1500",), ("3000",), ("x",)], "y string")
    days = [r[0] and str(r[0]) for r in df.select(january_first(F.col("y"))).collect()]
    assert days == ["2001-01-01", "2001-01-01", None, None, None, None]


def test_student_tail():
    # Tabled two-sided values.
    assert student_two_sided(12.706204736432095, 1) == pytest.approx(0.05, abs=1e-9)
    assert student_two_sided(2.2281388519649385, 10) == pytest.approx(0.05, abs=1e-9)
    assert student_two_sided(1.959963984540054, 1e9) == pytest.approx(0.05, abs=1e-7)
    assert student_two_sided(0.0, 7) == pytest.approx(1.0)
    assert incomplete_beta(2, 3, 0.5) == pytest.approx(0.6875)


def test_ladder_finds_every_inner_text(spark):
    """A text's longest prefix of a power-of-two length is among the parts of every text that holds it."""
    from hitloom.functions.text import ladder_parts, ladder_prefix

    text = "the long and winding road to nowhere"
    inner = [text[i:j] for i in range(len(text)) for j in range(i + 1, len(text) + 1)]
    df = spark.createDataFrame([(text, t) for t in inner], "a string, b string")
    found = df.select(F.length(ladder_prefix(F.col("b"))).alias("n"), F.array_contains(ladder_parts(F.col("a")), ladder_prefix(F.col("b"))).alias("hit"), "b").collect()
    assert all(r.hit and r.n <= len(r.b) < 2 * r.n for r in found)

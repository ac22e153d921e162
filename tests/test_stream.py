"""Stream ingest against the same entries in one batch, however the files fall into batches and whatever fails."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from hitloom.operators import matching as m
from hitloom.operators.charts import entry_summaries, key_aggregates
from hitloom.sources.folders import names_in
from hitloom.sources.snapshots import LANDED, read_snapshots
from hitloom.streaming import snapshots as st

NAMES = [("Blue", "Ann"), ("Red", "Bob"), ("Green", None), ("Blue Sky", "Ann")]


def land(spark, folder, files):
    """One file per list of years; an entry without a date is in all, weeks and peak change with each landing."""
    for number, years in enumerate(files):
        rows = [
            (dt.date(y, 5, 1 + i), i + 1, *NAMES[(y + i) % 4], 1 + (i + number) % 3, i + 1 - number % 2, number, chart)
            for y in years for i in range(4) for chart in (None, "other")
        ]
        rows.append((None, 9, "Red", "Bob", 1, 9, 0, None))
        spark.createDataFrame(rows, LANDED).coalesce(1).write.mode("append").json(folder)
    return folder


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """Five files, years apart and out of order; one lands twice."""
    folder = str(tmp_path_factory.mktemp("landed") / "files")
    return land(spark, folder, [[2019, 2001], [2003], [2019, 2001], [2010], [1999, 2003]])


@pytest.fixture(scope="module")
def keys(spark):
    names = spark.createDataFrame(NAMES + [("Absent", "Zed")], "track_name string, artist_name string")
    return m.with_match_key(names).select(*m.KEY).distinct()


def told(df):
    return sorted(map(str, df.collect()))


def expected(spark, folder, keys):
    """All landings in one batch, folded without the module's help."""
    rows = read_snapshots(spark, folder)
    least = F.min(F.struct("weeks_on_chart", "peak_rank", "last_week_rank"))
    entries = rows.groupBy(*st.ENTRY).agg(F.max("weeks_on_chart").alias("w"), F.min("peak_rank").alias("p"), least.alias("least"))
    ordered = entries.selectExpr("*", "least.*", "cast(unix_date(chart_date) as bigint) as date_ord", "rank as row_ord")
    return told(key_aggregates(keys, entry_summaries(ordered, F.lit(1), "w", "p"), 0.75))


def run(spark, folder, base, files=1):
    stream = st.snapshot_stream(spark, folder, files_per_batch=files)
    st.ingest(stream, f"{base}/out", f"{base}/state").awaitTermination()


@pytest.mark.parametrize("files", [1, 3, 100])
def test_batches_do_not_matter(spark, landed, keys, tmp_path, files):
    run(spark, landed, tmp_path, files)
    found = told(st.current_aggregates(spark, f"{tmp_path}/out", keys))
    assert found and found == expected(spark, landed, keys)
    total = st.current_summaries(spark, f"{tmp_path}/out").agg(F.sum("n")).first()[0]
    assert total == 4 * 5 * 2 + 1


def test_parts_are_folded(spark, keys, tmp_path, monkeypatch):
    """Twenty batches, folded by threes: few parts stay, and landing again later counts nothing twice."""
    monkeypatch.setattr(st, "FOLD", 3)
    folder = land(spark, f"{tmp_path}/files", [[1990 + i % 7] for i in range(20)])
    run(spark, folder, tmp_path)
    log = f"{tmp_path}/out/log"
    assert st._cover(spark, log)[0] == [(0, 8), (9, 17), (18, 18), (19, 19)]
    assert len(names_in(spark, log)) <= 4 + 3 * 3
    land(spark, folder, [[1990, 2020]])
    run(spark, folder, tmp_path)
    assert st._cover(spark, log)[0][-1] == (18, 20) or st._cover(spark, log)[0][-1] == (20, 20)
    assert told(st.current_aggregates(spark, f"{tmp_path}/out", keys)) == expected(spark, folder, keys)


def test_small_batches_use_few_partitions(spark, landed, keys, tmp_path):
    """A session of many shuffle partitions: the state has one per core, a part as many files as its size asks for."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    try:
        query = st.ingest(st.snapshot_stream(spark, landed, files_per_batch=1), f"{tmp_path}/out", f"{tmp_path}/state")
        query.awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
        found = told(st.current_aggregates(spark, f"{tmp_path}/out", keys))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    cores = spark.sparkContext.defaultParallelism
    assert {p["stateOperators"][0]["numShufflePartitions"] for p in query.recentProgress} == {cores}
    for part in st._cover(spark, f"{tmp_path}/out/log")[0]:
        files = names_in(spark, f"{tmp_path}/out/log/{st._name(part)}")
        assert sum(n.startswith("part-") for n in files) == 1
    assert found == expected(spark, landed, keys)


@pytest.mark.parametrize("broken", ["compact", "publish"])
def test_failures_between_writes(spark, landed, keys, tmp_path, monkeypatch, broken):
    """A batch that fails before its part or between its part and the folding is retried: same result."""
    monkeypatch.setattr(st, "FOLD", 2)
    whole, calls = getattr(st, broken), []

    def failing(*args):
        calls.append(args)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return whole(*args)

    monkeypatch.setattr(st, broken, failing)
    with pytest.raises(StreamingQueryException):
        run(spark, landed, tmp_path)
    run(spark, landed, tmp_path)
    assert told(st.current_aggregates(spark, f"{tmp_path}/out", keys)) == expected(spark, landed, keys)


def test_publishing_is_whole(spark, tmp_path):
    df, failing = spark.range(5), spark.range(5).select(F.raise_error(F.lit("no")).alias("x"))
    st.publish(df, f"{tmp_path}/log", "0-0")
    st.publish(spark.range(9), f"{tmp_path}/log", "0-0")  # what is there stays
    assert spark.read.parquet(f"{tmp_path}/log/0-0").count() == 5
    with pytest.raises(Exception, match="no"):
        st.publish(failing, f"{tmp_path}/log", "1-1")
    assert "1-1" not in names_in(spark, f"{tmp_path}/log")
    assert st._cover(spark, f"{tmp_path}/log") == ([(0, 0)], [])

"""Incremental ingest of landed chart snapshots into a compacting log of chart-key summaries.

Entries land in any order and more than once. Which ones have been counted is Spark's own stream
state, one row per entry; what a batch adds goes to the log as one part, and parts are folded in
levels, so that a batch costs in proportion to itself and the log keeps few parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hitloom.contracts import MATCH_THRESHOLD
from hitloom.operators.charts import entry_summaries, key_aggregates
from hitloom.operators.matching import KEY
from hitloom.session import settle
from hitloom.sources.folders import names_in, publish, remove
from hitloom.sources.snapshots import LANDED, entry_columns

ENTRY = ["chart_name", "chart_date", "rank", "track_name", "artist_name"]
FOLD = 8  # parts of one level that are folded into one of the next
# State on the executors' disks; a batch sends its changes to the checkpoint, not the whole state.
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _set(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Inside, the session has these settings; afterwards those it had."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def snapshot_stream(
    spark: SparkSession, folder: str, kind: str = "json", files_per_batch: int = 100
) -> DataFrame:
    """Chart entries as they land, in any order of dates."""
    landed = (
        spark.readStream.schema(LANDED)
        .format(kind)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )
    return entry_columns(landed)


def folded_entries(entries: DataFrame) -> DataFrame:
    """One row per entry with what all its landings say, and whether this batch is its first.

    An entry is told by chart, date, rank, title and artist. Weeks count at their most, the peak at
    its best; the other fields come from the least landing. As a stream in update mode, the rows are
    those that a batch touches: the state keeps the times of the first and the last batch that had
    the entry, and a batch's time is part of its plan, the same when it is retried.
    """
    return entries.withColumn("_now", F.current_timestamp()).groupBy(*ENTRY).agg(
        F.max("weeks_on_chart").alias("most_weeks"),
        F.min("peak_rank").alias("best_peak"),
        F.min(F.struct("weeks_on_chart", "peak_rank", "last_week_rank")).alias("least"),
        F.min("_now").alias("_first"),
        F.max("_now").alias("_last"),
    ).select(*ENTRY, "most_weeks", "best_peak", "least.*", (F.col("_first") == F.col("_last")).alias("new"))


def batch_summaries(folded: DataFrame) -> DataFrame:
    """What a batch of folded entries adds to each chart key; only entries new to the log are counted."""
    ordered = folded.withColumns({"date_ord": F.unix_date("chart_date").cast("bigint"), "row_ord": F.col("rank")})
    return entry_summaries(ordered, F.col("new").cast("bigint"), "most_weeks", "best_peak")


def merge_summaries(parts: DataFrame) -> DataFrame:
    """Summaries of several parts folded into one row per chart key, in any order of parts."""
    return parts.groupBy(*KEY).agg(
        F.sum("n").alias("n"),
        F.min("rank_best").alias("rank_best"),
        F.max("rank_worst").alias("rank_worst"),
        F.min("peak_best").alias("peak_best"),
        F.max("weeks_max").alias("weeks_max"),
        F.min("lead").alias("lead"),
    )


def _cover(spark: SparkSession, log: str) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Parts (first batch, last batch) that make up the log, and parts that a wider one has taken in."""
    found = [tuple(map(int, n.split("-"))) for n in names_in(spark, log) if n[0].isdigit()]
    valid, stale, upto = [], [], -1
    for first, last in sorted(found, key=lambda p: (p[0], -p[1])):
        if first > upto:
            valid.append((first, last))
            upto = last
        else:
            stale.append((first, last))
    return valid, stale


def _name(part: tuple[int, int]) -> str:
    return f"{part[0]}-{part[1]}"


def compact(spark: SparkSession, log: str, number: int) -> None:
    """Fold the parts of the last FOLD, FOLD^2, ... batches into one where ``number`` ends such a run.

    The new part appears whole under its own name and from then on hides those it took in. These
    stay until the next folding, for readers that have begun with them.
    """
    width = 1
    while (number + 1) % (width * FOLD) == 0:
        width *= FOLD
    if width == 1:
        return
    valid, stale = _cover(spark, log)
    taken = [p for p in valid if p[0] > number - width]
    left = [n for n in names_in(spark, log) if n.startswith("_")]  # by writers that failed
    for name in [_name(p) for p in stale] + left:
        remove(spark, f"{log}/{name}")
    if len(taken) > 1:
        parts = spark.read.parquet(*[f"{log}/{_name(p)}" for p in taken])
        publish(merge_summaries(parts), log, _name((taken[0][0], taken[-1][1])))


def ingest(stream: DataFrame, out: str, state: str, partitions: int | None = None) -> StreamingQuery:
    """Store what every batch of entries adds, as parts of the log under ``out``.

    Landing again changes nothing but what weeks and peak say; each entry counts once whatever fails
    and however the files fall into batches. A part is named after its batches and appears whole. A
    batch that is retried finds its part, which is the same, or writes it. The state of the stream lies
    in ``state``, on the executors' disks between checkpoints.

    Every batch opens and commits all ``partitions`` of the state, however few entries it has, and their
    number stays what it is when the stream first starts: by default one per core, at most the session's
    shuffle partitions. What a batch writes is dealt by its size.
    """
    log, spark = f"{out}/log", stream.sparkSession
    # For what is written from a batch, which is no stream: Spark switches adaptive execution off for those.
    written = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    held = partitions or min(int(written["spark.sql.shuffle.partitions"]), spark.sparkContext.defaultParallelism)

    def store(batch: DataFrame, number: int) -> None:
        with _set(batch.sparkSession, written):
            # Also when the part is there, as a batch has to run for its state; the part then stays as it is.
            publish(batch_summaries(batch), log, _name((number, number)))
            compact(batch.sparkSession, log, number)

    with _set(spark, _STATE | {"spark.sql.shuffle.partitions": str(held)}):
        return (
            folded_entries(stream).writeStream.outputMode("update").foreachBatch(store)
            .option("checkpointLocation", state).trigger(availableNow=True).start()
        )


def current_summaries(spark: SparkSession, out: str) -> DataFrame:
    """One row per chart key of all batches stored so far."""
    log = f"{out}/log"
    return merge_summaries(spark.read.parquet(*[f"{log}/{_name(p)}" for p in _cover(spark, log)[0]]))


def current_aggregates(
    spark: SparkSession, out: str, song_keys: DataFrame, threshold: float = MATCH_THRESHOLD
) -> DataFrame:
    """Chart aggregates of every song key that the stored entries match, as one batch of them would give."""
    return key_aggregates(settle(song_keys), settle(current_summaries(spark, out)), threshold)

"""Line dedup: runs of lines that an earlier document has too leave the later one."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.llm.words import lists, shipped
from hitloom.operators.skew import salted_join
from hitloom.session import settle

LEAST_BLOCK_WORDS = 20


def line_prints(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the lines with a word: number in the text, 64-bit hash, words."""
    at, prints, sizes = [], [], []
    for i, line in enumerate(text.encode("utf-8", "surrogatepass").split(b"\n")):
        words = line.split()
        if words:
            at.append(i)
            prints.append(xxhash.xxh3_64_intdigest(b" ".join(words)))
            sizes.append(len(words))
    return np.array(at, np.int64), np.array(prints, np.uint64).view(np.int64), np.array(sizes, np.int64)


def least_runs(prints: np.ndarray, sizes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First line, last line and hash of the runs of lines that reach ``least`` words and would not without an end line.

    From each line the run goes on, and back, until it has the words. So of a block of lines with
    ``least`` words or more, each line is in such a run that lies within the block.
    """
    upto = np.concatenate([[0], np.cumsum(sizes)])
    n = np.arange(len(sizes))
    on = np.searchsorted(upto, upto[:-1] + least)  # lines up to the end of the run that starts here
    back = np.searchsorted(upto, upto[1:] - least, side="right") - 1  # first line of the run that ends here
    runs = np.unique(np.concatenate([
        np.stack([n, on - 1], axis=1)[on <= len(sizes)], np.stack([back, n], axis=1)[back >= 0],
    ]).astype(np.int64), axis=0)
    data = prints.tobytes()
    keys = [xxhash.xxh3_64_intdigest(data[8 * i : 8 * j + 8]) for i, j in runs.tolist()]
    return runs[:, 0], runs[:, 1], np.array(keys, np.uint64).view(np.int64)


def _printed(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [line_prints(x or "") for x in batch.column(1).to_pylist()]
            runs = [least_runs(prints, sizes, least) for _, prints, sizes in lines]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), lists([x[0] for x in lines], pa.int64(), np.int64),
                 *[lists([r[i] for r in runs], pa.int64(), np.int64) for i in range(3)]],
                names=["doc_id", "digest", "at", "low", "high", "key"],
            )

    return run


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned positions of two sequences, in order: common heads and tails, then the longest chain
    of elements that occur once in both, then the same between them."""
    found, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, k, j, m = todo.pop()
        while i < k and j < m and a[i] == b[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        while i < k and j < m and a[k - 1] == b[m - 1]:
            k, m = k - 1, m - 1
            found.append((k, m))
        if i == k or j == m:
            continue
        in_a, in_b = Counter(a[i:k]), Counter(b[j:m])
        place = {b[y]: y for y in range(j, m) if in_b[b[y]] == 1}
        once = [(x, place[a[x]]) for x in range(i, k) if in_a[a[x]] == 1 and a[x] in place]
        tops: list[int] = []  # patience piles: least last position of a chain of each length
        chain: list[tuple] = []
        ends: list[int] = []
        for n, (x, y) in enumerate(once):
            at = bisect_left(tops, y)
            chain.append((x, y, ends[at - 1] if at else -1))
            if at == len(tops):
                tops.append(y)
                ends.append(n)
            else:
                tops[at], ends[at] = y, n
        n, anchors = (ends[-1] if ends else -1), []
        while n >= 0:
            anchors.append(chain[n][:2])
            n = chain[n][2]
        if not anchors:
            continue
        low = (i, j)
        for x, y in reversed(anchors):
            todo.append((low[0], x, low[1], y))
            found.append((x, y))
            low = (x + 1, y + 1)
        todo.append((low[0], k, low[1], m))
    return sorted(found)


def removals(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_BLOCK_WORDS
) -> DataFrame:
    """Lines to delete: doc_id, digest (of the text), gone (line numbers from 0), homes (ids)."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("digest"))
    prints = settle(own.where("doc_id is not null").mapInArrow(
        _printed(least_words), "doc_id long, digest long, at array<long>, low array<long>, high array<long>, key array<long>"
    ))
    runs = prints.select("doc_id", "digest", F.explode(F.arrays_zip("key", "low", "high")).alias("r")).select(
        "doc_id", "digest", F.col("r.key").alias("key"), F.col("r.low").alias("low"), F.col("r.high").alias("high")
    )
    shared = settle(
        runs.groupBy("key").agg(F.min("doc_id").alias("home"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n"))
        .where("home < last").drop("last")
    )
    hits = salted_join(runs, shared.select("key", "home"), ["key"], sizes=shared.select("key", "n")).where("doc_id > home")
    marks = hits.groupBy("doc_id", "digest").agg(
        F.collect_set(F.struct("low", "high")).alias("runs"), F.sort_array(F.collect_set("home")).alias("homes")
    )
    lines = F.array_distinct(F.flatten(F.transform("runs", lambda r: F.sequence(r["low"], r["high"]))))
    return marks.join(prints.select("doc_id", "digest", "at"), ["doc_id", "digest"]).select(
        "doc_id", "digest", F.array_sort(F.transform(lines, lambda x: F.col("at")[x.cast("int")])).alias("gone"), "homes"
    ).dropDuplicates(["doc_id", "digest"])


def line_dedup(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_BLOCK_WORDS
) -> DataFrame:
    """``docs`` with the blocks of lines deleted that an earlier document (smaller id) has too.

    Adds n_lines, deleted (line numbers from 0, sorted; empty if none) and homes (ids of the earlier
    documents); the text column holds what is left. A column of one of these names in ``docs`` is
    left out of the result.

    Lines are equal if their words are (white space folded), and lines without words are passed
    over. A run of lines in a row with ``least_words`` words or more goes if an earlier document has
    the same lines in a row, at whatever place and however often. For that, the least runs that reach
    so many words (see :func:`least_runs`) are keys: each is charged to its home, the smallest id that
    has it, and leaves all later documents. They make up every longer run, so documents are not
    compared in pairs. A line's first occurrence always stays.

    Null and empty texts have no lines to delete and stay as they are. Rows with a null id stay as
    they are. Rows that share an id are not compared with each other; repeated rows get the same
    result. Extra columns pass through. An empty table gives an empty result.
    """
    marks = removals(docs, id_col=id_col, text_col=text_col, least_words=least_words)
    names = ("n_lines", "deleted", "homes")
    kept = [c for c in docs.columns if c not in names]
    text = F.col(f"`{text_col}`")
    rows = docs.select(
        *[F.col(f"`{c}`") for c in kept],
        F.col(f"`{id_col}`").cast("long").alias("__id"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("__digest"),
    )
    marked = rows.join(
        marks.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), F.col("gone").alias("__gone"), F.col("homes").alias("__homes")),
        ["__id", "__digest"], "left",
    )
    lines = F.split(text, "\n", -1)
    left = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("__gone", i.cast("long"))), "\n")
    return marked.select(
        *[F.when(F.col("__gone").isNull(), text).otherwise(left).alias(c) if c == text_col else F.col(f"`{c}`") for c in kept],
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce("__gone", F.array().cast("array<bigint>")).alias("deleted"),
        F.coalesce("__homes", F.array().cast("array<bigint>")).alias("homes"),
    )


shipped(__name__)

"""Ranked lexical search over posting lists in blocks of similar documents, with exact bounds.

Documents are ordered by the signs of random projections of their (centred) weight vectors, so that
similar ones are neighbours. In each segment of that order, every term's postings are cut into
blocks of neighbours; a block keeps, per coordinate, the largest value among its documents. The sum
of an item's weights over these maxima bounds every score in the block: it is read unless the bound
is below the item's 50th score so far.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window

from hitloom.llm.words import lists, shipped
from hitloom.session import settle

TOP = 50  # documents per item
CHARS = 1 << 16  # characters of the items that are searched for at once, about
SEGMENT = 2048  # documents in a segment
CELLS = 1 << 23  # of a segment's matrix, documents by terms
BLOCK = 32  # documents in a block
SAMPLE = 1 << 14  # documents, about, whose scores give first thresholds
PLANES = 16  # random projections
SALTS = 64

#: Letters and digits of ASCII (A-Z as a-z) and all bytes of other characters stay; the rest is a gap.
_FOLD = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class Plan(NamedTuple):
    """What one set of items needs; its size is bounded by their characters."""

    names: list  # item ids
    asked: list[np.ndarray]  # per item its terms, the one that can add most first
    weights: np.ndarray  # per term
    docs: int  # N
    total: int  # L
    least: np.ndarray  # per item a score that at least TOP documents reach, or 1
    charged: dict[int, list[tuple[int, int]]]  # term -> (item, place among its terms) whose lists are read
    top: int


def partners(plan: Plan, term: int) -> np.ndarray:
    """Coordinates of the summaries in a term's blocks: what the items that read the list add up there."""
    return np.unique(np.concatenate([plan.asked[i][at:] for i, at in plan.charged[term]]))


def charge(asked: list[np.ndarray], weights: np.ndarray, most: np.ndarray, least: np.ndarray) -> dict[int, list[tuple[int, int]]]:
    """Lists that each item reads.

    A document is charged to the first of the item's terms that it has, so in that term's list only
    the terms from there on count. Where even their largest values in the corpus stay below the
    threshold, that list and the ones after it hold no result.
    """
    out: dict[int, list[tuple[int, int]]] = {}
    for i, own in enumerate(asked):
        bounds = np.cumsum((weights[own] * most[own])[::-1])[::-1]
        for at in np.flatnonzero(bounds >= least[i]):
            out.setdefault(int(own[at]), []).append((i, int(at)))
    return out


def _values(tf: np.ndarray, n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """A term's share of a score before its weight, for documents of n terms."""
    m = 50 + (50 * n * docs) // total
    return (10**9 * tf) // (1000 * tf + 20 * m)


def _list(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and the row of each value."""
    sizes = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(column)), sizes)


def forward(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document its length in terms and, of the vocabulary's terms, how often each occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, tids, tfs = [], [], []
            for text in batch.column(1).to_pylist():
                words = terms(text)
                found = sorted((vocabulary[w], c) for w, c in Counter(words).items() if w in vocabulary)
                n.append(len(words))
                tids.append(np.array([t for t, _ in found], dtype=np.int32))
                tfs.append(np.array([c for _, c in found], dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), lists(tids, pa.int32(), np.int32), lists(tfs, pa.int32(), np.int32)],
                names=["doc_id", "n", "tids", "tfs"],
            )

    return docs.mapInArrow(count, "doc_id long, n long, tids array<int>, tfs array<int>")


def term_statistics(rows: DataFrame, size: int, docs: int, total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per term: documents that hold it, its largest value, the sum of its values. Each task sends one row per term."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, most, sums = (np.zeros(size, dtype=np.int64) for _ in range(3))
        for batch in batches:
            tids, of = _list(batch.column(1))
            value = _values(batch.column(2).flatten().to_numpy().astype(np.int64), batch.column(0).to_numpy()[of], docs, total)
            df += np.bincount(tids, minlength=size)
            np.maximum.at(most, tids, value)
            np.add.at(sums, tids, value)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (held, df[held], most[held], sums[held])], names=["tid", "df", "most", "sums"])

    parts = rows.select("n", "tids", "tfs").mapInArrow(add, "tid long, df long, most long, sums long")
    df, most, sums = (np.zeros(size, dtype=np.int64) for _ in range(3))
    for r in parts.groupBy("tid").agg(F.sum("df").alias("df"), F.max("most").alias("most"), F.sum("sums").alias("sums")).collect():
        df[r.tid], most[r.tid], sums[r.tid] = r.df, r.most, r.sums
    return df, most, sums


def coded(rows: DataFrame, plan: Plan, mean: np.ndarray) -> DataFrame:
    """Adds ``code``: on which side of each random plane through the mean a document's vector lies."""
    planes = np.random.default_rng(7).standard_normal((len(mean), PLANES))
    shift = (plan.weights * mean) @ planes
    docs, total, weights = plan.docs, plan.total, plan.weights

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tids, of = _list(batch.column(2))
            value = weights[tids] * _values(batch.column(3).flatten().to_numpy().astype(np.int64), batch.column(1).to_numpy()[of], docs, total)
            side = np.tile(-shift, (batch.num_rows, 1))
            starts = np.flatnonzero(np.diff(of, prepend=-1))
            for start in range(0, len(starts), 512):  # every row has a term
                ends = np.append(starts, len(of))
                part = slice(starts[start], ends[min(start + 512, len(starts))])
                side[start : start + 512] += np.add.reduceat(planes[tids[part]] * value[part, None], starts[start : start + 512] - part.start)
            bits = (side > 0) @ (1 << np.arange(PLANES)[::-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bits.astype(np.int32))], names=[*batch.schema.names, "code"])

    kinds = StructType([*rows.schema.fields, StructField("code", IntegerType())])
    return rows.mapInArrow(code, kinds)


_INDEX = (
    "ids array<long>, ends array<int>, tids array<int>, values array<int>, "
    "listed array<int>, block_ends array<int>, places array<int>, maxima array<int>"
)


def index(rows: DataFrame, plan: Plan) -> DataFrame:
    """One row per segment of neighbouring documents: their values, and the blocks of each list that is read.

    ``listed`` is a block's term, ``places`` (up to ``block_ends``) its documents in the segment, ``maxima`` its summary over the
    term's :func:`partners`. A segment is bounded, however many documents are alike.
    """
    size, docs, total = len(plan.weights), plan.docs, plan.total

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coordinates = {t: partners(plan, t) for t in plan.charged}
        step = max(64, min(SEGMENT, CELLS // max(1, size)))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                tids, of = _list(part.column(2))
                values = _values(part.column(3).flatten().to_numpy().astype(np.int64), part.column(1).to_numpy()[of], docs, total)
                x = np.zeros((part.num_rows, size), dtype=np.int32)
                x[of, tids] = values
                order = np.argsort(tids, kind="stable")
                held, firsts = np.unique(tids[order], return_index=True)
                listed, ends, places, maxima, at = [], [], [], [], 0
                for t, own in zip(held.tolist(), np.split(of[order], firsts[1:]), strict=True):
                    if t not in coordinates:
                        continue
                    cuts = np.arange(0, len(own), BLOCK)
                    maxima.append(np.maximum.reduceat(x[own[:, None], coordinates[t]], cuts, axis=0).ravel())
                    listed += [t] * len(cuts)
                    ends += [*(at + cuts[1:]).tolist(), at + len(own)]
                    at += len(own)
                    places.append(own)
                flat = [np.diff(np.append(np.flatnonzero(np.diff(of, prepend=-1)), len(of))).cumsum(), tids, values, listed, ends]
                flat += [np.concatenate([np.empty(0), *v]) for v in (places, maxima)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.column(0)], pa.list_(pa.int64())), *[lists([np.asarray(v)], pa.int32(), np.int32) for v in flat]],
                    names=["ids", "ends", "tids", "values", "listed", "block_ends", "places", "maxima"],
                )

    return rows.mapInArrow(build, _INDEX)


class Best:
    """An item's best documents so far."""

    def __init__(self, least: int, top: int):
        self.least, self.top = least, top
        self.rows = np.empty((0, 3), dtype=np.int64)  # less the score, whether the id is null, id

    def add(self, score: np.ndarray, null: np.ndarray, ids: np.ndarray) -> None:
        new = np.stack([-score, null, ids], axis=1)[score >= self.least]
        if len(new):
            rows = np.concatenate([self.rows, new])
            self.rows = rows[np.lexsort(rows.T[::-1])[: self.top]]
            if len(self.rows) == self.top:
                self.least = max(self.least, int(-self.rows[-1, 0]))


def best_of_tasks(segments: DataFrame, plan: Plan, kind: StructField) -> DataFrame:
    """The best documents that each task finds in its segments: (item, item_id, score, doc_id, read, blocks)."""
    size = len(plan.weights)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coordinates = {t: partners(plan, t) for t in plan.charged}
        best = [Best(int(x), plan.top) for x in plan.least]
        read = np.zeros(len(best), dtype=np.int64)
        blocks = np.zeros(len(best), dtype=np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                seg = {n: batch.column(k).slice(row, 1).flatten() for k, n in enumerate(batch.schema.names)}
                null = seg["ids"].is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                ids = seg["ids"].fill_null(0).to_numpy()
                x = np.zeros((len(ids), size), dtype=np.int32)
                ends, tids = seg["ends"].to_numpy(), seg["tids"].to_numpy()
                x[np.repeat(np.arange(len(ids)), np.diff(ends, prepend=0)), tids] = seg["values"].to_numpy()
                listed, places, maxima = (seg[n].to_numpy() for n in ("listed", "places", "maxima"))
                cuts = np.append(0, seg["block_ends"].to_numpy())
                held, firsts = np.unique(listed, return_index=True)
                at = 0
                for t, first, last in zip(held.tolist(), firsts, np.append(firsts[1:], len(listed)), strict=True):
                    partner = coordinates[t]
                    summary = maxima[at : at + (last - first) * len(partner)].reshape(last - first, len(partner))
                    at += summary.size
                    for i, place in plan.charged[t]:
                        rest = plan.asked[i][place:]
                        bound = summary[:, np.searchsorted(partner, rest)] @ plan.weights[rest]
                        alive = np.flatnonzero(bound >= best[i].least)
                        read[i] += len(alive)
                        blocks[i] += last - first
                        if len(alive):
                            docs = np.concatenate([places[cuts[first + b] : cuts[first + b + 1]] for b in alive])
                            own = x[docs[:, None], plan.asked[i]]
                            # Documents with an earlier term are charged to that one.
                            mine = ~own[:, :place].any(axis=1)
                            best[i].add(own[mine].astype(np.int64) @ plan.weights[plan.asked[i]], null[docs[mine]], ids[docs[mine]])
        for i, b in enumerate(best):
            ids = [None if n else k for _, n, k in b.rows.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i] * len(ids), pa.int32()), pa.array([plan.names[i]] * len(ids), arrow), pa.array(-b.rows[:, 0]),
                 pa.array(ids, pa.int64()), pa.array([read[i]] * len(ids), pa.int64()), pa.array([blocks[i]] * len(ids), pa.int64())],
                names=["item", "item_id", "score", "doc_id", "read", "blocks"],
            )

    from pyspark.sql.pandas.types import to_arrow_type

    arrow = to_arrow_type(kind.dataType)
    schema = StructType([StructField("item", IntegerType()), StructField("item_id", kind.dataType), StructField("score", LongType()),
                         *[StructField(n, LongType()) for n in ("doc_id", "read", "blocks")]])
    return segments.mapInArrow(find, schema)


def _firsts(found: DataFrame, top: int) -> DataFrame:
    """The best of all tasks; per salt first, so that no window grows with the number of tasks."""
    by = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    salted = Window.partitionBy("item", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).orderBy(*by)
    kept = found.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
    return kept.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*by))).where(F.col("rank") <= top)


def _found(docs: DataFrame, items: list, kind: StructField, top: int) -> DataFrame:
    """Search for one set of items; ``docs`` is (doc_id, text), ``items`` (id, text) in a list."""
    asked = [(i, sorted(set(terms(text)))) for i, text in items]
    asked = [(i, words) for i, words in asked if words]
    vocabulary = {w: k for k, w in enumerate(sorted({w for _, words in asked for w in words}))}
    size = len(vocabulary)
    rows = settle(forward(docs, vocabulary))
    counted = rows.where("n > 0").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("total")).first()
    n, total = counted.docs, counted.total or 1
    some = rows.where(F.size("tids") > 0)
    df, most, sums = term_statistics(some, size, n, total)
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for x in df.tolist()], dtype=np.int64)
    sorts = [np.array([vocabulary[w] for w in words], dtype=np.int64) for _, words in asked]
    sorts = [own[np.argsort(-(weights * most)[own], kind="stable")] for own in sorts]
    least = np.ones(len(asked), dtype=np.int64)
    plan = Plan([i for i, _ in asked], sorts, weights, n, total, least, charge(sorts, weights, most, least), top)

    # Scores of a sample: what TOP of its documents reach, the corpus reaches.
    drawn = some.where(F.pmod(F.xxhash64("doc_id", "n", "tids"), F.lit(max(1, n // SAMPLE))) == 0)
    first = _firsts(best_of_tasks(index(drawn, plan), plan, kind), top)
    for r in first.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("score")).where(F.col("n") >= top).collect():
        least[r.item] = r.score  # one row per item of this set
    plan = plan._replace(least=least, charged=charge(sorts, weights, most, least))

    near = coded(some, plan, sums / max(1, n))
    # Equal codes spread over tasks by a hash, so a third of all documents with one code is no hot task.
    spread = F.xxhash64("doc_id", "n")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = near.withColumn("spread", spread).repartitionByRange(parts, "code", "spread").sortWithinPartitions("code", "n", "spread")
    segments = settle(index(order.drop("code", "spread"), plan))
    return _firsts(best_of_tasks(segments, plan, kind), top)


def ranked_search(
    docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", top: int = TOP,
) -> DataFrame:
    """The ``top`` documents with the highest scores above 0 for each item: item_id, rank, doc_id, score.

    Also ``read`` and ``blocks``: blocks that the task which found the document read and had for the
    item. Equal scores go by id. A term is a run of ASCII letters and digits (A-Z as a-z) and other
    characters beyond ASCII; weights and values are integers (:func:`_values`) from counts over all
    documents. All documents and whole texts are searched and the result is exact.

    A null text has no terms. Rows that share an id are documents of their own; those with a null id
    come after others of equal score and have a null doc_id. An item without terms has no
    rows; items that repeat id and text count once, items that share an id only have each their
    own ranking. Extra columns are ignored; empty tables give an empty result.

    Items are searched for in sets of about ``CHARS`` characters, each in its own pass over the documents, so
    what goes to tasks and through the driver is bounded, however many items there are.
    """
    pairs = items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text_col}`").alias("text")).where("text is not null").distinct()
    kind = pairs.schema["item_id"]
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    chars = pairs.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    sets = max(1, math.ceil(chars / CHARS))
    of = F.pmod(F.xxhash64("item_id", "text"), F.lit(sets))
    found = [
        _found(texts, [tuple(r) for r in pairs.where(of == k).orderBy("item_id", "text").collect()], kind, top)
        for k in range(sets)
    ]
    return reduce(DataFrame.unionByName, found).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score", "read", "blocks")


shipped(__name__)

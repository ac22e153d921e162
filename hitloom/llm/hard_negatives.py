"""Hard-negative mining with a multiway hyperplane tree (after GNAT) and windows of scores.

Vectors are integer and compared by inner product. One more coordinate, sqrt(M - |x|^2) with M the
largest squared norm, gives all rows the same norm; with 0 there for a query, the squared distance
is |q|^2 + M - 2 q.x, so that a window of scores is an annulus of distances.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, IntegerType, StructField, StructType
from pyspark.sql.window import Window

from hitloom.llm.words import shipped
from hitloom.session import settle

ARITY = 16  # split points in a node
SAMPLE = 4096  # rows that the split points are drawn from; all rows are in the tree
LEAF = 32  # rows of the sample that are not split further
BLOCK = 4096  # rows of a leaf in one task
ASKS = 4096  # queries in one task
CELLS = 1 << 21  # scores held at once
LEAST = -(1 << 62)  # below any score
KEYS = ["leaf", "block", "part"]


class Node(NamedTuple):
    points: np.ndarray  # split points, with the added coordinate
    children: list[int]  # per split point a node, or -1 - leaf


class Tree(NamedTuple):
    nodes: list[Node]
    leaves: int
    square: float  # M
    ranges: list[np.ndarray]  # per node: least and largest distance of split point i to subtree j


def matrix(column: pa.Array | pa.ChunkedArray, exact: bool = True) -> np.ndarray:
    """Rows of equal length; as doubles where those hold every inner product, else as 64-bit integers."""
    n = len(column)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    x = flat.reshape(n, len(flat) // n if n else 0)
    return x.astype(np.float64 if exact else np.int64)


def lifted(x: np.ndarray, square: float) -> np.ndarray:
    x = x.astype(np.float64)
    return np.concatenate([x, np.sqrt(np.maximum(square - (x * x).sum(axis=1, keepdims=True), 0.0))], axis=1)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    squares = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * x @ y.T
    return np.sqrt(np.maximum(squares, 0.0))


def split_points(x: np.ndarray, m: int) -> np.ndarray:
    """Of the first 3 m different rows, m that lie far apart."""
    pool = np.unique(x[: 3 * m], axis=0)
    chosen = [0]
    far = distances(pool, pool[:1])[:, 0]
    while len(chosen) < min(m, len(pool)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, distances(pool, pool[chosen[-1:]])[:, 0])
    return pool[chosen]


def grown(x: np.ndarray, square: float, arity: int = ARITY, leaf: int = LEAF) -> Tree:
    """The tree over a sample, without ranges."""
    nodes: list[Node] = []
    leaves = 0

    def grow(rows: np.ndarray) -> int:
        nonlocal leaves
        points = split_points(rows, arity) if len(rows) > leaf else rows[:1]
        if len(points) < 2:
            leaves += 1
            return -leaves
        nodes.append(Node(points, []))
        at = len(nodes) - 1
        own = distances(rows, points).argmin(axis=1)
        for j in range(len(points)):
            nodes[at].children.append(grow(rows[own == j]))
        return at

    root = grow(x)
    assert root in (0, -1)
    return Tree(nodes, leaves, square, [])


def placed(tree: Tree, x: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]:
    """Each row's leaf, and per node the distances of its rows to the split points and their subtrees."""
    leaf, seen = np.zeros(len(x), dtype=np.int64), []
    todo = [(0, np.arange(len(x)))] if tree.nodes else []
    while todo:
        at, rows = todo.pop()
        node = tree.nodes[at]
        d = distances(x[rows], node.points)
        own = d.argmin(axis=1)
        seen.append((at, d, own))
        for j, child in enumerate(node.children):
            part = rows[own == j]
            if child < 0:
                leaf[part] = -1 - child
            elif len(part):
                todo.append((child, part))
    return leaf, seen


def reached(tree: Tree, q: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[np.ndarray]:
    """Leaves that may hold a row with a score in one of the query's windows [low, high].

    A subtree goes when the range of distances that some split point has to it shows, by the
    triangle inequality, that it meets none of the query's annuli.
    """
    if not tree.nodes:
        return [np.zeros(1, dtype=np.int64)] * len(q)
    base = (q.astype(np.float64) ** 2).sum(axis=1) + tree.square
    slack = 1e-6 * (1 + np.sqrt(base))
    inner = np.sqrt(np.maximum(base[:, None] - 2.0 * high, 0)) - slack[:, None]
    outer = np.sqrt(np.maximum(base[:, None] - 2.0 * low, 0)) + slack[:, None]
    open_ = (low <= high) & (outer > 0)
    hits: list[tuple[np.ndarray, int]] = []
    todo = [(0, np.flatnonzero(open_.any(axis=1)))]
    while todo:
        at, rows = todo.pop()
        node, (least, most) = tree.nodes[at], tree.ranges[at]
        d = np.sqrt(np.maximum(base[rows, None] - 2 * q[rows] @ node.points[:, :-1].T, 0))
        nearest = np.maximum(d[:, :, None] - most, least - d[:, :, None]).max(axis=1)
        farthest = (d[:, :, None] + most).min(axis=1)
        for j, child in enumerate(node.children):
            near, far = nearest[:, j, None], farthest[:, j, None]
            alive = rows[(open_[rows] & (near <= outer[rows]) & (far >= inner[rows])).any(axis=1)]
            if child < 0:
                hits.append((alive, -1 - child))
            elif len(alive):
                todo.append((child, alive))
    of = np.concatenate([np.empty(0, dtype=np.int64), *[rows for rows, _ in hits]])
    leaf = np.concatenate([np.empty(0, dtype=np.int64), *[np.full(len(rows), k) for rows, k in hits]])
    order = np.argsort(of, kind="stable")
    return np.split(leaf[order], np.searchsorted(of[order], np.arange(1, len(q))))


def best_in(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's k largest scores above LEAST; equal ones by column."""
    n = scores.shape[1]
    if n > k:
        kth = np.partition(scores, n - k, axis=1)[:, n - k, None]
        more, same = scores > kth, scores == kth
        scores = np.where(more | (same & (same.cumsum(axis=1) <= k - more.sum(axis=1, keepdims=True))), scores, LEAST)
    return np.nonzero(scores > LEAST)


def _padded(v: Column, width: int) -> Column:
    return F.concat(v, F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size(v)))


def _wider(df: DataFrame, name: str, kind: DataType) -> StructType:
    return StructType([*df.schema.fields, StructField(name, kind)])


class Index(NamedTuple):
    rows: DataFrame  # id, label, v, anchor, leaf: settled
    tree: Tree
    sizes: DataFrame  # rows per leaf
    exact: bool  # whether doubles hold every inner product


def build_index(rows: DataFrame, *, arity: int = ARITY, sample: int = SAMPLE, leaf: int = LEAF) -> Index:
    """Places all of (id, label, v, anchor) in a tree whose split points come from ``sample`` rows, those of least hash.

    Distance ranges come from all rows: each task sends its own per pair of split point and
    subtree. The tree is at most ``sample`` points, so it goes to the driver and to every task.
    """
    limits = rows.agg(
        F.max(F.size("v")).alias("width"),
        F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)).alias("square"),
    ).first()
    width, square = max(1, limits.width or 0), limits.square or 0.0
    exact = square < 2.0**52
    whole = settle(rows.select("id", "label", _padded(F.col("v"), width).alias("v"), "anchor"))
    drawn = whole.select("v", F.xxhash64("v").alias("h")).dropDuplicates(["v"]).orderBy("h").limit(sample)
    points = np.array([r.v for r in drawn.select("v").collect()], dtype=np.float64).reshape(-1, width)
    tree = grown(lifted(points, square), square, arity, leaf)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, _ = placed(tree, lifted(matrix(batch.column(2)), square))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.astype(np.int32))], names=["id", "label", "v", "anchor", "leaf"])

    def span(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = [np.full((len(n.points),) * 2, np.inf) for n in tree.nodes]
        high = [np.full((len(n.points),) * 2, -np.inf) for n in tree.nodes]
        for batch in batches:
            for at, d, own in placed(tree, lifted(matrix(batch.column(0)), square))[1]:
                for j in np.unique(own):
                    low[at][:, j] = np.minimum(low[at][:, j], d[own == j].min(axis=0))
                    high[at][:, j] = np.maximum(high[at][:, j], d[own == j].max(axis=0))
        for at in range(len(tree.nodes)):
            i, j = np.nonzero(low[at] <= high[at])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), at)), pa.array(i), pa.array(j), pa.array(low[at][i, j]), pa.array(high[at][i, j])],
                names=["node", "i", "j", "low", "high"],
            )

    kept = settle(whole.mapInArrow(place, _wider(whole, "leaf", IntegerType())))
    spans = kept.select("v").mapInArrow(span, "node long, i long, j long, low double, high double")
    # An empty subtree keeps the empty range, which no annulus meets.
    ranges = [np.stack([np.full((len(n.points),) * 2, np.inf), np.full((len(n.points),) * 2, -np.inf)]) for n in tree.nodes]
    for r in spans.groupBy("node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        ranges[r.node][:, r.i, r.j] = r.low, r.high
    sizes = kept.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"))
    return Index(kept, tree._replace(ranges=ranges), settle(sizes), exact)


def search(index: Index, queries: DataFrame, k: int, same: bool) -> DataFrame:
    """For each query and window the first k rows by score, then id: (query, at, score, near).

    ``queries`` is (query, id, label, v, leaf, windows), windows an array of (low, high) scores with
    both ends included. Rows of the query's own id are left out; ``same`` says whether rows of the
    query's label are meant or all others. The query's own leaf is searched first; the k-th score
    found there is a window's low end for the other leaves. A leaf's rows and its queries meet in
    blocks of bounded size, so a leaf with a third of all rows is many tasks.
    """
    first = _scan(index, queries.withColumn("leaves", F.array("leaf")), k, same)
    known = settle(_firsts(first, k))
    low = known.groupBy("query", "at").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("low"))
    lows = low.groupBy("query").agg(F.map_from_entries(F.collect_list(F.struct("at", "low"))).alias("lows"))
    raised = F.transform("windows", lambda w, i: F.struct(
        F.greatest(w["low"], F.element_at("lows", i)).alias("low"), w["high"].alias("high")
    ))
    asked = settle(queries.join(lows, "query", "left").withColumn("windows", raised).drop("lows"))
    tree = index.tree

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                table = {n: part.column(part.schema.get_field_index(n)) for n in ("v", "leaf", "windows")}
                low, high = _windows(table["windows"])
                own = table["leaf"].to_pylist()
                found = reached(tree, matrix(table["v"]), low, high)
                leaves = pa.array([[x for x in f.tolist() if x != o] for f, o in zip(found, own, strict=True)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, leaves], names=[*part.schema.names, "leaves"])

    far = settle(asked.mapInArrow(reach, _wider(asked, "leaves", ArrayType(IntegerType()))))
    return _firsts(known.drop("rank").unionByName(_scan(index, far, k, same)), k)


def _firsts(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query", "at").orderBy(F.col("score").desc(), "near")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _windows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Low and high ends, one row per query; missing windows are empty."""
    lists = column.to_pylist()
    width = max((len(w) for w in lists), default=0)
    low, high = np.zeros((len(lists), width), dtype=np.int64), np.full((len(lists), width), -1, dtype=np.int64)
    for i, own in enumerate(lists):
        for j, w in enumerate(own):
            low[i, j], high[i, j] = w["low"], w["high"]
    return low, high


def _scan(index: Index, queries: DataFrame, k: int, same: bool) -> DataFrame:
    exact = index.exact
    asked = queries.withColumn("leaf", F.explode("leaves")).join(F.broadcast(index.sizes), "leaf")
    parts = asked.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / F.lit(ASKS)).cast("int").alias("parts"))
    left = asked.join(F.broadcast(parts), "leaf").select(
        "leaf", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("query"), F.col("parts")).cast("int").alias("part"), "query", "id", "label", "v", "windows",
    )
    right = index.rows.join(F.broadcast(index.sizes), "leaf").join(F.broadcast(parts), "leaf").select(
        "leaf", F.pmod(F.xxhash64("id", "label", "v"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "id", "label", "v",
    )
    schema = "query long, at int, score long, near long"
    arrow = pa.schema([("query", pa.int64()), ("at", pa.int32()), ("score", pa.int64()), ("near", pa.int64())])

    def closest(asks: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = []
        if len(asks) and len(rows):
            rows = rows.sort_by("id")
            x, ids = matrix(rows["v"], exact), rows["id"].to_numpy()
            codes = pa.chunked_array([*asks["label"].chunks, *rows["label"].chunks]).combine_chunks().dictionary_encode()
            codes = codes.indices.to_numpy(zero_copy_only=False)
            own, other = codes[: len(asks)], codes[len(asks) :]
            step = max(1, CELLS // len(x))
            for start in range(0, len(asks), step):
                part = asks.slice(start, step)
                score = (matrix(part["v"], exact) @ x.T).astype(np.int64)
                meant = (own[start : start + step, None] == other[None, :]) == same
                meant &= part["id"].to_numpy()[:, None] != ids[None, :]
                low, high = _windows(part["windows"].combine_chunks())
                for at in range(low.shape[1]):
                    inside = meant & (score >= low[:, at, None]) & (score <= high[:, at, None])
                    i, j = best_in(np.where(inside, score, LEAST), k)
                    out.append([part["query"].to_numpy()[i], np.full(len(i), at, dtype=np.int32), score[i, j], ids[j]])
        columns = [np.concatenate([o[c] for o in out]) if out else np.empty(0, dtype=np.int64) for c in range(4)]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return left.groupBy(*KEYS).cogroup(right.groupBy(*KEYS)).applyInArrow(closest, schema)


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    )


def _over(value: Column) -> Column:
    """A hundredth, rounded down, of a 64-bit integer."""
    return F.floor((value - F.pmod(value, F.lit(100))) / F.lit(100)).cast("long")


def mine(
    rows: DataFrame, anchors: Column, *, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
    scale: int = 256, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, **tree: int,
) -> DataFrame:
    """Hard negatives for each anchor row and each of its positives.

    Each component becomes floor(scale * x); the score of two rows is their inner product. An
    anchor's positives are its first ``positives`` rows of the same label; for each, the negatives are
    the first ``negatives`` rows of other labels with a score from ``low`` to ``high`` percent of the
    positive's. Higher scores come first, then smaller ids; rows with the anchor's id are left out.

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score; an anchor
    without positives or negatives has no rows. Rows with a null id, label or vector, or with a
    null or non-finite component, take no part; shorter vectors are filled up with 0. Rows that repeat
    id, label and vector count once; rows that share an id only are rows of their own. Extra columns
    are ignored; an empty table gives an empty result. Inner products must fit 64 bits.
    """
    vector = F.col(f"`{vector_col}`")
    points = rows.where(usable(vector) & F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("string").alias("label"),
        F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")).alias("v"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
    )
    index = build_index(points.groupBy("id", "label", "v").agg(F.max("anchor").alias("anchor")), **tree)
    asking = settle(index.rows.where("anchor").withColumn("query", F.xxhash64("id", "label", "v")).drop("anchor"))
    every = F.array(F.struct(F.lit(LEAST).alias("low"), F.lit(-LEAST).alias("high")))
    good = settle(search(index, asking.withColumn("windows", every), positives, same=True))
    window = F.struct(
        (-_over(-F.lit(low) * F.col("score"))).alias("low"), _over(F.lit(high) * F.col("score")).alias("high")
    )
    windows = good.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("rank", window.alias("w")))).alias("ws"))
    windows = windows.select("query", F.transform("ws", lambda r: r["w"]).alias("windows"))
    hard = search(index, asking.join(windows, "query"), negatives, same=False)
    named = good.join(asking.select("query", F.col("id").alias("anchor_id")), "query").select(
        "query", "anchor_id", (F.col("rank") - 1).alias("at"), F.col("near").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return hard.join(named, ["query", "at"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("near").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


shipped(__name__)

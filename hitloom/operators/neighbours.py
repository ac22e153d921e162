"""Exact nearest neighbours through pivots in two levels.

Equal vectors are folded into one point with a count. A bounded set of pivots, themselves grouped
around some of them, divides the points into cells; for both levels the largest distance to the
pivot is known, and a cell is searched only by points whose k-th distance so far reaches into it, by
the triangle inequality and the plane midway to the point's own pivot. A large cell is several blocks, so no task holds more than a block
of points and a slice of queries; within a block, points are grouped again in the same way.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.session import settle

CELL = 2048  # points wanted in a cell
MOST_PIVOTS = 1 << 16  # what is held of the index in every task; more points make larger cells, in more blocks
BLOCK = 4096
_NEAR = "array<struct<dist: double, hash: bigint, copies: bigint, vec: array<double>>>"


class Pivots(NamedTuple):
    outer: np.ndarray
    inner: np.ndarray  # one per cell, those of one outer pivot together
    starts: np.ndarray  # where each outer pivot's cells begin
    outer_radius: np.ndarray
    inner_radius: np.ndarray


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances, row against row, without cancellation."""
    out = np.zeros((len(x), len(y)))
    for j in range(x.shape[1] if x.ndim == 2 else 0):
        out += (x[:, j, None] - y[None, :, j]) ** 2
    return out


def pivots_of(points: np.ndarray) -> Pivots:
    """Each point is the pivot of a cell; the first ones are those of the outer level, too."""
    outer = points[: max(1, math.isqrt(len(points)))]
    own = squares(points, outer).argmin(axis=1)
    order = np.argsort(own, kind="stable")
    starts = np.searchsorted(own[order], np.arange(len(outer) + 1))
    return Pivots(outer, points[order], starts, np.full(len(outer), -np.inf), np.full(len(points), -np.inf))


def cells_of(x: np.ndarray, p: Pivots) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Outer cell, distance to its pivot, cell, distance to its pivot."""
    far = squares(x, p.outer)
    outer = far.argmin(axis=1)
    cell, reach = np.zeros(len(x), dtype=np.int64), np.zeros(len(x))
    for i in np.unique(outer):
        rows = np.flatnonzero(outer == i)
        d = squares(x[rows], p.inner[p.starts[i] : p.starts[i + 1]])
        cell[rows], reach[rows] = p.starts[i] + d.argmin(axis=1), np.sqrt(d.min(axis=1))
    return outer, np.sqrt(far[np.arange(len(x)), outer]), cell, reach


def least_distances(x: np.ndarray, pivots: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How near a point of each pivot's cell can be to a row at least, and each row's distance to the pivot.

    A cell lies within its radius, and on its own side of the plane midway to any other pivot of the
    same level, such as the row's nearest.
    """
    sq = squares(x, pivots)
    near = sq.argmin(axis=1)
    apart = np.sqrt(squares(pivots, pivots))[near]
    plane = np.divide(sq - sq[np.arange(len(x)), near][:, None], 2 * apart, out=np.zeros_like(sq), where=apart > 0)
    d = np.sqrt(sq)
    return np.maximum(d - radius, plane), d


def cells_within(x: np.ndarray, bound: np.ndarray, p: Pivots) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) of the cells that may hold a point within the row's bound."""

    def within(rows: np.ndarray, pivots: np.ndarray, radius: np.ndarray) -> np.ndarray:
        least, d = least_distances(x[rows], pivots, radius)
        return least <= bound[rows, None] + 1e-9 * (1 + d)

    alive = within(np.arange(len(x)), p.outer, p.outer_radius)
    rows, cells = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
    for i in range(len(p.outer)):
        some, part = np.flatnonzero(alive[:, i]), slice(p.starts[i], p.starts[i + 1])
        if part.start == part.stop:
            continue  # its own pivot is equal to an earlier one
        r, c = np.nonzero(within(some, p.inner[part], p.inner_radius[part]))
        rows.append(some[r])
        cells.append(c + p.starts[i])
    return np.concatenate(rows), np.concatenate(cells)


def closest(q: np.ndarray, bound: np.ndarray, x: np.ndarray, take: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of q, row of x, distance) of the ``take`` closest within the bound; equal distances by row of x."""
    groups = max(1, math.isqrt(len(x)))
    pivots = x[:groups]
    d = squares(x, pivots)
    own = d.argmin(axis=1)
    radius = np.full(groups, -np.inf)
    np.maximum.at(radius, own, np.sqrt(d[np.arange(len(x)), own]))
    least, to_pivots = least_distances(q, pivots, radius)
    home = to_pivots.argmin(axis=1)
    out = []
    for g in np.unique(home):
        asking, here = np.flatnonzero(home == g), np.flatnonzero(own == g)
        for start in range(0, len(asking), 256):
            rows = asking[start : start + 256]
            limit = bound[rows]
            if len(here) >= take:
                near = np.sqrt(np.partition(squares(q[rows], x[here]), take - 1, axis=1)[:, take - 1])
                limit = np.minimum(limit, near)
            limit = limit * (1 + 1e-9)
            wanted = (least[rows] <= limit[:, None] + 1e-9 * (1 + to_pivots[rows])).any(axis=0)
            some = np.flatnonzero(wanted[own])
            dist = np.sqrt(squares(q[rows], x[some]))
            dist[dist > limit[:, None]] = np.inf
            if len(some) > take:
                kth = np.partition(dist, take - 1, axis=1)[:, take - 1, None]
                less, same = dist < kth, dist == kth
                dist[~(less | (same & (same.cumsum(axis=1) <= take - less.sum(axis=1, keepdims=True))))] = np.inf
            i, j = np.nonzero(np.isfinite(dist))
            out.append((rows[i], some[j], dist[i, j]))
    i, j, d = (np.concatenate([o[c] for o in out]) if out else np.empty(0) for c in range(3))
    order = np.lexsort((j, d, i))
    return i[order].astype(np.int64), j[order].astype(np.int64), d[order]


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), len(flat) // len(column) if len(column) else 0)


def _near(i: np.ndarray, j: np.ndarray, d: np.ndarray, copies: np.ndarray, asked: int, rows: pa.Table) -> pa.Array:
    """One list per query of what was found, as ``_NEAR``."""
    found = rows.select(["hash", "vec"]).take(pa.array(j)).combine_chunks()
    hashes, vecs = (c.combine_chunks() for c in found.columns)
    kind = pa.struct([("dist", pa.float64()), ("hash", pa.int64()), ("copies", pa.int64()), ("vec", pa.list_(pa.float64()))])
    entries = pa.StructArray.from_arrays([pa.array(d), hashes, pa.array(copies), vecs.cast(pa.list_(pa.float64()))], fields=list(kind))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(i, np.arange(asked + 1)).astype(np.int32)), entries)


def nearest_neighbours(points: DataFrame, k: int, pivots: int | None = None, block: int = BLOCK) -> DataFrame:
    """Exact k nearest other rows: (key, vec, near) with ``near`` an array of vectors, closest first.

    ``points`` is (key, vec); keys are unique. Equal distances are ordered by vector hash.
    """
    folded = settle(
        points.groupBy("vec").agg(F.count(F.lit(1)).alias("n"))
        .select("vec", "n", F.xxhash64("vec").alias("hash"), F.monotonically_increasing_id().alias("row"))
    )
    wanted = pivots or max(1, min(MOST_PIVOTS, folded.count() // CELL))
    chosen = folded.orderBy("hash", "row").limit(wanted).select("vec").collect()  # at most MOST_PIVOTS rows
    index = pivots_of(np.array([r.vec for r in chosen], dtype=np.float64).reshape(len(chosen), -1))
    cells, index, blocks = _celled(folded, index, block)
    first = settle(_own_blocks(cells, k, index, blocks))
    done = first.where(F.size("targets") == 0).select("vec", "near")
    again = first.where(F.size("targets") > 0)
    far = _other_blocks(again, cells, k, block)
    merged = again.select("row", "vec", "near").unionByName(far.withColumn("vec", F.lit(None).cast("array<double>"))).groupBy("row").agg(
        F.first("vec", ignorenulls=True).alias("vec"), F.array_sort(F.flatten(F.collect_list("near"))).alias("near")
    )
    best = done.unionByName(merged.select("vec", "near"))
    spread = F.flatten(F.transform("near", lambda e: F.array_repeat(e["vec"], e["copies"].cast("int"))))
    return points.join(best.select("vec", F.slice(spread, 1, k).alias("near")), "vec").select("key", "vec", "near")


def _celled(folded: DataFrame, index: Pivots, block: int) -> tuple[DataFrame, Pivots, np.ndarray]:
    """Points with their cell and block, the radii of both levels, and blocks per cell."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = cells_of(_matrix(batch.column(0)), index)
            names = [*batch.schema.names, "outer", "outer_reach", "cell", "reach"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, found)], names=names)

    kind = "vec array<double>, n bigint, hash bigint, row bigint, outer bigint, outer_reach double, cell bigint, reach double"
    placed = settle(folded.mapInArrow(place, kind))
    # One row per pivot.
    for r in placed.groupBy("outer").agg(F.max("outer_reach").alias("radius")).collect():
        index.outer_radius[r.outer] = r.radius
    blocks = np.zeros(len(index.inner), dtype=np.int64)
    for r in placed.groupBy("cell").agg(F.max("reach").alias("radius"), F.count(F.lit(1)).alias("n")).collect():
        index.inner_radius[r.cell], blocks[r.cell] = r.radius, -(-r.n // block)
    sizes = placed.sparkSession.createDataFrame([(i, int(b)) for i, b in enumerate(blocks) if b > 1], "cell bigint, blocks bigint")
    own = F.coalesce(F.pmod(F.xxhash64("row"), F.col("blocks")), F.lit(0))
    celled = placed.join(F.broadcast(sizes), "cell", "left").select("cell", own.alias("block"), "row", "hash", "n", "vec")
    return celled, index, blocks


def _own_blocks(cells: DataFrame, k: int, index: Pivots, blocks: np.ndarray) -> DataFrame:
    """Every point with its closest in its own block, and the other blocks that may hold closer ones."""

    def search(table: pa.Table) -> pa.Table:
        table = table.sort_by("hash")
        x, n = _matrix(table["vec"]), table["n"].to_numpy()
        i, j, d = closest(x, np.full(len(x), np.inf), x, k + 1)
        copies = np.minimum(np.where(i == j, n[j] - 1, n[j]), k)  # one of a point's own copies is the row itself
        i, j, d, copies = (v[copies > 0] for v in (i, j, d, copies))
        upto = np.cumsum(copies)
        upto -= np.append(0, upto)[np.searchsorted(i, i)]
        bound = np.full(len(x), np.inf)
        np.minimum.at(bound, i[upto >= k], d[upto >= k])
        home, own = table["cell"][0].as_py(), table["block"][0].as_py()
        rows, hit = cells_within(x, bound, index)
        times = blocks[hit]
        rows, hit = np.repeat(rows, times), np.repeat(hit, times)
        number = np.arange(len(hit)) - np.repeat(np.cumsum(times) - times, times)
        other = (hit != home) | (number != own)
        rows, hit, number = rows[other], hit[other], number[other]
        order = np.argsort(rows, kind="stable")
        targets = pa.StructArray.from_arrays([pa.array(hit[order]), pa.array(number[order])], names=["cell", "block"])
        ends = np.searchsorted(rows[order], np.arange(len(x) + 1)).astype(np.int32)
        return pa.table({
            "row": table["row"], "vec": table["vec"], "bound": bound, "near": _near(i, j, d, copies, len(x), table),
            "targets": pa.ListArray.from_arrays(pa.array(ends), targets),
        })

    kind = f"row bigint, vec array<double>, bound double, near {_NEAR}, targets array<struct<cell: bigint, block: bigint>>"
    return cells.groupBy("cell", "block").applyInArrow(search, kind)


def _other_blocks(asking: DataFrame, cells: DataFrame, k: int, size: int) -> DataFrame:
    """What the blocks that points have as targets add: (row, near)."""
    asked = asking.select("row", "vec", "bound", F.inline("targets"))
    asks = asked.groupBy("cell", "block").agg(F.ceil(F.count(F.lit(1)) / F.lit(size)).alias("parts"))
    left = asked.join(asks, ["cell", "block"]).withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts"))).drop("parts")
    right = cells.join(asks, ["cell", "block"]).withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))

    def search(queries: pa.Table, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("hash")
        asked = len(queries) if len(rows) else 0
        queries = queries.slice(0, asked)
        if asked:
            i, j, d = closest(_matrix(queries["vec"]), queries["bound"].to_numpy(), _matrix(rows["vec"]), k + 1)
        else:
            i, j, d = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0)
        copies = np.minimum(rows["n"].to_numpy()[j], k)
        return pa.table({"row": queries["row"], "near": _near(i, j, d, copies, asked, rows)})

    keys: list[str | Column] = ["cell", "block", "part"]
    grouped = left.groupBy(*keys).cogroup(right.select(*keys, "hash", "n", "vec").groupBy(*keys))
    return grouped.applyInArrow(search, f"row bigint, near {_NEAR}")

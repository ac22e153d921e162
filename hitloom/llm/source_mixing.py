"""Mixing sources to target weights: whole epochs, then a subset of documents that fills the rest."""

from __future__ import annotations

from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hitloom.llm.words import shipped
from hitloom.session import settle

# Weights of the sources in order, repeating, and how often a document may be used.
WEIGHTS = (5, 2, 1)
MOST_USES = 3
WORD = r"[^\x20\x09-\x0D]+"

REACH = 1 << 16  # words of the budget that the table of reachable sums spans
CLASSES = 1 << 18  # of sums of a whole budget, each of which holds one
SEED = 17


def fill(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each size to take, of ``counts``, so that their sizes sum to ``budget``
    or come as near as can be found.

    Each size first gives its share of the budget, rounded down. What is left is taken one by one
    from the sizes that lost most by rounding, until it is within ``REACH``; the last part is a
    bounded knapsack over what each size still has. If only documents are left that are too long to
    come within ``REACH``, there is no such part. Documents are then added, given back or
    exchanged, up to two at a time, as long as that comes nearer. If a nearer sum may exist,
    sums of all documents are tried in classes (see :func:`_by_classes`), and the nearer result counts.
    """
    total = int((sizes * counts).sum())
    if budget >= total:
        return counts.copy()
    share = counts * (budget / total) if total else counts * 0.0
    take = np.minimum(np.floor(share).astype(np.int64), counts)
    left = budget - int((sizes * take).sum())
    while left < 0:  # rounding of floats
        i = int(np.argmax(take > 0))
        take[i] -= 1
        left += int(sizes[i])
    order = np.lexsort((sizes, take - share))
    for one in (True, False):
        for i in order:
            if left <= REACH:
                break
            room = min(int(counts[i] - take[i]), max(0, (left - REACH // 2) // max(1, int(sizes[i]))))
            if sizes[i] and room > 0:
                room = min(room, 1) if one else room
                take[i] += room
                left -= room * int(sizes[i])
    if left > REACH:
        return _nearest(sizes, counts, take, budget)
    goal = left
    spare = sizes[(take < counts) & (sizes > 0)]
    top = goal + (int(spare.min()) if len(spare) else 0)  # just above may be nearer
    first = np.full(top + 1, -1, dtype=np.int64)  # item by which a sum was reached first
    reached = np.zeros(top + 1, dtype=bool)
    reached[0] = True
    items: list[tuple[int, int, int]] = []
    for i in order:
        size, spare, part = int(sizes[i]), int(counts[i] - take[i]), 1
        while size and spare > 0 and size <= top and not reached[goal]:
            copies = min(part, spare)
            weight = copies * size
            if weight > top:
                copies = top // size
                weight = copies * size
                spare = copies
            new = np.zeros(top + 1, dtype=bool)
            new[weight:] = reached[: top + 1 - weight]
            new &= ~reached
            first[new] = len(items)
            reached |= new
            items.append((int(i), copies, weight))
            spare, part = spare - copies, part * 2
        if reached[goal]:
            break
    sums = np.flatnonzero(reached)
    at = int(sums[np.argmin(np.abs(sums - goal))])
    while at > 0:
        i, copies, weight = items[first[at]]
        take[i] += copies
        at -= weight
    return _nearest(sizes, counts, take, budget)


def _nearest(sizes: np.ndarray, counts: np.ndarray, take: np.ndarray, budget: int) -> np.ndarray:
    take = _nearer(sizes, counts, take, budget - int((sizes * take).sum()))
    step = int(np.gcd.reduce(sizes))  # all sums are multiples of it
    if abs(budget - int((sizes * take).sum())) <= min(budget % step, -budget % step):
        return take
    other = _by_classes(sizes, counts, budget)
    other = _nearer(sizes, counts, other, budget - int((sizes * other).sum()))
    return min(take, other, key=lambda x: abs(budget - int((sizes * x).sum())))


def _by_classes(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Documents whose sizes come near ``budget``: a bounded knapsack over all, in which the first of the sums of a class stands for it."""
    take = np.zeros(len(sizes), np.int64)
    top = budget + int(sizes.max())
    width = top // CLASSES + 1
    held = np.full(top // width + 1, -1, dtype=np.int64)  # sum of each class
    first, come = held.copy(), held.copy()  # item and class from which it was reached first
    held[0] = 0
    items: list[tuple[int, int]] = []
    for i in np.argsort(-sizes, kind="stable"):
        size, spare, part = int(sizes[i]), int(counts[i]), 1
        while size and 0 < spare and size <= top:
            copies = min(part, spare)
            source = np.flatnonzero(held >= 0)
            sums = held[source] + copies * size
            source, sums = source[sums <= top], sums[sums <= top]
            into, one = np.unique(sums // width, return_index=True)
            new = held[into] < 0
            into, one = into[new], one[new]
            held[into], first[into], come[into] = sums[one], len(items), source[one]
            items.append((int(i), copies))
            spare, part = spare - copies, part * 2
    found = np.flatnonzero(held >= 0)
    at = int(found[np.argmin(np.abs(held[found] - budget))])
    while at > 0:
        i, copies = items[first[at]]
        take[i] += copies
        at = int(come[at])
    return take


def _nearer(sizes: np.ndarray, counts: np.ndarray, take: np.ndarray, left: int) -> np.ndarray:
    """``take`` with one or two documents more, less or exchanged at a time, while ``left`` words (below 0: too many) come nearer to none."""
    take = take.copy()
    while left:
        more, less = np.flatnonzero((take < counts) & (sizes > 0)), np.flatnonzero((take > 0) & (sizes > 0))
        item = np.concatenate([[0], more, less])
        step = np.concatenate([[0], np.ones(len(more), np.int64), -np.ones(len(less), np.int64)])
        order = np.argsort(sizes[item] * step, kind="stable")
        item, step = item[order], step[order]
        words, room = sizes[item] * step, np.where(step > 0, counts[item] - take[item], take[item])
        near = np.searchsorted(words, left - words)
        found = []
        for shift in (-2, -1, 0, 1):
            other = np.clip(near + shift, 0, len(words) - 1)
            rest = np.abs(left - words - words[other])
            rest[(other == np.arange(len(words))) & (step != 0) & (room < 2)] = np.iinfo(np.int64).max
            a = int(np.argmin(rest))
            found.append((int(rest[a]), a, int(other[a])))
        rest, a, b = min(found)
        if rest >= abs(left):
            break
        for k in (a, b):
            take[item[k]] += step[k]
            left -= int(words[k])
    return take


def _plan(rows: pd.DataFrame) -> pd.DataFrame:
    """Per size of one source: uses of every document, and documents that are used once more."""
    rows = rows.sort_values("size")
    total, target = int((rows["size"] * rows["n"]).sum()), float(rows["target"].iloc[0])
    uses = min(MOST_USES, int(target // total)) if total else 0
    budget = int(round(target - uses * total)) if uses < MOST_USES else 0
    extra = fill(rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64), budget) if total else 0
    return rows.assign(uses=uses, extra=extra)[["has", "name", "size", "n", "source_size", "target", "uses", "extra"]]


def targets(totals: DataFrame) -> DataFrame:
    """Adds target to rows (has, name, source_size), one per source.

    Sources go by code point, null last, and weigh ``WEIGHTS`` in turn. All sizes together are
    shared by weight; a source stops at ``MOST_USES`` times its size, and the excess goes to the others by weight: so
    one level, times the weight, holds for all sources that do not stop. Works on one row per source.
    """
    one = Window.orderBy(F.col("has").desc(), "name")
    rank = F.row_number().over(one) - 1
    weight = reduce(lambda x, i: x.when(rank % len(WEIGHTS) == i, WEIGHTS[i]), range(1, len(WEIGHTS)), F.when(rank % len(WEIGHTS) == 0, WEIGHTS[0]))
    rows = totals.select("*", weight.cast("double").alias("w"), (MOST_USES * F.col("source_size")).cast("double").alias("cap"))
    whole = Window.partitionBy()
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), F.col("has").desc(), "name")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0.0)
    rows = rows.select(
        "*",
        ((F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), none))
         / (F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), none))).alias("level"),
        F.row_number().over(by_cap).alias("k"),
    )
    free = F.min(F.when(F.col("cap") > F.col("w") * F.col("level"), F.struct("k", "level"))).over(whole)
    rows = rows.select("*", free.alias("free"))
    stops = F.col("free").isNull() | (F.col("k") < F.col("free.k"))
    return rows.select("has", "name", "source_size", F.when(stops, F.col("cap")).otherwise(F.col("w") * F.col("free.level")).alias("target"))


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED
) -> DataFrame:
    """How often each document is used so that the sources' words come to their targets.

    Returns one row per row of ``docs``: doc_id, size (words between ASCII white space),
    source_size, target (of its source), uses (0 to ``MOST_USES``), taken (``uses * size``).

    Sizes are counted per source and length. Each source's target is split into whole uses of all
    its documents and a rest below its size, and :func:`fill` finds how many documents of each
    length make up the rest. Which ones is decided by a seeded hash of the id, so reruns agree:
    documents of a length are dealt into about the root of their number of buckets by hash, the
    bucket in which the number is reached is ranked. So no group is larger than about that root.

    A null source is a source of its own, last in order. Null and empty texts have size 0 and are
    never taken. Rows that share an id are told apart by nothing but their size, so of such rows
    with equal size it is open which one is used more. Extra columns are ignored. An empty table
    gives an empty result.
    """
    source = F.col(f"`{source_col}`").cast("string")
    rows = settle(docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), source.isNotNull().alias("has"), F.coalesce(source, F.lit("")).alias("name"),
        size_of(F.col(f"`{text_col}`")).alias("size"),
        F.xxhash64(F.col(f"`{id_col}`"), F.lit(seed)).alias("h"),
    ))
    counts = settle(rows.groupBy("has", "name", "size").agg(F.count(F.lit(1)).alias("n")))
    totals = counts.groupBy("has", "name").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    plan = settle(
        counts.join(targets(totals), ["has", "name"]).groupBy("has", "name").applyInPandas(
            _plan, "has boolean, name string, size long, n long, source_size long, target double, uses long, extra long"
        )
    )
    key = ["has", "name", "size"]
    planned = rows.join(plan, key)
    buckets = F.ceil(F.sqrt(F.col("n").cast("double")))
    part = F.floor(F.shiftrightunsigned("h", 11) / F.lit(float(1 << 53)) * buckets)
    some = planned.where("extra > 0 and extra < n").select(*key, "doc_id", "h", "extra", part.alias("part"))
    upto = Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = some.groupBy(*key, "part").agg(F.count(F.lit(1)).alias("m"), F.first("extra").alias("extra"))
    cut = settle(
        sizes.select(*key, "part", "m", "extra", F.coalesce(F.sum("m").over(upto), F.lit(0)).alias("before"))
        .where("before < extra and before + m > extra").select(*key, F.col("part").alias("cut"), (F.col("extra") - F.col("before")).alias("rest"))
    )
    # Classes whose count falls between two buckets have no cut bucket: their last full bucket stands in.
    full = sizes.select(*key, "part", "m", "extra", F.coalesce(F.sum("m").over(upto), F.lit(0)).alias("before")).where(
        "before + m = extra"
    ).select(*key, F.col("part").alias("cut"), F.lit(None).cast("long").alias("rest"))
    ends = cut.unionByName(full)
    dealt = planned.join(ends, key, "left").withColumn("part", part).repartition(*key, "part")  # not by length alone
    order = Window.partitionBy(*key, F.when(F.col("part") == F.col("cut"), F.col("part")).otherwise(-1 - F.col("part"))).orderBy("h", "doc_id")
    ranked = dealt.withColumn("rank", F.row_number().over(order))
    more = (
        F.when(F.col("extra") == 0, False)
        .when(F.col("extra") >= F.col("n"), True)
        .when(F.col("part") < F.col("cut"), True)
        .when(F.col("part") > F.col("cut"), False)
        .otherwise(F.col("rest").isNull() | (F.col("rank") <= F.col("rest")))
    )
    uses = F.when(F.col("size") > 0, F.col("uses") + more.cast("long")).otherwise(0).cast("long")
    return ranked.select("doc_id", "size", "source_size", "target", uses.alias("uses"), (uses * F.col("size")).alias("taken"))


shipped(__name__)

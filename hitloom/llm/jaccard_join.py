"""N-gram Jaccard join by parity sketches: sketch blocks as join keys, then exact checks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hitloom.llm.graph import components
from hitloom.llm.words import ascii_words, hashed, lists, mixed, shingled, shipped
from hitloom.operators.skew import salted_join
from hitloom.session import settle

BLOCK_BITS = 512
LEAST_BITS = 3  # set bits that a block needs to be a key of its own
ENOUGH = 124  # blocks among which linked sets agree on a good one, but for a chance under 1e-12
SKETCH_BITS = 16  # for each difference that a pair may have
LEVELS = 4

_PRINTS = (
    "doc_id long, n long, h1 long, h2 long, keys0 array<long>, keys1 array<long>,"
    " sketch0 array<long>, sketch1 array<long>"
)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def edges_of_bands(largest: int, num: int, den: int) -> list[int]:
    """First sizes of the bands, such that sizes of linked sets lie in one band or two next ones."""
    firsts = [1, 2]
    while firsts[-1] <= largest:
        firsts.append(max(firsts[-1] + 1, (firsts[-1] - 1) * den // num + 1))
    return firsts + [max(firsts[-1] + 1, (firsts[-1] - 1) * den // num + 1)]


def differences(total: int, num: int, den: int) -> int:
    """How many elements two sets with ``total`` elements together may not share."""
    return (den - num) * total // (den + num)


def _blocks(hashes: np.ndarray, blocks: int, used: int, seed: int) -> np.ndarray:
    """Parity sketch in blocks, the first ``used`` of them: each hash flips one bit of one block."""
    spot = mixed(hashes, seed)
    block = (spot >> np.uint64(32)) % np.uint64(blocks)
    place = (block * np.uint64(BLOCK_BITS) + spot % np.uint64(BLOCK_BITS))[block < np.uint64(used)]
    flips = np.bincount(place.astype(np.int64), minlength=used * BLOCK_BITS)
    return (flips & 1).astype(np.uint8).reshape(used, BLOCK_BITS)


def block_keys(hashes: np.ndarray, domain: int, allowed: int, levels: int = LEVELS) -> np.ndarray:
    """Join keys of a set: one for each good block of its sketch.

    With one block more than differences, two linked sets agree in a block. A block with under
    ``LEAST_BITS`` set bits says little and would be a key of many sets, so it is none; whoever has
    one goes on to the next level's sketch (another seed). A block on which two sets agree is poor in
    both, so both go on. The last level of a small sketch uses every block, so no link is lost.

    Differences fall on blocks at random, so over a third of the blocks agree, and over half of
    those are good at a similarity of 0.8 (more above it): sets miss each other in n blocks with a chance of 0.8 ** n at
    most. So ``ENOUGH`` blocks, over all levels, are as safe as 64-bit hashes are, and larger sketches need no more.
    """
    if allowed == 0 or len(hashes) == 0:
        return np.array([], dtype=np.uint64)  # linked sets are equal
    blocks = allowed + 1
    used = min(blocks, ENOUGH)
    small = levels * blocks < ENOUGH
    levels = min(levels, -(-ENOUGH // used))
    found = []
    for level in range(levels):
        bits = _blocks(hashes, blocks, used, 11 + level)
        poor = bits.sum(axis=1) < LEAST_BITS
        words = np.packbits(bits, axis=1).view(np.uint64)
        key = np.full(used, domain * 64 + level, dtype=np.uint64)
        key = mixed(key, 3) + np.arange(used, dtype=np.uint64)
        for i in range(words.shape[1]):
            key = mixed(key, 5) ^ words[:, i]
        key = mixed(key, 7)
        last = level == levels - 1
        found.append(key if last and small else key[~poor])
        if last or not poor.any():
            break
    return np.unique(np.concatenate(found))


def sketch(hashes: np.ndarray, allowed: int) -> np.ndarray:
    """One parity sketch of a set for Hamming distances, as 64-bit words."""
    bits = 64 * max(4, -(-SKETCH_BITS * allowed // 64))
    flips = np.bincount((mixed(hashes, 99) % np.uint64(bits)).astype(np.int64), minlength=bits)
    return np.packbits((flips & 1).astype(np.uint8)).view(np.uint64)


def shingles(text: str | None, width: int) -> np.ndarray:
    return np.unique(shingled(hashed(ascii_words(text)), width))


def _prints(width: int, num: int, den: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        firsts = edges_of_bands(1024, num, den)
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = shingles(text, width)
                n = len(own)
                if n == 0:
                    rows.append((0, None, None, None, None, None, None))
                    continue
                with np.errstate(over="ignore"):
                    h1 = int(_signed(mixed(own, 1000 + seed).sum(keepdims=True))[0])
                    h2 = int(_signed(mixed(own, 2000 + seed).sum(keepdims=True) * np.uint64(n))[0])
                if doc is None or h1 in seen:  # linked with nothing, or this task has already put out keys for an equal set
                    rows.append((n, h1, h2, None, None, None, None))
                    continue
                seen.add(h1)
                while firsts[-2] <= n:
                    firsts = edges_of_bands(2 * firsts[-1], num, den)
                band = int(np.searchsorted(firsts, n, side="right")) - 1
                made = []
                for low in (band - 1, band):  # the pairs of bands that its band is in
                    allowed = differences(2 * (firsts[low + 2] - 1), num, den) if low >= 0 else 0
                    made.append((block_keys(own, low + 1, allowed), sketch(own, allowed)))
                rows.append((n, h1, h2, made[0][0], made[1][0], made[0][1], made[1][1]))
            part = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(part[0], pa.int64()),
                    pa.array(part[1], pa.int64()),
                    pa.array(part[2], pa.int64()),
                    *[lists([None if v is None else _signed(v) for v in x], pa.int64(), np.int64) for x in part[3:]],
                ],
                names=["doc_id", "n", "h1", "h2", "keys0", "keys1", "sketch0", "sketch1"],
            )

    return run


def _checked(width: int, num: int, den: int):
    """Keeps the pairs whose whole texts are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)
        for batch in batches:
            hub, other, hub_text, text = (batch.column(i).to_pylist() for i in range(4))
            keep = []
            for i in range(len(hub)):
                if last[0] != hub[i]:
                    last = (hub[i], shingles(hub_text[i], width))
                own = shingles(text[i], width)
                common = len(np.intersect1d(last[1], own, assume_unique=True))
                if den * common >= num * (len(last[1]) + len(own) - common):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int64())), batch.column(1).take(pa.array(keep, pa.int64()))],
                names=["a", "b"],
            )

    return run


def hamming(a: Column, b: Column) -> Column:
    parts = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(parts, F.lit(0), lambda total, x: total + x)


def verified(pairs: DataFrame, texts: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Of the pairs (a, b) of document ids, those with Jaccard similarity of num/den at least."""
    one = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("b_text"))
    two = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("a_text"))
    both = pairs.join(one, "b").join(two, "a").select("a", "b", "a_text", "b_text")
    return both.mapInArrow(_checked(width, num, den), "a long, b long")


def jaccard_join(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    num: int = 8,
    den: int = 10,
) -> DataFrame:
    """Groups of documents whose sets of word shingles are linked by Jaccard >= ``num / den``.

    Returns one row per document: doc_id, n_shingles, component_id (smallest id reachable by
    links, its own included), class_id (smallest id with an equal set; null without words).

    Words lie between ASCII white space, A-Z in lower case. A text with fewer than ``width`` words
    has the whole sequence as its one shingle; a null or empty one has none and is linked with
    nothing. Rows that share an id are one document only if their texts are equal; a null id is
    kept and linked with nothing. Extra columns are ignored. An empty table gives an empty result.

    Method: the symmetric difference of two linked sets is at most
    ``(den - num) * (|A| + |B|) / (den + num)``, and the Hamming distance of parity sketches never
    exceeds it. In each pair of neighbouring size bands the sketch has one block more than that
    bound, so linked sets share a block, which is the join key (see :func:`block_keys`). Equal sets count as one class, and a
    task puts out the keys of a class once. In each key's bucket all classes are checked against one
    hub, the class with most documents. Buckets that then still hold several components are joined with themselves, under the
    Hamming bound as join condition, across components only. So a bucket of n copies costs n
    checks, and no link between different texts is lost. Checks read whole texts.
    """
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    seed = 0
    while True:
        prints = settle(own.mapInArrow(_prints(width, num, den, seed), _PRINTS))
        classes = settle(
            prints.where("h1 is not null and doc_id is not null")
            .groupBy("h1")
            .agg(F.min("doc_id").alias("rep"), F.min("n").alias("n"), F.count(F.lit(1)).alias("size"),
                 F.min("h2").alias("low"), F.max("h2").alias("high"))
        )
        if classes.where("low <> high").isEmpty():
            break
        seed += 1  # two sets shared a 64-bit hash but not the second one: hash anew

    spread = prints.where("keys0 is not null and doc_id is not null").select(
        "h1", F.posexplode(F.array("keys0", "keys1")).alias("side", "keys")
    ).select("h1", F.col("side").cast("byte").alias("side"), F.explode("keys").alias("key"))
    bucket = Window.partitionBy("key")
    shared = (
        spread.select("*", F.min("h1").over(bucket).alias("low"), F.max("h1").over(bucket).alias("high"))
        .where("low <> high")
        .select("key", "side", "h1")
        .distinct()
    )
    # The hub of a bucket is its class with most documents: of a text and its altered copies, the text.
    largest = F.max(F.struct("size", (-F.col("rep")).alias("last"), "n")).over(bucket)
    shared = shared.join(classes.select("h1", "rep", "n", "size"), "h1").select("key", "side", "h1", "rep", "n", largest.alias("top"))
    shared = settle(shared.select("key", "side", "h1", "rep", "n", (-F.col("top.last")).alias("hub"), F.col("top.n").alias("hub_n")))
    near = den * F.least("n", "hub_n") >= num * F.greatest("n", "hub_n")
    first = settle(
        shared.where(near & (F.col("rep") != F.col("hub"))).select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    )
    wanted = shared.select(F.col("rep").alias("doc_id")).distinct()
    texts = own.join(wanted, "doc_id", "left_semi").where(F.col("text").isNotNull())
    texts = settle(texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.count(F.lit(1)).alias("n")).drop("n"))
    links = settle(verified(first, texts, width, num, den))

    # What a hub has not joined: buckets that still hold several components.
    label = components(links)
    member = shared.join(
        label.select(F.col("node").alias("rep"), "component"), "rep", "left"
    ).withColumn("component", F.coalesce("component", "rep"))
    mixed_keys = member.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    open_rows = settle(member.join(mixed_keys.select("key"), "key").select("key", "side", "h1", "rep", "n", "component").distinct())
    if not open_rows.isEmpty():
        marks = settle(
            prints.where("keys0 is not null").join(open_rows.select("h1").distinct(), "h1", "left_semi")
            .select("h1", "sketch0", "sketch1").dropDuplicates(["h1"])
        )
        drawn = open_rows.join(marks, "h1").select(
            "key", "side", "rep", "n", "component", F.when(F.col("side") == 0, F.col("sketch0")).otherwise(F.col("sketch1")).alias("sketch")
        )
        x, y = drawn.alias("x"), drawn.alias("y")
        total = F.col("x.n") + F.col("y.n")
        second = (
            x.join(
                y,
                (F.col("x.key") == F.col("y.key"))
                & (F.col("x.side") + F.col("y.side") > 0)  # two of one band meet as its lower band's, too
                & (F.col("x.rep") < F.col("y.rep"))
                & (F.col("x.component") != F.col("y.component"))
                & (den * F.least("x.n", "y.n") >= num * F.greatest("x.n", "y.n"))
                & (hamming(F.col("x.sketch"), F.col("y.sketch")) * (den + num) <= total * (den - num)),
            )
            .select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))
            .distinct()
            .join(first, ["a", "b"], "left_anti")
            .join(first.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_anti")
        )
        more = settle(verified(second, texts, width, num, den))
        if not more.isEmpty():
            label = components(links.unionByName(more))

    named = classes.join(label.withColumnRenamed("node", "rep"), "rep", "left").select(
        "h1", F.col("rep").alias("class_id"), F.coalesce("component", "rep").alias("component_id"), F.col("size").alias("n")
    )
    rows = prints.select("doc_id", F.col("n").alias("n_shingles"), "h1")
    out = salted_join(rows, named.drop("n"), ["h1"], "left", sizes=named.select("h1", "n"))
    alone = F.col("doc_id").isNull()
    return out.select(
        "doc_id",
        "n_shingles",
        F.when(alone, F.lit(None)).otherwise(F.coalesce("component_id", "doc_id")).alias("component_id"),
        F.when(~alone, F.col("class_id")).alias("class_id"),
    )


shipped(__name__)

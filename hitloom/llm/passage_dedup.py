"""Substring dedup: paragraphs and runs picked by content, MinHash bands, parity marks, exact checks, components, common runs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hitloom.llm.graph import components
from hitloom.llm.words import ODD, hashed, mixed, shingled, shipped
from hitloom.operators.skew import salted_join
from hitloom.session import freed_shuffles, settle

LENGTH = 16  # words of a run
EVERY = 34  # a run begins in each so many words
WIDTH = 5
PIECE = 1 << 17  # words that are hashed together
RECALL = 0.95
ROWS = 2
CELLS = 48  # parities in a mark
SIZE = 16  # bits of a mark that hold a number of shingles

_PRINTS = (
    "doc_id long, digest long, n long, starts array<long>, spans array<long>, contents array<long>, bands array<long>,"
    " fresh array<int>, marks array<long>"
)


def tuned_bands(similarity: float, rows: int = ROWS, recall: float = RECALL) -> int:
    """Least number of bands of ``rows`` hashes that bring together so large a share of similar pairs."""
    bands = 1
    while 1 - (1 - similarity**rows) ** bands < recall:
        bands += 1
    return bands


def _windowed(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` over each run of ``width`` values, by doubling."""
    done, out = 1, x
    while done < width:
        step = min(done, width - done)
        out = best(out[: len(out) - step], out[step:])
        done += step
    return out


def starts_of(words: np.ndarray, sizes: np.ndarray, length: int, every: int) -> tuple[np.ndarray, np.ndarray]:
    """Where runs begin in texts of ``sizes`` words, laid end to end in ``words``.

    Returns the text and the word position in it of each run, in order. A position is one if
    the hash of the three words from it is the least in some run of ``every`` positions of its text,
    or among all if there are fewer. So a passage of ``length + every - 1`` words has a run of
    its own wherever it stands, and the same one in every document. Each text has ``length`` words
    at least.
    """
    usable = sizes - length + 1
    room = np.maximum(usable, every)
    texts = np.repeat(np.arange(len(sizes)), usable)
    at = np.arange(usable.sum()) - np.repeat(np.cumsum(usable) - usable, usable)
    key = mixed(shingled(words, 3)[at + (np.cumsum(sizes) - sizes)[texts]], 77) | np.uint64(1)
    first = np.cumsum(room) - room
    spot = at + first[texts]
    padded = np.full(room.sum(), np.iinfo(np.uint64).max)
    padded[spot] = key
    low = _windowed(padded, every, np.minimum)
    whole = np.zeros(len(padded) + 1, np.int64)  # runs that lie within one text
    whole[first] += 1
    whole[first + room - every + 1] -= 1
    low[np.cumsum(whole)[: len(low)] == 0] = 0
    pad = np.zeros(every - 1, np.uint64)
    best = _windowed(np.concatenate([pad, low, pad]), every, np.maximum)[spot] == key
    return texts[best], at[best]


def spread(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions ``start .. start + count`` of all in a row, how far each is from its start, and where each begins."""
    first = np.cumsum(counts) - counts
    within = np.arange(counts.sum()) - np.repeat(first, counts)
    return np.repeat(starts, counts) + within, within, first


def unit_grams(words: np.ndarray, starts: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Five-word shingles of the units at ``starts``, laid end to end, and how many each has; one under that length is one shingle."""
    counts = np.maximum(spans - WIDTH + 1, 1)
    at, _, first = spread(starts, counts)
    grams = shingled(words, WIDTH)[np.minimum(at, max(0, len(words) - WIDTH))]
    for k in np.unique(spans[spans < WIDTH]):
        grams[first[spans == k]] = shingled(words, k)[starts[spans == k]]
    return grams, counts


def marks(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Number of distinct shingles of each unit (low ``SIZE`` bits, at most all ones) and the parities of how many fall into each cell.

    Sets that differ in k shingles differ in k parities at most. Shingles are told apart by the
    bits that a unit's number leaves of 64.
    """
    room = np.uint64(64 - max(1, (len(counts) - 1).bit_length()))
    key = np.sort((np.repeat(np.arange(len(counts), dtype=np.uint64), counts) << room) | (mixed(grams, 99) >> (np.uint64(64) - room)))
    key = key[np.r_[True, key[1:] != key[:-1]]]
    sizes = np.bincount((key >> room).astype(np.int64), minlength=len(counts))
    cell = ((key & ((np.uint64(1) << room) - np.uint64(1))) >> (room - np.uint64(20))) % np.uint64(CELLS)
    odd = np.bitwise_xor.reduceat(np.uint64(1) << cell, np.cumsum(sizes) - sizes)
    return odd << np.uint64(SIZE) | np.minimum(sizes, (1 << SIZE) - 1).astype(np.uint64)


def signatures(words: np.ndarray, starts: np.ndarray, spans: np.ndarray, hashes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Content hash, MinHash values (one row per hash) and mark of the units of ``spans`` words at ``starts``."""
    at, within, first = spread(starts, spans)
    with np.errstate(over="ignore"):
        content = np.add.reduceat(mixed(words[at] * ODD[2] + within.astype(np.uint64) * ODD[3]), first)
        content = mixed(content * ODD[0] + spans.astype(np.uint64))
        grams, counts = unit_grams(words, starts, spans)
        first = np.cumsum(counts) - counts
        least = np.stack([np.minimum.reduceat(mixed(grams * ODD[k % 5], k), first) for k in range(hashes)])
    return content, least, marks(grams, counts)


def _pieces(texts: list[str | None], length: int) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, np.ndarray]]:
    """Hashed words of texts laid end to end, with their places in ``texts``, their sizes, and the sizes of their lines with words.

    A text of fewer than ``length`` words comes alone, one without words not at all. A piece ends
    with the text that fills it.
    """
    places: list[int] = []
    words: list[bytes] = []
    sizes: list[int] = []
    lines: list[int] = []
    for place, text in enumerate(texts):
        own: list[bytes] = []
        ends: list[int] = []
        for line in (text or "").encode("utf-8", "surrogatepass").lower().split(b"\n"):
            found = line.split()
            if found:
                own += found
                ends.append(len(found))
        if 0 < len(own) < length:
            yield [place], hashed(own), np.array([len(own)]), np.array(ends)
        elif own:
            places.append(place)
            words += own
            sizes.append(len(own))
            lines += ends
            if len(words) >= PIECE:
                yield places, hashed(words), np.array(sizes), np.array(lines)
                places, words, sizes, lines = [], [], [], []
    if places:
        yield places, hashed(words), np.array(sizes), np.array(lines)


def units_of(words: np.ndarray, sizes: np.ndarray, lines: np.ndarray, length: int, every: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word in it, and words of each unit: every line, and the runs of ``length`` words of :func:`starts_of`."""
    ends = np.cumsum(sizes)
    first = np.cumsum(lines) - lines
    owner = np.searchsorted(ends, first, side="right")
    if sizes[0] < length:
        texts, starts = np.zeros(int(len(lines) > 1), np.int64), np.zeros(int(len(lines) > 1), np.int64)
    else:
        texts, starts = starts_of(words, sizes, length, every)
    spans = np.minimum(length, sizes[texts])
    return np.concatenate([texts, owner]), np.concatenate([starts, first - (ends - sizes)[owner]]), np.concatenate([spans, lines])


def _printed(length: int, every: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.zeros(batch.num_rows, np.int64)
            none = np.array([], np.int64)
            found = []
            for places, words, sizes, lines in _pieces(batch.column("text").to_pylist(), length):
                n[places] = sizes
                texts, starts, spans = units_of(words, sizes, lines, length, every)
                content, least, mark = signatures(words, starts + (np.cumsum(sizes) - sizes)[texts], spans, bands * ROWS)
                with np.errstate(over="ignore"):
                    key = np.stack([mixed(least[ROWS * b] * ODD[0] + least[ROWS * b + 1], b) for b in range(bands)], axis=1)
                found.append((np.array(places)[texts], starts, spans, content.view(np.int64), key.view(np.int64), mark.view(np.int64)))
            if found:
                place, starts, spans, content, key, mark = (np.concatenate(x) for x in zip(*found))
                order = np.argsort(place, kind="stable")
                place, starts, spans, content, key, mark = (x[order] for x in (place, starts, spans, content, key, mark))
            else:
                place, starts, spans, content, key, mark = none, none, none, none, none.reshape(0, bands), none
            new = np.sort(np.unique(content, return_index=True)[1])
            rows = np.arange(batch.num_rows + 1)
            each, fresh = np.searchsorted(place, rows), np.searchsorted(place[new], rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("digest"), pa.array(n), _ragged(each, starts), _ragged(each, spans),
                 _ragged(each, content), _ragged(fresh * bands, key[new].reshape(-1)), _ragged(fresh, new - each[place[new]], pa.int32()), _ragged(fresh, mark[new])],
                names=["doc_id", "digest", "n", "starts", "spans", "contents", "bands", "fresh", "marks"],
            )

    return run


def _ragged(ends: np.ndarray, values: np.ndarray, kind: pa.DataType = pa.int64()) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values, kind))


def _read(length: int):
    """Five-word shingles of the wanted units of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contents, starts, spans = ([np.array(x, np.int64) for x in batch.column(c).to_pylist()] for c in ("contents", "starts", "spans"))
            for places, words, sizes, _ in _pieces(batch.column("text").to_pylist(), length):
                at = np.concatenate([starts[p] + before for p, before in zip(places, np.cumsum(sizes) - sizes)])
                grams, counts = unit_grams(words, at, np.concatenate([spans[p] for p in places]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([contents[p] for p in places])),
                     _ragged(np.concatenate([[0], np.cumsum(counts)]), grams.view(np.int64))],
                    names=["content", "grams"],
                )

    return run


def common_runs(new: np.ndarray, old: np.ndarray, length: int) -> list[tuple[int, int]]:
    """First word and end of the runs of ``new`` whose every ``length`` words, given by their hashes, are somewhere in ``old`` (sorted)."""
    at = np.flatnonzero(old[np.minimum(np.searchsorted(old, new), len(old) - 1)] == new)
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > length)
    return list(zip(at[np.r_[0, cut + 1]].tolist(), (at[np.r_[cut, len(at) - 1]] + length).tolist()))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as they are sent: compressed, with their size in bytes."""
    for batch in batches:
        texts = [x.encode("utf-8", "surrogatepass") for x in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("digest"), pa.array([len(x) for x in texts], pa.int64()),
             pa.array([pa.compress(x, codec="zstd", asbytes=True) for x in texts], pa.binary())],
            names=["text_id", "text_digest", "size", "body"],
        )


def _unpacked(batch: pa.RecordBatch, size: str, body: str) -> list[str]:
    return [
        pa.decompress(x, decompressed_size=n, codec="zstd", asbytes=True).decode("utf-8", "surrogatepass") if n else ""
        for n, x in zip(batch.column(size).to_pylist(), batch.column(body).to_pylist())
    ]


def _extended(length: int):
    """All runs of ``length`` words or more that a text has in common with the one that keeps a unit of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            news, olds = _unpacked(batch, "size", "body"), _unpacked(batch, "old_size", "old")
            runs: list[list[tuple[int, int]]] = [[] for _ in range(batch.num_rows)]
            order: list[str] = []  # each text that keeps something, followed by those it is compared with
            against: dict[int, tuple[int, int]] = {}
            at = 0
            for i, (new, old) in enumerate(zip(news, olds)):
                if not i or old != olds[i - 1]:
                    at = len(order)
                    order.append(old)
                against[len(order)] = (i, at)
                order.append(new)
            held: tuple = (-1, None)
            for places, words, sizes, _ in _pieces(order, length):
                if sizes[0] < length:
                    continue
                grams, before = shingled(words, length), np.cumsum(sizes) - sizes
                for place, first, size in zip(places, before, sizes):
                    own = grams[first : first + size - length + 1]
                    if place not in against:
                        held = (place, np.sort(own))
                    elif held[0] == against[place][1]:
                        runs[against[place][0]] = common_runs(own, held[1], length)
            flat = [(i, x, y) for i, found in enumerate(runs) for x, y in found]
            rows = pa.array([i for i, _, _ in flat], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(rows) for c in ("doc_id", "digest", "keep_id")],
                 pa.array([x for _, x, _ in flat], pa.int64()), pa.array([y for _, _, y in flat], pa.int64())],
                names=["doc_id", "digest", "keep_id", "start", "end"],
            )

    return run


def _similar(a: Column, b: Column, num: int, den: int) -> Column:
    common = F.size(F.array_intersect(a, b))
    return den * common >= num * (F.size(a) + F.size(b) - common)


def _possible(a: Column, b: Column, num: int, den: int) -> Column:
    """Whether sets with these marks can be so similar: never false of sets that are."""
    x, y = (c.bitwiseAND(F.lit((1 << SIZE) - 1)) for c in (a, b))
    odd = F.bit_count(F.shiftrightunsigned(a.bitwiseXOR(b), SIZE))
    return (odd * (den + num) <= (x + y) * (den - num)) & (den * F.least(x, y) >= num * F.greatest(x, y))


def _runs(spots: DataFrame) -> DataFrame:
    """Adds run: the number, in its text, of the run of touching spots (start, end) that a spot lies in."""
    by_doc = Window.partitionBy("doc_id", "digest").orderBy("start")
    before = by_doc.rowsBetween(Window.unboundedPreceding, -1)
    return spots.withColumn(
        "new", F.coalesce((F.col("start") > F.max("end").over(before)).cast("int"), F.lit(1))
    ).withColumn("run", F.sum("new").over(by_doc.rowsBetween(Window.unboundedPreceding, 0)))


def repeated_passages(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    every: int = EVERY,
    num: int = 8,
    den: int = 10,
    recall: float = RECALL,
) -> DataFrame:
    """Passages that an earlier document (smaller id) has too.

    Returns one row per passage to remove: doc_id, first_word, n_words (words between ASCII white
    space, from 0), keep_ids (sorted ids of the documents in which its paragraphs stay).

    Paragraphs are the lines with words, of any length, and, as passages also start and end within
    lines, runs of ``length`` words that begin where the text itself says so (see
    :func:`starts_of`). Paragraphs of equal words, A-Z in
    lower case, are one content. Contents that share a MinHash band are compared by exact Jaccard
    similarity of their five-word shingles; ``tuned_bands`` sets the bands for the wanted recall.
    Pairs whose marks (see :func:`marks`) rule that similarity out are left out first, which loses none.
    Each content of a band is checked against one hub; bands that still hold several components
    are joined with themselves across components, with the marks in the join condition. In each
    component the smallest document keeps its paragraphs; those of the others are removed. So is
    every run of ``length`` words or more that such a document has in common with the smallest one,
    up to its last equal word on either side. Overlapping removals are one passage.

    A repeated passage within lines is found for certain from ``length + every - 1`` words on; a
    shorter one if a run begins in it or the two documents share something else. A text of fewer words than ``length`` is one paragraph besides its lines; null and empty ones have none. Rows
    with a null id are not compared. Rows that share an id are one document to this operator.
    Extra columns are ignored. An empty table gives an empty result.
    """
    with freed_shuffles(docs.sparkSession):
        return _passages(docs, id_col, text_col, length, every, num, den, recall)


def _passages(docs: DataFrame, id_col: str, text_col: str, length: int, every: int, num: int, den: int, recall: float) -> DataFrame:
    bands = tuned_bands(num / den, ROWS, recall)
    own = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
        F.xxhash64(F.col(f"`{text_col}`")).alias("digest"),
    ).where("doc_id is not null and text is not null")
    prints = settle(own.mapInArrow(_printed(length, every, bands), _PRINTS))
    units = prints.select("doc_id", "n", "digest", F.explode(F.arrays_zip("starts", "spans", "contents")).alias("u")).select(
        "doc_id", "n", "digest", F.col("u.starts").alias("start"), F.col("u.spans").alias("span"), F.col("u.contents").alias("content")
    )
    equal = settle(
        units.groupBy("content").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n"))
        .where("first < last").drop("last")
    )

    banded = prints.select(F.posexplode(F.arrays_zip("fresh", "marks")).alias("i", "u"), "contents", "bands").select(
        F.get("contents", F.col("u.fresh")).alias("content"), F.col("u.marks").alias("mark"),
        F.explode(F.slice("bands", F.col("i") * bands + 1, bands)).alias("key"),
    )
    bucket = Window.partitionBy("key")
    near = _possible(F.col("mark"), F.col("hub.mark"), num, den) & (F.col("content") != F.col("hub.content"))
    shared = settle(
        banded.select("*", F.min(F.struct("content", "mark")).over(bucket).alias("hub"), F.max("content").over(bucket).alias("top"))
        .where("hub.content <> top")
        .select("key", "content", "mark", F.when(near, F.col("hub.content")).alias("near"), (F.col("content") == F.col("hub.content")).alias("is_hub"))
        .distinct()
    )
    first = settle(shared.where("near is not null").select(F.col("near").alias("a"), F.col("content").alias("b")).distinct())
    # A content of very many places is folded in each task, then joined; a semi-join would be moved below the fold.
    place = settle(
        units.withColumn("rank", F.xxhash64("doc_id", "digest", "start")).groupBy("content").agg(
            *[F.min_by(c, "rank").alias(c) for c in ("doc_id", "digest", "start", "span")]
        ).join(shared.select("content").distinct(), "content")
    )

    def verified(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("content")).distinct()
        asked = place.join(wanted, "content").groupBy("doc_id", "digest").agg(
            F.collect_list(F.struct("content", "start", "span")).alias("w")
        ).select("doc_id", "digest", F.col("w.content").alias("contents"), F.col("w.start").alias("starts"), F.col("w.span").alias("spans"))
        texts = settle(
            own.join(asked, ["doc_id", "digest"]).dropDuplicates(["doc_id", "digest"])
            .select("text", "contents", "starts", "spans").mapInArrow(_read(length), "content long, grams array<long>")
            .select("content", F.array_distinct("grams").alias("grams"))
        )
        x = texts.select(F.col("content").alias("a"), F.col("grams").alias("a_grams"))
        y = texts.select(F.col("content").alias("b"), F.col("grams").alias("b_grams"))
        return settle(pairs.join(y, "b").join(x, "a").where(_similar(F.col("a_grams"), F.col("b_grams"), num, den)).select("a", "b"))

    links = verified(first)
    label = components(links)
    member = shared.drop("near").join(label.withColumnRenamed("node", "content"), "content", "left").withColumn(
        "component", F.coalesce("component", "content")
    )
    open_rows = settle(
        member.select("*", F.min("component").over(bucket).alias("x"), F.max("component").over(bucket).alias("y")).where("x <> y")
        .select("key", "content", "mark", "is_hub", F.when(F.col("component") != F.col("content"), F.col("component")).alias("component"))
    )
    open_rows = open_rows.withColumn("component", F.coalesce("component", "content"))
    x, y = open_rows.alias("x"), open_rows.alias("y")
    close = settle(
        x.join(
            y,
            (F.col("x.key") == F.col("y.key")) & (F.col("x.content") < F.col("y.content"))
            & ~F.col("x.is_hub") & (F.col("x.component") != F.col("y.component"))
            & _possible(F.col("x.mark"), F.col("y.mark"), num, den),
        )
        .select(F.col("x.content").alias("a"), F.col("y.content").alias("b")).distinct()
    )
    if not close.isEmpty():
        label = components(links.unionByName(verified(close)))

    # Documents of each component: those of its contents.
    linked = label.withColumnRenamed("node", "content")
    spots = units.groupBy("content").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).join(linked.select("content"), "content")
    known = equal.unionByName(spots).groupBy("content").agg(F.min("first").alias("first"), F.max("n").alias("n"))
    named = known.join(linked, "content", "left").withColumn("component", F.coalesce("component", "content"))
    keeper = settle(named.select("content", "n", F.min("first").over(Window.partitionBy("component")).alias("keep_id")))
    hits = settle(
        salted_join(units, keeper.drop("n"), ["content"], sizes=keeper.select("content", "n")).where("doc_id > keep_id")
        .select("doc_id", "digest", "n", "start", (F.col("start") + F.col("span")).alias("end"), "keep_id")
    )

    # Common runs of a text and those that keep something of it, unless all of it goes already.
    gone = _runs(hits).groupBy("doc_id", "digest", "run").agg((F.max("end") - F.min("start")).alias("size"), F.max("n").alias("n"))
    partly = gone.groupBy("doc_id", "digest").agg(F.sum("size").alias("size"), F.max("n").alias("n")).where("size < n").select("doc_id", "digest")
    pairs = settle(hits.select("doc_id", "digest", "keep_id").distinct().join(partly, ["doc_id", "digest"]))
    asked = pairs.select(F.col("doc_id").alias("text_id"), "doc_id", "digest", "keep_id").unionByName(
        pairs.select(F.col("keep_id").alias("text_id"), "keep_id").distinct(), allowMissingColumns=True
    )
    packed = own.mapInArrow(_packed, "text_id long, text_digest long, size long, body binary")
    sent = settle(
        packed.join(asked, "text_id").where("digest is null or digest = text_digest")
        .dropDuplicates(["text_id", "text_digest", "doc_id", "keep_id"]).select("doc_id", "digest", "keep_id", "size", "body")
    )
    old = sent.where("doc_id is null").select("keep_id", F.col("size").alias("old_size"), F.col("body").alias("old"))
    sizes = pairs.groupBy("keep_id").agg(F.count(F.lit(1)).alias("n"))
    both = salted_join(sent.where("doc_id is not null"), old, ["keep_id"], sizes=sizes)
    more = both.mapInArrow(_extended(length), "doc_id long, digest long, keep_id long, start long, end long")
    runs = _runs(hits.drop("n").unionByName(more))
    return settle(
        runs.groupBy("doc_id", "digest", "run").agg(
            F.min("start").alias("first_word"), (F.max("end") - F.min("start")).alias("n_words"),
            F.sort_array(F.collect_set("keep_id")).alias("keep_ids"),
        ).select("doc_id", "first_word", "n_words", "keep_ids").distinct()
    )


shipped(__name__)

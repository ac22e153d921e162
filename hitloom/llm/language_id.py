"""Language identification: nearest of several clustered centroids per language, by cosine of TF-IDF n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.llm.words import shipped

BUCKETS = 1 << 13  # places that n-grams are hashed to
ORDERS = (2, 3, 4)  # bytes in an n-gram
CENTROIDS = 4  # clusters per language
SAMPLE = 2048  # texts per language, about, that the clusters are fitted on
ROUNDS = 12  # of clustering
TAIL = 0.005  # share of a cluster's own texts that lie beyond its radius
SHARPNESS = 30.0  # of the score: how fast a smaller cosine loses its share
ROWS = 256  # texts whose vectors are held at once

#: Letters stay; all other ASCII is a gap.
_LETTERS = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))


class Model(NamedTuple):
    """What prediction needs; its size depends on the number of languages only."""

    langs: list[str]  # language of each centroid
    centroids: np.ndarray  # one normalised row each
    radii: np.ndarray  # cosine distance beyond which a text is of no learned language
    weights: np.ndarray  # inverse document frequency of each bucket


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def counts(text: str) -> np.ndarray:
    """How often each bucket's n-grams occur in the whole text, between gaps of any length."""
    raw = text.lower().encode("utf-8", "replace").translate(_LETTERS).split()
    data = np.frombuffer(b" " + b" ".join(raw) + b" " * max(ORDERS), dtype=np.uint8).astype(np.uint32)
    n = len(data) - max(ORDERS) + 1
    total = np.zeros(BUCKETS, dtype=np.int64)
    gram = np.zeros(n, dtype=np.uint32)
    for k in range(max(ORDERS)):
        gram = (gram << np.uint32(8)) | data[k : k + n]
        if k + 1 in ORDERS:
            mixed = (gram + np.uint32(k + 1)) * np.uint32(0x9E3779B1)
            total += np.bincount((mixed ^ (mixed >> np.uint32(15))) % np.uint32(BUCKETS), minlength=BUCKETS)
    return total


def vectors(texts: list[str | None], weights: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF rows; a null text gives zeros."""
    out = np.zeros((len(texts), BUCKETS), dtype=np.float32)
    for row, text in zip(out, texts, strict=True):
        if text is not None:
            row[:] = np.log1p(counts(text)) * weights
    norm = np.sqrt((out.astype(np.float64) ** 2).sum(axis=1, keepdims=True))
    return np.divide(out, norm, out=out, where=norm > 0, casting="same_kind")


def bucket_weights(rows: DataFrame, text_col: str) -> np.ndarray:
    """Inverse document frequency of each bucket over all rows: each task sends one row per bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                held += counts(text or "") > 0
                n += 1
        at = np.append(np.flatnonzero(held), -1)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(held, n)[at])], names=["bucket", "n"])

    found = rows.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(count, "bucket long, n long")
    total = {r.bucket: r.n for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}  # BUCKETS + 1 rows
    held = np.array([total.get(b, 0) for b in range(BUCKETS)], dtype=np.float64)
    return (np.log((1 + total.get(-1, 0)) / (1 + held)) + 1).astype(np.float32)


def clustered(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spherical k-means from far-apart rows: centroids, each row's own, its cosine with it."""
    centre = x.mean(axis=0)
    first = [int(np.argmax(x @ centre))]
    best = x @ x[first[0]]
    while len(first) < k and best.min() < 1 - 1e-6:
        first.append(int(np.argmin(best)))
        best = np.maximum(best, x @ x[first[-1]])
    c = x[first]
    for _ in range(ROUNDS):
        own = (x @ c.T).argmax(axis=1)
        # Half of a cluster's centre is the language's: a few odd texts make no centroid of their own.
        sums = np.stack([(x[own == i].sum(axis=0) + centre * max(1, len(x) / (4 * k))) for i in range(len(c))])
        c = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    near = x @ c.T
    return c, near.argmax(axis=1), near.max(axis=1)


def fit(
    rows: DataFrame, *, text_col: str = "text", lang_col: str = "lang", key: Column | None = None, sample: int = SAMPLE,
    centroids: int = CENTROIDS,
) -> Model:
    """Learns from rows with a text that has a letter and a non-null language.

    Document frequencies come from all of them. The clusters of a language are fitted on about
    ``sample`` of its texts, those with the least hash of ``key`` (default: the text), whatever the
    table's size; that is the only bound. A language is one group of that size. Repeated rows
    count as often as they stand; an empty table gives a model without centroids.
    """
    text = F.col(f"`{text_col}`")
    hashed = F.xxhash64(text if key is None else key)
    known = rows.where(text.rlike(r"\p{L}") & F.col(f"`{lang_col}`").isNotNull()).select(
        text.alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"),
        (F.shiftrightunsigned(hashed, 11) / F.lit(float(1 << 53))).alias("place"),
    )
    weights = bucket_weights(known, "text")
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    drawn = known.join(F.broadcast(sizes), "lang").where(F.col("place") < F.lit(float(sample)) / F.col("n"))

    def cluster(pdf: pd.DataFrame) -> pd.DataFrame:
        x = vectors(pdf.sort_values(["place", "text"])["text"].tolist(), weights)
        c, own, near = clustered(x, centroids)
        # Members as a whole, not a cluster's own few, say how far texts of the language lie.
        radii = [float(np.quantile(1 - near[own == i], 1 - TAIL)) if (own == i).any() else 0.0 for i in range(len(c))]
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "at": range(len(c)), "centroid": [r.tolist() for r in c], "radius": radii})

    made = drawn.groupBy("lang").applyInPandas(cluster, "lang string, at int, centroid array<float>, radius double")
    found = made.orderBy("lang", "at").collect()  # ``centroids`` rows per language
    return Model(
        [r.lang for r in found],
        np.array([r.centroid for r in found], dtype=np.float32).reshape(-1, BUCKETS),
        np.array([r.radius for r in found]),
        weights,
    )


def predict(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, nearest, score, distance, rejected, lang.

    ``nearest`` is the language of the nearest centroid, null if the text is null or has no letter
    (or nothing was learned). ``distance`` is one less the cosine; a text beyond the radius of its
    nearest centroid is ``rejected`` and has no ``lang``. ``score`` is the share of the nearest
    language among all, by cosine; 0 where there is none. Whole texts are read; nothing is shuffled.
    """

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = sorted(set(model.langs))
        of = np.array([langs.index(x) for x in model.langs])
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                texts = [t if langs and has_letter(t) else None for t in part.column(1).to_pylist()]
                near = vectors(texts, model.weights) @ model.centroids.T
                none = np.array([t is None for t in texts])
                if not langs:
                    names, score, distance, out = [None] * len(texts), np.zeros(len(texts)), np.ones(len(texts)), none
                else:
                    best = near.argmax(axis=1)
                    top = near[np.arange(len(best)), best].astype(np.float64)
                    each = np.stack([near[:, of == i].max(axis=1) for i in range(len(langs))], axis=1)
                    share = np.exp(SHARPNESS * (each - top[:, None])).sum(axis=1)
                    names = [None if n else model.langs[b] for n, b in zip(none, best, strict=True)]
                    score, distance = np.where(none, 0.0, 1 / share), np.where(none, 1.0, 1 - top)
                    out = none | (distance > model.radii[best])
                kept = [None if r else x for r, x in zip(out, names, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(distance),
                     pa.array(out), pa.array(kept, pa.string())],
                    names=["doc_id", "nearest", "score", "distance", "rejected", "lang"],
                )

    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        name, f"doc_id {kind}, nearest string, score double, distance double, rejected boolean, lang string"
    )


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning: one in four, by the id; a null id is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Predicts the language of every row with a model learned from the rows that are not held out.

    A null language teaches nothing but is predicted; extra columns are ignored; an empty table
    gives an empty result. See :func:`fit` and :func:`predict`.
    """
    taught = docs.where(~held_out(F.col(f"`{id_col}`")))
    return predict(docs, fit(taught, text_col=text_col, lang_col=lang_col), id_col=id_col, text_col=text_col)


shipped(__name__)

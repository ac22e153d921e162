"""Words and 64-bit hashes of texts, for code that runs inside tasks on one text at a time."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle

ODD = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    dtype=np.uint64,
)


def shipped(name: str) -> None:
    """Send the functions of a module to executors by value, so that they need no copy of it."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A well-mixed 64-bit value of each unsigned 64-bit value."""
    with np.errstate(over="ignore"):
        x = x ^ np.uint64((seed * 0x9E3779B97F4A7C15 + 0x2545F4914F6CDD1D) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def ascii_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, with A-Z in lower case, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def shingled(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words in order; of the whole sequence if it is shorter."""
    n = len(words)
    if n == 0:
        return words
    k = min(n, width)
    with np.errstate(over="ignore"):
        total = np.full(n - k + 1, k, dtype=np.uint64)
        for i in range(k):
            total = mixed(total * ODD[1] + words[i : n - k + 1 + i])
    return total


def lists(values: list[np.ndarray | None], kind: pa.DataType, dtype: type) -> pa.ListArray:
    """A column of lists from one array (or None) per row."""
    sizes = np.array([0 if v is None else len(v) for v in values], dtype=np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    full = [v for v in values if v is not None and len(v)]
    flat = np.concatenate(full) if full else np.array([], dtype=dtype)
    offsets = pa.array(ends, mask=np.array([v is None for v in values] + [False]) if None in _kinds(values) else None)
    return pa.ListArray.from_arrays(offsets, pa.array(flat.astype(dtype), type=kind))


def _kinds(values: list) -> set:
    return {None} if any(v is None for v in values) else set()


shipped(__name__)

"""Packing by bounded-space best fit: a few open windows per task, leftovers merged last."""

from __future__ import annotations

import re
import uuid
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.llm.words import shipped
from hitloom.session import shared_folder

WINDOW = 2048
OPEN = 32  # windows that a task holds open
SLACK = 16  # unused places that a window may be put out with
END = 1
MERGED = 32  # tasks whose leftovers are merged together
CACHED = 300_000  # words whose ids a task keeps

_PIECES = (
    "doc_id long, start long, length long, doc_tokens long, ids binary, sequence_id long, offset long, done boolean, grp int"
)
_NAMES = ["doc_id", "start", "length", "doc_tokens", "ids", "sequence_id", "offset", "done", "grp"]
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([,.]?)")


class Encoder(dict):
    """Token ids (unsigned 32-bit, little-endian) of words between spaces; new ones are encoded on first use.

    The tokenizer never joins text across a space, so the ids of a text are those of its words.
    Plain words share the ids of their lower-case letters, which form one unit of the tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True  # their strings in a text are text
        self.letters: dict[str, bytes] = {}
        # Byte-level alphabet: printable bytes stand for themselves, others for code points from 256 on.
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(kept)]
        self.alphabet = {b: b for b in kept} | {b: 256 + i for i, b in enumerate(rest)}
        self.plain = self._agree()

    def _agree(self) -> bool:
        """Whether units of the tokenizer's model are what the short way takes them for."""
        try:
            return all(self._unit(w.lower()) == self._full(w) for w in ("Token", "straße", "Éà", "x", "internationalisation"))
        except Exception:  # noqa: BLE001  a tokenizer of another kind: every word goes the long way
            return False

    def _full(self, text: str) -> bytes:
        return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()

    def _unit(self, word: str) -> bytes:
        piece = word if word.isascii() else word.encode().decode("latin-1").translate(self.alphabet)
        return array("I", [t.id for t in self.whole.model.tokenize(piece)]).tobytes()

    def __missing__(self, word: str) -> bytes:
        if len(self) > CACHED:
            self.clear()
            self.letters.clear()
        plain = _PLAIN.fullmatch(word) if self.plain else None
        if plain is None:
            ids = self._full(word)
        else:
            low = plain[1].lower()
            ids = self.letters.get(low)
            if ids is None:
                ids = self.letters[low] = self._unit(low)
            if plain[2]:
                ids += self[plain[2]]
        self[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        return b"".join([self[w] for w in text.replace("\n", " ").split(" ")])


class Windows:
    """A bounded number of open windows. A piece is (doc_id, start, doc_tokens, ids)."""

    def __init__(self, size: int, most: int, slack: int):
        self.size, self.most, self.slack = size, most, slack
        self.free: list[tuple[int, int]] = []  # (places, number), ascending
        self.inside: dict[int, list[tuple]] = {}
        self.made = 0
        self.full: list[list[tuple]] = []

    def add(self, doc, start: int, total: int, ids: bytes) -> None:
        while ids:
            n = len(ids) // 4
            if n >= self.size:
                self.full.append([(doc, start, total, ids[: 4 * self.size])])
                ids, start = ids[4 * self.size :], start + self.size
                continue
            at = bisect_left(self.free, (n, -1))
            if at == len(self.free):  # fits in none
                if len(self.free) < self.most:
                    self.inside[self.made] = []
                    insort(self.free, (self.size, self.made))
                    self.made += 1
                    continue
                places, number = self.free[0]
                if places > self.slack:  # the fullest is topped up with the head
                    self.inside[number].append((doc, start, total, ids[: 4 * places]))
                    ids, start = ids[4 * places :], start + places
                self._emit(0)
                continue
            places, number = self.free.pop(at)
            self.inside[number].append((doc, start, total, ids))
            insort(self.free, (places - n, number))
            if places == n:
                self._emit(0)
            return

    def _emit(self, at: int) -> None:
        self.full.append(self.inside.pop(self.free.pop(at)[1]))

    def taken(self) -> list[list[tuple]]:
        out, self.full = self.full, []
        return out


def _rows(sequences: list[list[tuple]], first: int, done: bool, grp: int) -> list[tuple]:
    out = []
    for k, pieces in enumerate(sequences):
        offset = 0
        for doc, start, total, ids in pieces:
            out.append((doc, start, len(ids) // 4, total, ids, first + k, offset, done, grp))
            offset += len(ids) // 4
    return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.binary()] + [pa.int64()] * 2 + [pa.bool_(), pa.int32()]
    parts = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(p, k) for p, k in zip(parts, kinds)], names=_NAMES)


def _packed(path: str, size: int, most: int, slack: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        base, tail = part << 32, array("I", [end]).tobytes()
        encoder, windows, made = Encoder(path), Windows(size, most, slack), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                few = batch.slice(at, 500)
                for doc, text in zip(few.column(0).to_pylist(), few.column(1).to_pylist()):
                    ids = encoder.ids(text or "") + tail
                    windows.add(doc, 0, len(ids) // 4, ids)
                full = windows.taken()
                if full:
                    yield _batch(_rows(full, base + made, True, part // MERGED))
                    made += len(full)
        if windows.inside:
            yield _batch(_rows(list(windows.inside.values()), base + made, False, part // MERGED))

    return run


def _merged(size: int, slack: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """Open windows of some tasks: the fuller ones go whole into new windows by best fit; what is
        still not full is cut to fill windows, and one stays open."""
        grp = int(rows["grp"].iloc[0])
        units = []
        for _, own in rows.sort_values(["sequence_id", "offset"]).groupby("sequence_id", sort=True):
            units.append([(r.doc_id, r.start, r.doc_tokens, r.ids) for r in own.itertuples()])
        length = lambda unit: sum(len(p[3]) for p in unit) // 4
        free: list[tuple[int, int]] = []
        bins: list[list[tuple]] = []
        for unit in sorted(units, key=length, reverse=True):
            n = length(unit)
            at = bisect_left(free, (n, -1))
            if at == len(free):
                insort(free, (size - n, len(bins)))
                bins.append(list(unit))
            else:
                places, number = free.pop(at)
                bins[number] += unit
                insort(free, (places - n, number))
        done = [bins[number] for places, number in free if places <= slack]
        now, left = [], size
        for piece in (p for places, number in reversed(free) if places > slack for p in bins[number]):
            doc, start, total, ids = piece
            while ids:
                now.append((doc, start, total, ids[: 4 * left]))
                used = len(now[-1][3]) // 4
                ids, start, left = ids[4 * left :], start + used, left - used
                if not left:
                    done.append(now)
                    now, left = [], size
        if now:
            done.append(now)
        return pd.DataFrame(_rows(done, (1 << 62) + (grp << 32), True, grp), columns=_NAMES)

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = WINDOW,
    most_open: int = OPEN,
    slack: int = SLACK,
    end_id: int = END,
) -> DataFrame:
    """Packs token ids of all documents into sequences of at most ``size``.

    Returns one row per piece: doc_id, start (the document's ids before it), length, doc_tokens
    (with the end id), ids (binary, unsigned 32-bit little-endian), sequence_id, offset (of the
    piece in its sequence, without gaps).

    Each task keeps ``most_open`` windows open. A document's full windows go out at once; the rest
    goes where it fits best. If it fits nowhere, the fullest window goes out, topped up with the
    head of the document if more than ``slack`` places were empty. Windows still open at a task's
    end are merged, ``MERGED`` tasks at a time. No document is shuffled.

    A null or empty text is the end id alone. A null id is kept. Repeated rows are packed as often
    as they occur. Extra columns are ignored. An empty table gives an empty result. A task holds
    its open windows, one Arrow batch and the ids of ``CACHED`` words.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    path = f"{shared_folder(docs.sparkSession)}/packed-{uuid.uuid4().hex}"
    made = rows.mapInArrow(_packed(tokenizer, size, most_open, slack, end_id), _PIECES)
    made.write.option("compression", "zstd").parquet(path)
    pieces = docs.sparkSession.read.schema(made.schema).parquet(path)
    rest = pieces.where("not done").groupBy("grp").applyInPandas(_merged(size, slack), _PIECES)
    return pieces.where("done").unionByName(rest).drop("done", "grp")


shipped(__name__)

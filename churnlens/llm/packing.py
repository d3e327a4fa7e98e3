"""Packing of documents into training sequences by vector bin packing.

A sequence has three limits at once: ids, segments, and ids that bear loss. Pieces are vectors of
these three; the piece with the greatest dot product with what is left of the open sequence goes
in, both measured in shares of the limits. When nothing fits whole, a piece is cut to fill the
sequence. What is left over at the end of a task is cut into sequences whose lengths are powers
of two, which need no padding.

Each task packs the documents of its own partition, a bounded run at a time: no shuffle, no
global state, and the same result when a task runs again.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .text import slices, texts_of
from .tokens import encoder

RUN_TOKENS = 1 << 20
#: Pieces of text a task remembers; beside them it holds a batch of texts and a run of ids.
KEEP_PIECES = 400_000


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold."""

    tokens: int = 2048
    segments: int = 512
    loss: int = 2048


@dataclass
class Piece:
    """Ids ``start`` to ``start + length`` of document ``doc``, of which those from ``free`` on
    (counted within the document) bear loss."""

    doc: int
    start: int
    length: int
    free: int

    @property
    def loss(self) -> int:
        return self.start + self.length - max(self.start, min(self.free, self.start + self.length))

    def head(self, tokens: int, loss: int) -> int:
        """Ids at the front that keep within both limits."""
        silent = max(0, min(self.free - self.start, self.length))
        return min(self.length, tokens, silent + loss)

    def cut(self, length: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc, self.start, length, self.free),
            Piece(self.doc, self.start + length, self.length - length, self.free),
        )


class _Waiting:
    """Pieces by their vector. Those of one vector are worth the same and leave in turn, so a
    choice costs as many products as there are different vectors, not pieces."""

    def __init__(self, pieces: list[Piece]):
        self.count, self.place = 0, {}
        self.groups: list[deque[Piece]] = []
        self.size, self.here = np.zeros((64, 3)), np.zeros(64, bool)
        for piece in pieces:
            self.add(piece)

    def add(self, piece: Piece) -> None:
        vector = (piece.length, piece.loss)
        at = self.place.get(vector)
        if at is None:
            at = self.place[vector] = len(self.groups)
            self.groups.append(deque())
            if at == len(self.here):
                self.size = np.concatenate([self.size, np.zeros_like(self.size)])
                self.here = np.concatenate([self.here, np.zeros_like(self.here)])
            self.size[at] = piece.length, 1, piece.loss
        self.groups[at].append(piece)
        self.here[at] = True
        self.count += 1

    def _take(self, at: int) -> Piece:
        piece = self.groups[at].popleft()
        self.here[at] = bool(self.groups[at])
        self.count -= 1
        if 4 * self.here.sum() < len(self.groups) > 256:
            self._shrink()
        return piece

    def _shrink(self) -> None:
        """Leaves out vectors without a piece."""
        kept = np.flatnonzero(self.here)
        self.groups = [self.groups[i] for i in kept]
        self.size, self.here = np.concatenate([self.size[kept], np.zeros((64, 3))]), np.concatenate([self.here[kept], np.zeros(64, bool)])
        self.place = {(int(self.size[i, 0]), int(self.size[i, 2])): i for i in range(len(kept))}

    def best(self, room: np.ndarray, scale: np.ndarray) -> Piece | None:
        """The piece with the greatest dot product with ``room`` of those that fit."""
        size = self.size[: len(self.groups)]
        fits = self.here[: len(self.groups)] & (size <= room).all(axis=1)
        if not fits.any():
            return None
        return self._take(int(np.where(fits, (size * scale) @ (room * scale), -1.0).argmax()))

    def longest(self) -> Piece:
        size = self.size[: len(self.groups), 0]
        return self._take(int(np.where(self.here[: len(self.groups)], size, -1).argmax()))


def pack_pieces(pieces: list[Piece], limits: Limits, last: bool) -> tuple[list[list[Piece]], list[Piece]]:
    """Sequences, and the pieces of the one that is still open (none if ``last``)."""
    done: list[list[Piece]] = []
    rest: list[Piece] = []
    for piece in pieces:
        while piece.length and (size := piece.head(limits.tokens, limits.loss)) < piece.length or piece.length == limits.tokens:
            whole, piece = piece.cut(size)
            done.append([whole])
        if piece.length:
            rest.append(piece)
    waiting = _Waiting(rest)
    scale = 1 / np.array([limits.tokens, limits.segments, limits.loss], float)
    opened: list[Piece] = []
    while waiting.count:
        opened, room = [], np.array([limits.tokens, limits.segments, limits.loss], float)
        while waiting.count and room[0] > 0 and room[1] > 0:
            taken = waiting.best(room, scale)
            if taken is None:
                # Nothing fits whole: cut the piece that can give most.
                whole = waiting.longest()
                part = whole.head(int(room[0]), int(room[2]))
                if not part:
                    waiting.add(whole)
                    break
                taken, left = whole.cut(part)
                waiting.add(left)
            opened.append(taken)
            room -= taken.length, 1, taken.loss
        if waiting.count or room[0] == 0:
            done.append(opened)
            opened = []
    if last:
        done.extend(_powers_of_two(opened))
        opened = []
    return done, opened


def _powers_of_two(pieces: list[Piece]) -> list[list[Piece]]:
    """The pieces, in turn, cut into sequences whose lengths are the powers of two in their sum."""
    left, out = sum(p.length for p in pieces), []
    queue = list(reversed(pieces))
    while left:
        need = 1 << (left.bit_length() - 1)
        left -= need
        out.append([])
        while need:
            piece = queue.pop()
            if piece.length > need:
                piece, more = piece.cut(need)
                queue.append(more)
            out[-1].append(piece)
            need -= piece.length
    return out


def _packer(vocabulary: str, end_id: int, limits: Limits):
    def emit(sequences, first, held, place):
        table = {c: [] for c in ("id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")}
        for number, sequence in enumerate(sequences, first):
            offset = 0
            for p in sequence:
                key, ids = held[p.doc]
                table["id"].append(key)
                table["start"].append(p.start)
                table["length"].append(p.length)
                table["ids"].append(ids[p.start : p.start + p.length].tobytes())
                table["doc_tokens"].append(len(ids))
                table["sequence_id"].append(place << 33 | number)
                table["offset"].append(offset)
                offset += p.length
        kinds = {"ids": pa.binary()}
        return pa.RecordBatch.from_pydict({c: pa.array(v, kinds.get(c, pa.int64())) for c, v in table.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, place = encoder(vocabulary, False, KEEP_PIECES), TaskContext.get().partitionId()
        held: dict[int, tuple[int | None, np.ndarray]] = {}
        waiting: list[Piece] = []
        size = number = serial = 0
        for batch in batches:
            for part in slices(batch, "text"):
                ids, counts = tokens.encode(texts_of(part.column("text")))
                bounds = np.concatenate([[0], np.cumsum(counts)]).tolist()
                rows = zip(part.column("id").to_pylist(), part.column("free").to_pylist(), bounds, bounds[1:])
                for key, free, a, b in rows:
                    own = np.append(ids[a:b], np.uint32(end_id)).astype("<u4")
                    held[serial] = (key, own)
                    waiting.append(Piece(serial, 0, len(own), max(0, free or 0)))
                    size += len(own)
                    serial += 1
                if size >= RUN_TOKENS:
                    done, waiting = pack_pieces(waiting, limits, False)
                    yield emit(done, number, held, place)
                    number += len(done)
                    held = {p.doc: held[p.doc] for p in waiting}
                    size = sum(p.length for p in waiting)
        if waiting:
            done, _ = pack_pieces(waiting, limits, True)
            yield emit(done, number, held, place)

    return run


def pack(
    docs: DataFrame,
    vocabulary: str,
    end_id: int,
    limits: Limits = Limits(),
    id_col: str = "doc_id",
    text_col: str = "text",
    silent_col: str | None = None,
) -> DataFrame:
    """A row per piece: id, ``start`` (ids of its document before it), ``length``, ``ids``
    (little-endian unsigned 32-bit), ``doc_tokens``, ``sequence_id`` and ``offset`` in it.

    A document is the ids of its whole text and then ``end_id``. ``silent_col`` tells how many of
    its first ids bear no loss (null or left out: none). Every id lies in exactly one piece, and
    a sequence holds no gap. All sequences are full, but for those that reach the limit of
    segments or loss first, and those with a power of two as their length, at most one of each
    power a task. A null text is an empty one; a null id stays null; repeated rows are packed one
    by one; other columns are ignored; an empty table gives an empty result.
    """
    if min(limits.tokens, limits.segments, limits.loss) < 1:
        raise ValueError(f"limits must be positive: {limits}")
    silent = F.lit(0) if silent_col is None else F.col(silent_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), silent.cast("long").alias("free")
    )
    packed = rows.mapInArrow(
        _packer(vocabulary, end_id, limits),
        "id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long",
    )
    return packed.withColumnRenamed("id", "doc_id")

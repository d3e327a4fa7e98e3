"""Vectorised text helpers that run inside tasks: words, 64-bit word hashes, word shingles.

Texts stay UTF-8 bytes in one numpy buffer per slice, so the cost per word is a few array
operations. A slice holds half a megabyte of text, whatever the size of an Arrow batch; only a
single document longer than that makes a longer slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
WHITE = b" \t\n\x0b\x0c\r"

_U64 = np.uint64
_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[list(WHITE)] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> _U64(33))
    x = x * _U64(0xFF51AFD7ED558CCD)
    x ^= x >> _U64(33)
    x *= _U64(0xC4CEB9FE1A85EC53)
    x ^= x >> _U64(33)
    return x


#: Places in a word that have a table of their own.
_PLACES = 64
_STRIDE = _U64(0xD6E8FEB86659FD93)


def _letter_values(fold: bool) -> np.ndarray:
    """A random number for each byte at each of the first places of a word; of the row behind them
    come those of later places."""
    values = mix64(mix64(np.arange(1, 1 + (_PLACES + 1) * 256, dtype=_U64) * _STRIDE)).reshape(_PLACES + 1, 256)
    if fold:
        values[:, 65:91] = values[:, 97:123]  # A-Z count as a-z
    return values.ravel()


_LETTER = {fold: _letter_values(fold) for fold in (True, False)}


@dataclass
class Words:
    """The words of a slice of documents; a word is a run of bytes that are no white space."""

    data: np.ndarray  # uint8, each text followed by \n
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # of each document: its first word; one more entry at the end
    hashes: np.ndarray  # uint64, equal for words that differ in the case of A-Z only, unless asked otherwise

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def docs(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def texts_of(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A text column as large strings, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(pc.cast(column, pa.large_string()), "")


def slices(
    batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES, max_rows: int = 1 << 16
) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts hold ``max_bytes`` in all, or one longer text."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    begin = total = 0
    for i, size in enumerate(sizes.tolist()):
        if total and (total + size > max_bytes or i - begin >= max_rows):
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += size + 1
    yield batch.slice(begin)


def joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, each text followed by \\n, and the offset at which each text begins (and the end)."""
    lines = pc.binary_join_element_wise(texts, pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))
    if isinstance(lines, pa.ChunkedArray):
        lines = lines.combine_chunks()
    offsets = np.frombuffer(lines.buffers()[1], np.int64, len(lines) + 1, lines.offset * 8)
    data = np.frombuffer(lines.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of ``joined`` texts start and end, and which bytes are white space."""
    white = np.ones(len(data) + 1, bool)
    white[1:] = _IS_WHITE[data]
    edges = np.flatnonzero(white[1:] != white[:-1])
    return edges[::2], edges[1::2], white[1:]


def words_of(texts: pa.Array, fold: bool = True) -> Words:
    """Words and word hashes of a slice of texts (see ``texts_of``).

    A hash is the sum of random numbers, one for each byte and its place in the word. So words
    share it by chance only, whatever their make-up."""
    data, offsets = joined(texts)
    starts, ends, white = word_bounds(data)
    letters = data[~white]
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(letters)) - np.repeat(first, lengths)
    values = _LETTER[fold][np.minimum(place, _PLACES) * 256 + letters]
    far = np.flatnonzero(place >= _PLACES)
    if len(far):
        values[far] = mix64(values[far] + place[far].astype(_U64) * _STRIDE)
    sums = np.add.reduceat(values, first) if len(first) else np.zeros(0, _U64)
    return Words(data, starts, ends, np.searchsorted(starts, offsets), mix64(sums + lengths.astype(_U64)))


def shingle_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and where each document's begin (one more at the
    end). A document with fewer words has one run, all its words; one without words has none."""
    counts = words.counts
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(n)])
    padded = np.concatenate([words.hashes, np.zeros(size, _U64)])
    start = np.repeat(words.first[:-1] - first[:-1], n) + np.arange(first[-1])
    last = np.repeat(words.first[1:], n)
    out = np.zeros(len(start), _U64)
    for i in range(size):
        at = start + i
        out = out * _U64(0x9DDFEA08EB382D69) + np.where(at < last, padded[at], _U64(0x1B873593))
    return mix64(out), first

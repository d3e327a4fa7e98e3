"""Periodic runs in word sequences, by a dictionary of basic factors.

For each power of two L the words' factors of length L get names, from the names of their halves;
only factors that occur more than once in a document keep one. Two successive occurrences of a
factor that both lie in a window of 2L words are at most L apart; where that distance stays the
same from position to position the occurrences form arithmetic progressions, and the distance is
proposed as a period of the stretch of words they cover. Stretches are extended as far as words
repeat at that distance, and kept once.

In a run of smallest period q every factor of the least power of two L >= q recurs after exactly q
words, and q + L <= 3q, so each run of three periods is proposed. A stretch of three periods whose
factors recur no sooner than after p words has no smaller period than p.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .text import joined, slices, texts_of, word_bounds

MIN_LENGTH = 24
MIN_PERIODS = 3


@dataclass
class Runs:
    """Runs in the words of several documents, by document, start and period. Starts count from
    the first word of all."""

    start: np.ndarray
    length: np.ndarray
    period: np.ndarray

    def cut(self, bounds: np.ndarray) -> np.ndarray:
        """Where the runs of each document begin, and the end; ``bounds`` are the same of words."""
        return np.searchsorted(self.start, bounds)


def _names(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of equal keys, in order of place: the order, the name of each and whether it is the last
    of its name."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    return order, np.cumsum(fresh) - 1, np.append(fresh[1:], True)


def _extended(words: np.ndarray, low: np.ndarray, high: np.ndarray, start, end, period):
    """Start and end of each stretch, moved outwards while words ``period`` apart are equal;
    ``low`` and ``high`` are the bounds of its document."""
    start, end = start.copy(), end.copy()
    for place, step in ((start, -1), (end, 1)):
        todo = np.arange(len(start))
        while len(todo):
            # The word before the start, or the one at the end, and its fellow inside.
            new = place[todo] - 1 if step < 0 else place[todo]
            fellow = new - step * period[todo]
            within = (new >= low[todo]) if step < 0 else (new < high[todo])
            todo, new, fellow = todo[within], new[within], fellow[within]
            same = words[new] == words[fellow]
            todo = todo[same]
            place[todo] += step
    return start, end


def find_runs(
    words: np.ndarray, bounds: np.ndarray, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS
) -> Runs:
    """All runs of at least ``min_length`` words and ``min_periods`` (three or more) periods that no
    neighbouring word extends. ``words`` are numbers, equal for equal words, of all documents one
    after the other; ``bounds`` tells where each document begins, and the end."""
    if min_periods < 3:
        raise ValueError("runs need three periods")
    n = len(words)
    sizes = np.diff(bounds)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    end = bounds[1:][doc]
    found = []
    # Words of different documents are different factors.
    places = np.arange(n)
    keys = doc * np.int64((words.max() if n else 0) + 1) + words
    length = 1
    while len(places):
        order, name, last = _names(keys)
        place = places[order]
        follows = np.flatnonzero(~last)
        gap = place[follows + 1] - place[follows]
        near = gap <= length
        at, gap = place[follows][near], gap[near]
        if len(at):
            turn = np.argsort(at)
            at, gap = at[turn], gap[turn]
            fresh = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (gap[1:] != gap[:-1])])
            first = np.flatnonzero(fresh)
            final = np.append(first[1:], len(at)) - 1
            start, period = at[first], gap[first]
            found.append((start, at[final] + length + period, period))
        # Factors of twice the length, from halves that occur more than once.
        alone = last & np.concatenate([[True], last[:-1]])
        named = np.full(n, -1, np.int64)
        named[place[~alone]] = name[~alone]
        left = np.flatnonzero(named >= 0)
        left = left[left + 2 * length <= end[left]]
        left = left[named[left + length] >= 0]
        places, keys = left, named[left] * np.int64(n) + named[left + length]
        length *= 2
    if not found:
        return Runs(*(np.zeros(0, np.int64) for _ in range(3)))
    start, stop, period = (np.concatenate(x).astype(np.int64) for x in zip(*found))
    # Extension adds nothing to a run's own proposal, so what is far too short is none.
    long = stop - start >= min_periods * period
    start, stop, period = start[long], stop[long], period[long]
    start, stop = _extended(words, bounds[:-1][doc[start]], end[start], start, stop, period)
    long = stop - start >= np.maximum(min_length, min_periods * period)
    start, stop, period = start[long], stop[long], period[long]
    order = np.lexsort((period, stop, start))
    start, stop, period = start[order], stop[order], period[order]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    start, stop, period = start[fresh], stop[fresh], period[fresh]
    order = np.lexsort((period, start))
    return Runs(start[order], (stop - start)[order], period[order])


def collapsed(runs: Runs, n: int) -> np.ndarray:
    """Which of ``n`` words stay if of each run only the first period does."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, runs.start + runs.period, 1)
    np.add.at(depth, runs.start + runs.length, -1)
    return np.cumsum(depth[:-1]) == 0


@dataclass
class WordTable:
    """The words of a slice of texts: their bytes, a number for each, equal for equal words, and
    where each text's words begin (one more entry at the end)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    numbers: np.ndarray
    bounds: np.ndarray

    @staticmethod
    def of(texts: pa.Array) -> WordTable:
        data, offsets = joined(texts)
        starts, ends, white = word_bounds(data)
        compact = data[~white]
        places = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        words = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(compact)]
        ).dictionary_encode()
        numbers = words.indices.to_numpy().astype(np.int64)
        return WordTable(data, starts, ends, numbers, np.searchsorted(starts, offsets))

    def texts(self, chosen: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The words ``chosen`` with one space between them, cut at ``bounds``."""
        lengths = self.ends[chosen] - self.starts[chosen] + 1
        ends = np.cumsum(lengths)
        index = np.repeat(self.starts[chosen] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
        out = self.data[index]
        out[ends - 1] = 32
        raw, places = out.tobytes(), np.concatenate([[0], ends])[bounds].tolist()
        return [raw[a : max(a, b - 1)] for a, b in zip(places, places[1:])]


def no_reordering(doc_id: int | None, n: int) -> np.ndarray | None:
    return None


def planted_period(doc_id: int | None, n: int) -> np.ndarray | None:
    """The words of every tenth document (by a checksum of its id), from some place on, replaced
    by repetitions of the few that begin there; None for the others, and for a null id."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    index = np.arange(n)
    index[a:] = a + (index[a:] - a) % p
    return index


def detect(
    docs: DataFrame,
    reorder: Callable[[int | None, int], np.ndarray | None] = no_reordering,
    min_length: int = MIN_LENGTH,
    min_periods: int = MIN_PERIODS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_words, runs, collapsed): per row its runs as an array of (start, length, period),
    by start, then period, and its words, joined by one space, without those that a run repeats.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0, and differ by case. A run is a stretch of
    words of smallest period ``period`` and at least ``min_length`` words and ``min_periods``
    periods that no neighbouring word extends; runs may overlap, and a word is dropped if any run
    holds it after that run's first period. ``reorder`` may replace a document's words by others
    of its words: it gets id and number of words and returns the places to take them from.

    One row per row, no shuffle: a null text is an empty one, without runs; a null id stays null;
    repeated rows are treated one by one; other columns are ignored. Memory follows the longest
    text, time its length times the logarithm of its longest repetition.
    """
    kinds = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                ids = part.column("id")
                table = WordTable.of(texts_of(part.column("text")))
                bounds = table.bounds
                source = np.arange(len(table.numbers))
                for key, a, b in zip(ids.to_pylist(), bounds.tolist(), bounds[1:].tolist()):
                    moved = reorder(key, b - a)
                    if moved is not None:
                        source[a:b] = a + moved
                runs = find_runs(table.numbers[source], bounds, min_length, min_periods)
                cuts = runs.cut(bounds)
                own = runs.start - np.repeat(bounds[:-1], np.diff(cuts))
                lists = pa.ListArray.from_arrays(
                    pa.array(cuts.astype(np.int32)),
                    pa.StructArray.from_arrays(
                        [pa.array(x, pa.int64()) for x in (own, runs.length, runs.period)], fields=list(kinds.value_type)
                    ),
                )
                stays = collapsed(runs, len(source))
                kept = np.concatenate([[0], np.cumsum(stays)])[bounds]
                texts = pa.array(table.texts(source[stays], kept), pa.large_binary()).cast(pa.large_string())
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.diff(bounds), pa.int64()), lists, texts.cast(pa.string())],
                    ["id", "n_words", "runs", "collapsed"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = rows.mapInArrow(
        run, "id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )
    return found.withColumnRenamed("id", id_col)


def strongest(runs: str = "runs"):
    """The run with the greatest length / period, compared exactly; of equals the one that starts
    first, then the one with the smaller period. Null if there is none."""
    return F.expr(
        f"""aggregate(slice({runs}, 2, greatest(size({runs}) - 1, 0)), get({runs}, 0), (a, b) -> case
          when cast(b.length as decimal(19, 0)) * cast(a.period as decimal(19, 0))
             > cast(a.length as decimal(19, 0)) * cast(b.period as decimal(19, 0)) then b else a end)"""
    )

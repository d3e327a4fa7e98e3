"""Benchmark decontamination by template canonicalisation.

Numbers, units and names become typed placeholders, so a question whose figures or names were
changed keeps its template. Windows of template words of the documents are hash-joined with
those of the benchmark items. What stood in the placeholders must change consistently: an item's
slot value that appears in several matched windows must have one counterpart in the document.
A window that a document holds several times (variants of one template) keeps all its slot values:
where the first of each do not agree, the item's own values, the stretches of the document of the
item's length and the best fitting values of all are tried.

Names are known by their capitals, which a copy in lower or upper case lacks. So each item is looked
for a second time with its names as plain words, case aside: by its windows that hold a name, or
by all if none does. Windows between other names are thus no evidence there.

A bitmap of fixed size over the items' window hashes goes to all tasks and lets through every
window that can match; the rest never leaves the task.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .stages import staged
from .text import Words, joined, mix64, shingle_hashes, slices, texts_of

WINDOW = 8
LEAST_WORDS = 4  # shorter items could be part of any text
SHARE = 0.5  # of an item's windows, or
RUN_WINDOWS = 8  # this many windows in all: 15 words on end
CONSISTENT = 0.8
FILTER_BITS = 22
BROADCAST_KEYS = 1_000_000
_U64 = np.uint64

# Words for numbers and units.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen "
    "sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety "
    "hundred thousand million billion"
).split()
UNIT_WORDS = (
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms "
    "ton tons ounce ounces oz pound pounds lb lbs ml l liter liters litre litres gallon gallons "
    "second seconds sec minute minutes min hour hours h day days week weeks month months year years "
    "meter meters metre metres kilometer kilometers kilometre kilometres centimeter centimeters "
    "percent dollar dollars cent cents euro euros usd eur mph kmh watt watts kw volt volts degree degrees"
).split()

_NUMBER, _UNIT, _NAME = (_U64(x) for x in (0x11, 0x22, 0x33))
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_ENDS_SENTENCE = np.zeros(256, bool)
_ENDS_SENTENCE[list(b".!?:\n")] = True
_BYTE = mix64(np.arange(11, 267, dtype=_U64))
_BYTE[65:91] = _BYTE[97:123]
_STEP = _U64(0x9E3779B97F4A7C15)


@dataclass
class Templates:
    """Template words of a slice of texts: hash, value hash, whether a placeholder, whether
    (part of) a name, and where each text's begin (and the end)."""

    hashes: np.ndarray
    values: np.ndarray
    slot: np.ndarray
    named: np.ndarray
    first: np.ndarray


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte runs, A-Z as a-z: a sum of byte values weighted by their place in the run."""
    lengths = ends - starts
    place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    at = place + np.repeat(starts, lengths)
    weighted = _BYTE[data[at]] * ((place.astype(_U64) + _U64(1)) * _STEP | _U64(1))
    return mix64(np.add.reduceat(weighted, np.cumsum(lengths) - lengths)) if len(starts) else np.zeros(0, _U64)


def _word_hashes(words: list[str]) -> np.ndarray:
    data = np.frombuffer("\n".join(words).encode(), np.uint8)
    inside = np.concatenate([[False], _IN_WORD[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return np.sort(_hashes(data, edges[::2], edges[1::2]))


_NUMBERS, _UNITS = _word_hashes(NUMBER_WORDS), _word_hashes(UNIT_WORDS)


def _among(values: np.ndarray, listed: np.ndarray) -> np.ndarray:
    return listed[np.minimum(np.searchsorted(listed, values), len(listed) - 1)] == values


def templates(texts: pa.Array, folded: bool = False) -> Templates:
    """Words are runs of letters and digits. A number is a run that begins with a digit, runs of
    digits joined by a point or comma, or a number word; a unit is a unit word after a number; a
    name is capitalised within a sentence, and names in a row are one. ``folded`` takes the words of
    names as they are, case aside."""
    data, offsets = joined(texts)
    inside = np.concatenate([[False], _IN_WORD[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    n = len(starts)
    if not n:
        return Templates(np.zeros(0, _U64), np.zeros(0, _U64), np.zeros(0, bool), np.zeros(0, bool), np.zeros(len(offsets), np.int64))
    values = _hashes(data, starts, ends)
    closing = np.concatenate([[0], np.cumsum(_ENDS_SENTENCE[data])])
    begins = np.ones(n, bool)
    begins[1:] = closing[starts[1:]] > closing[ends[:-1]]
    gap = np.full(n, 9)
    gap[1:] = starts[1:] - ends[:-1]
    lead = data[starts]
    digit = (lead >= 48) & (lead < 58)
    number = digit | _among(values, _NUMBERS)
    after_number = np.concatenate([[False], number[:-1]])
    unit = ~number & after_number & _among(values, _UNITS) & ~begins
    follow = data[np.minimum(starts + 1, len(data) - 1)]
    capital = ((lead >= 65) & (lead < 91)) | ((lead == 0xC3) & (follow >= 0x80) & (follow < 0x9F))
    name = capital & ~begins & ~number & ~unit
    joint = np.isin(data[np.maximum(starts - 1, 0)], np.frombuffer(b".,", np.uint8))
    goes_on = np.concatenate([[False], digit[:-1]]) & digit & (gap == 1) & joint
    named = name
    if folded:
        name = np.zeros(n, bool)
    goes_on |= np.concatenate([[False], name[:-1]]) & name & (gap == 1)
    heads = np.flatnonzero(~goes_on)
    order = np.arange(n) - np.maximum.accumulate(np.where(goes_on, 0, np.arange(n)))
    whole = mix64(np.add.reduceat(values * (order.astype(_U64) * _U64(2) + _U64(1)), heads))
    slot = (number | unit | name)[heads]
    kinds = np.select([number[heads], unit[heads], name[heads]], [_NUMBER, _UNIT, _NAME], whole)
    return Templates(mix64(kinds), whole, slot, named[heads], np.searchsorted(starts[heads], offsets))


def windows(found: Templates, size: int, folded: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window of ``size`` template words and where each text's begin. A window in
    which placeholders prevail counts by its values: a template of holes says nothing. Hashes of
    ``folded`` templates are none of the others."""
    words = Words(np.zeros(0, np.uint8), np.zeros(0, int), np.zeros(0, int), found.first, found.hashes)
    hashes, first = shingle_hashes(words, size)
    words.hashes = found.values
    exact, _ = shingle_hashes(words, size)
    begin, end = _bounds(found, size, first)
    holes = np.concatenate([[0], np.cumsum(found.slot)])
    hashes = np.where(2 * (holes[end] - holes[begin]) > end - begin, exact ^ _U64(1), hashes)
    return mix64(hashes ^ _STEP) if folded else hashes, first


def _bounds(found: Templates, size: int, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First template word of each window, and the one after its last."""
    n = np.diff(first)
    begin = np.repeat(found.first[:-1] - first[:-1], n) + np.arange(first[-1])
    return begin, np.minimum(begin + size, np.repeat(found.first[1:], n))


def _slots(found: Templates, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """The slot values of each window."""
    holes = np.concatenate([[0], np.cumsum(found.slot)])
    values = found.values[found.slot].view(np.int64)
    a, b = holes[begin], holes[end]
    lengths = b - a
    ends = np.cumsum(lengths)
    at = np.repeat(a - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(values[at]))


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per distinct window of an item and look (``folded`` or not); an item shorter than a
    window is one window."""
    for batch in batches:
        for part in slices(batch, "text"):
            for folded in (False, True):
                found = templates(texts_of(part.column("text")), folded)
                sizes = np.minimum(np.diff(found.first), WINDOW)
                for size in np.unique(sizes[sizes >= LEAST_WORDS]).tolist():
                    yield _windows_of_size(part, found, sizes, size, folded)


def _windows_of_size(part: pa.RecordBatch, found: Templates, sizes: np.ndarray, size: int, folded: bool) -> pa.RecordBatch:
    hashes, first = windows(found, size, folded)
    begin, end = _bounds(found, size, first)
    item = np.repeat(np.arange(part.num_rows), np.diff(first))
    counts = sizes[item] == size
    if folded:
        before = np.concatenate([[0], np.cumsum(found.named)])
        telling = before[end] > before[begin]
        counts &= telling | (np.bincount(item[telling], minlength=part.num_rows) == 0)[item]
    own = np.flatnonzero(counts)
    _, keep = np.unique(np.stack([item[own].astype(_U64), hashes[own]]), axis=1, return_index=True)
    keep = own[keep]
    total = np.bincount(item[keep], minlength=part.num_rows)
    return pa.RecordBatch.from_pydict(
        {
            "item": part.column("item").take(pa.array(item[keep])),
            "folded": pa.array([folded] * len(keep), pa.bool_()),
            "hash": hashes[keep].view(np.int64),
            "size": pa.array([size] * len(keep), pa.int32()),
            "windows": pa.array(total[item[keep]], pa.int64()),
            "item_slots": _slots(found, begin[keep], end[keep]),
        }
    )


def _doc_windows(bitmap, sizes: list[int]):
    """The windows of documents that may be windows of items, once per document, with the places
    (in template words) and slot values of all their occurrences in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = bitmap.value
        for batch in batches:
            for part in slices(batch, "text"):
                texts = texts_of(part.column("text"))
                looks = [(folded, templates(texts, folded)) for folded in (False, True)]
                for (folded, found), size in product(looks, sizes):
                    hashes, first = windows(found, size, folded)
                    spot = (hashes >> _U64(64 - FILTER_BITS)).astype(np.int64)
                    some = np.flatnonzero(known[spot])
                    begin, end = _bounds(found, size, first)
                    some = some[(end - begin)[some] == size]
                    doc = np.searchsorted(first, some, "right") - 1
                    order = np.lexsort((some, hashes[some], doc))
                    some, doc = some[order], doc[order]
                    new = np.ones(len(some), bool)
                    new[1:] = (doc[1:] != doc[:-1]) | (hashes[some[1:]] != hashes[some[:-1]])
                    heads = np.flatnonzero(new)
                    cuts = pa.array(np.append(heads, len(some)).astype(np.int32))
                    places = pa.array(begin[some] - found.first[doc], pa.int64())
                    slots = _slots(found, begin[some], end[some])
                    some, doc = some[heads], doc[heads]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "id": part.column("id").take(pa.array(doc)),
                            "own": part.column("own").take(pa.array(doc)),
                            "hash": hashes[some].view(np.int64),
                            "size": pa.array([size] * len(some), pa.int32()),
                            "places": pa.ListArray.from_arrays(cuts, places),
                            "doc_slots": pa.ListArray.from_arrays(cuts, slots),
                        }
                    )

    return run


def _enough(matched: int, windows: int) -> bool:
    return matched >= SHARE * windows or matched >= RUN_WINDOWS


def _agreement(found: list[tuple[int, list[int]]], own: dict[int, list[int]]) -> tuple[int, float]:
    """Distinct windows among occurrences (window, slot values), and the share of slots that agree
    on one counterpart for each of the item's values, each window by its best fitting occurrence."""
    by_window = defaultdict(list)
    for window, slots in found:
        by_window[window].append(slots)
    chosen = found
    for _ in range(3):
        votes = defaultdict(Counter)
        for window, slots in chosen:
            for a, b in zip(own[window], slots):
                votes[a][b] += 1
        best = {a: max(n.items(), key=lambda x: (x[1], x[0] == a))[0] for a, n in votes.items()}
        chosen = [
            (window, max(several, key=lambda slots: sum(best[a] == b for a, b in zip(own[window], slots))))
            for window, several in by_window.items()
        ]
    agree = [best[a] == b for window, slots in chosen for a, b in zip(own[window], slots)]
    return len(by_window), sum(agree) / len(agree) if agree else 1.0


def _reviewed(rows: list[tuple[int, list[int], list[int], list[list[int]]]], windows: int) -> tuple[int, float] | None:
    """(matched, consistent) of an item found in a document by a consistent choice among all
    occurrences, None if there is none. Rows are (window, item's slots, places, slots at each)."""
    own = {window: slots for window, slots, _, _ in rows}
    literal = [window for window, slots, _, several in rows if slots in several]
    telling = sum(bool(own[window]) for window in literal)
    most = sum(map(bool, own.values()))
    if _enough(telling, windows) or (telling and _enough(len(literal), windows) and telling >= CONSISTENT * most):
        return len(literal), 1.0
    found = sorted((place, window, slots) for window, _, places, several in rows for place, slots in zip(places, several))
    length = windows + WINDOW
    step, tried = max(1, length // 4), []
    stretches = defaultdict(list)  # a stretch begins every ``step`` places and is a step longer than the item
    for place, window, slots in found:
        for k in range(max(0, -(-(place - length - step + 1) // step)), place // step + 1):
            stretches[k].append((window, slots))
    # Half of the item in a stretch: a few windows at its edge would always agree.
    for part in stretches.values():
        if len({window for window, _ in part}) >= SHARE * windows:
            tried.append(_agreement(part, own))
    tried.append(_agreement([x[1:] for x in found], own))
    return max((x for x in tried if x[1] >= CONSISTENT), default=None)


def _review(pair: pa.Table) -> pa.Table:
    rows = list(zip(*(pair.column(c).to_pylist() for c in ("hash", "item_slots", "places", "doc_slots"))))
    got = _reviewed(rows, pair.column("windows")[0].as_py())
    out = pair.select(["id", "own", "item", "folded"]).slice(0, 1 if got else 0)
    matched, consistent = got or (0, 0.0)
    out = out.append_column("matched", pa.array([matched] * len(out), pa.int64()))
    return out.append_column("consistent", pa.array([consistent] * len(out), pa.float64()))


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, own, item, matched, windows, consistent) for each document and item with a window in
    common, by the better of both looks. ``own`` is a hash of the document's text: with the id it
    names a row. Of several occurrences of a window the first counts, or those of a consistent
    choice if there is one."""
    spark = docs.sparkSession
    benchmark = items.select(F.col(item_col).cast("long").alias("item"), F.col(item_text).alias("text"))
    listed = staged(
        benchmark.where("item is not null and text is not null").mapInArrow(
            _item_windows, "item long, folded boolean, hash long, size int, windows long, item_slots array<long>"
        ),
        "benchmark-windows",
    )
    # Bounded: a position per bit of the filter, a size per length up to that of a window.
    spots = listed.select(F.shiftrightunsigned("hash", 64 - FILTER_BITS).alias("spot")).distinct().toArrow()
    sizes = sorted(r["size"] for r in listed.select("size").distinct().collect())
    bitmap = np.zeros(1 << FILTER_BITS, bool)
    bitmap[spots.column("spot").to_numpy()] = True
    rows = _keyed(docs, id_col, text_col)
    candidates = rows.mapInArrow(
        _doc_windows(spark.sparkContext.broadcast(bitmap), sizes),
        "id long, own long, hash long, size int, places array<long>, doc_slots array<array<long>>",
    )
    joined_rows = candidates.join(listed, ["hash", "size"])
    joined_rows = staged(joined_rows.select("id", "own", "item", "folded", "hash", "windows", "item_slots", "places", "doc_slots"), "benchmark-matches")
    who = ["id", "own", "item", "folded"]
    counted = joined_rows.groupBy(*who).agg(F.count_distinct("hash").alias("matched"), F.max("windows").alias("windows"))
    pairs = joined_rows.select(*who, F.explode(F.arrays_zip("item_slots", F.col("doc_slots")[0].alias("doc_slots"))).alias("p"))
    by_pair = pairs.groupBy(*who, F.col("p.item_slots").alias("a"), F.col("p.doc_slots").alias("b")).count()
    by_value = by_pair.groupBy(*who, "a").agg(F.max("count").alias("most"), F.sum("count").alias("all"))
    agreed = by_value.groupBy(*who).agg((F.sum("most") / F.sum("all")).alias("consistent"))
    right = agreed.toDF("id_2", "own_2", "item_2", "folded_2", "consistent")
    same = F.col("id").eqNullSafe(F.col("id_2"))
    for name in who[1:]:
        same &= F.col(name) == F.col(f"{name}_2")
    first = counted.join(right, same, "left").select(
        *who, "matched", "windows", F.coalesce("consistent", F.lit(1.0)).alias("consistent")
    )
    first = staged(first, "benchmark-pairs")
    doubtful = first.where(_reached() & (F.col("consistent") < CONSISTENT))
    if doubtful.isEmpty():
        return _better(first)
    several = joined_rows.join(doubtful.select(*who).toDF("id_2", "own_2", "item_2", "folded_2"), same, "left_semi")
    again = several.dropDuplicates([*who, "hash"]).groupBy(*who).applyInArrow(
        _review, "id long, own long, item long, folded boolean, matched long, consistent double"
    )
    again = again.toDF("id_2", "own_2", "item_2", "folded_2", "matched_2", "consistent_2")
    return _better(
        first.join(again, same, "left").select(
            *who,
            F.coalesce("matched_2", "matched").alias("matched"),
            "windows",
            F.coalesce("consistent_2", "consistent").alias("consistent"),
        )
    )


def _better(found: DataFrame) -> DataFrame:
    """Of both looks of a document and an item the one that finds it, or else finds more of it."""
    share = F.col("matched") / F.col("windows")
    rank = F.struct(
        _reached() & (F.col("consistent") >= CONSISTENT), _reached(), share, ~F.col("folded"),
        "matched", "windows", "consistent",
    )
    best = found.groupBy("id", "own", "item").agg(F.max(rank).alias("best"))
    return best.select("id", "own", "item", "best.matched", "best.windows", "best.consistent")


def _reached() -> Column:
    return (F.col("matched") >= SHARE * F.col("windows")) | (F.col("matched") >= RUN_WINDOWS)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.xxhash64(F.col(text_col)).alias("own"),
        F.col(text_col).alias("text"),
    )


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **names) -> DataFrame:
    """(id, own, item_ids, share) of the documents that hold a benchmark item: at least ``SHARE``
    of its windows, or ``RUN_WINDOWS`` of them, with consistent slots."""
    found = matches(docs, items, id_col, text_col, **names)
    return (
        found.where(_reached() & (F.col("consistent") >= CONSISTENT))
        .groupBy("id", "own")
        .agg(F.sort_array(F.collect_set("item")).alias("item_ids"), F.max(F.col("matched") / F.col("windows")).alias("share"))
    )


def flag(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **names) -> DataFrame:
    """One row per row of ``docs``: id, ``contaminated``, ``item_ids`` (ascending, empty if none)
    and ``share`` (the largest share of an item's windows, 0 if none).

    Null and empty texts hold nothing; items with a null id or text, or of
    fewer than ``LEAST_WORDS`` words, count for nothing; equal items are all named. Documents count whole, and each row by its own text, also where ids are null or
    repeated. Other columns are ignored; an empty table gives an empty result.
    """
    bad = contaminated(docs, items, id_col, text_col, **names).toDF("id_2", "own_2", "item_ids", "share")
    rows = _keyed(docs, id_col, text_col).select("id", "own")
    same = F.col("id").eqNullSafe(F.col("id_2")) & F.col("own").eqNullSafe(F.col("own_2"))
    return rows.join(bad, same, "left").select(
        F.col("id").alias("doc_id"),
        F.col("item_ids").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"),
        F.coalesce("share", F.lit(0.0)).alias("share"),
    )


def remove(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **names) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark item (see ``flag``)."""
    bad = staged(contaminated(docs, items, id_col, text_col, **names).select("id", "own"), "benchmark-hits")
    bad = bad.toDF("__id", "__own")
    if bad.count() <= BROADCAST_KEYS:
        bad = F.broadcast(bad)
    same = F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & F.xxhash64(F.col(text_col)).eqNullSafe(F.col("__own"))
    return docs.join(bad, same, "left_anti")

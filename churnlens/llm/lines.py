"""Line deduplication: a sharded minimal perfect hash over distinct line hashes indexes compact
fingerprint and count arrays, and documents probe the arrays instead of joining lines.

Lines are counted by a 128-bit hash of their key, summed in the tasks before the shuffle. Each
shard of the hash space becomes one index of bounded size. Documents are dealt into chunks of a
few megabytes; a chunk sends each of its distinct hashes once to the shard that knows it, so a
line found everywhere costs one probe a chunk. A shard's probes stream past its index. What
comes back to a chunk is the hashes to drop.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from .stages import staged
from .text import mix64, slices, texts_of

MIN_DOCS = 10
CHUNK_BYTES = 4 << 20
SHARD_LINES = 1 << 17
_FLUSH_LINES = 100_000
_LEVELS = 24
_U64 = np.uint64


def line_keys(text: bytes) -> list[bytes]:
    """The key of each line: white space stripped at both ends, A-Z lower-cased."""
    return [line.strip().lower() for line in text.split(b"\n")]


def _digests(keys) -> np.ndarray:
    """(n, 2) 64-bit halves of the keys' hashes."""
    raw = b"".join(map(xxhash.xxh3_128_digest, keys))
    return np.frombuffer(raw, _U64).reshape(-1, 2)


# -- the index of one shard ---------------------------------------------------------------


class LineIndex:
    """Minimal perfect hash of a set of 128-bit hashes, with a 32-bit fingerprint and the
    document count of each.

    Every level is a bit array; a hash that falls alone on a bit is placed there, the others try
    the next level, and the number of a hash is the rank of its bit. Hashes that no level places
    are listed in full.
    """

    def __init__(self, halves: np.ndarray, counts: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        todo, placed, base = np.arange(len(halves)), [], 0
        for level in range(_LEVELS):
            if not len(todo):
                break
            size = max(64, -(-2 * len(todo) // 64) * 64)
            at = self._slot(halves[todo], level, size)
            alone = np.bincount(at, minlength=size) == 1
            fits = alone[at]
            words = np.packbits(alone, bitorder="little").view(_U64)
            ranks = base + np.concatenate([[0], np.cumsum(np.bitwise_count(words))[:-1]])
            self.levels.append((words, ranks.astype(np.int64)))
            placed.append(todo[fits][np.argsort(at[fits])])
            base += int(alone.sum())
            todo = todo[~fits]
        order = np.concatenate([*placed, todo]).astype(np.int64)
        self.listed = {tuple(h): base + i for i, h in enumerate(halves[todo].tolist())}
        self.fingerprints = self._fingerprint(halves[order])
        self.counts = counts[order].astype(np.min_scalar_type(int(counts.max(initial=0))))

    @staticmethod
    def _slot(halves: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix64(halves[:, 0] * _U64(2 * level + 1) + mix64(halves[:, 1])) % _U64(size)).astype(np.int64)

    @staticmethod
    def _fingerprint(halves: np.ndarray) -> np.ndarray:
        return (halves[:, 1] >> _U64(32)).astype(np.uint32)

    def lookup(self, halves: np.ndarray) -> np.ndarray:
        """Document counts; 0 for a hash whose fingerprint differs."""
        number = np.full(len(halves), -1, np.int64)
        todo = np.arange(len(halves))
        for level, (words, ranks) in enumerate(self.levels):
            if not len(todo):
                break
            at = self._slot(halves[todo], level, 64 * len(words))
            word, bit = words[at >> 6], (at & 63).astype(_U64)
            hit = (word >> bit) & _U64(1) == 1
            below = word & ((_U64(1) << bit) - _U64(1))
            number[todo[hit]] = ranks[at[hit] >> 6] + np.bitwise_count(below[hit])
            todo = todo[~hit]
        for i in todo:
            number[i] = self.listed.get(tuple(halves[i].tolist()), -1)
        known = number >= 0
        known[known] = self.fingerprints[number[known]] == self._fingerprint(halves[known])
        out = np.zeros(len(halves), np.int64)
        out[known] = self.counts[number[known]]
        return out


# -- tasks --------------------------------------------------------------------------------


def _count_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash and number of documents of each distinct line of a run of documents."""
    seen: Counter = Counter()

    def flush() -> pa.RecordBatch:
        halves = _digests(seen).view(np.int64)
        counts = np.fromiter(seen.values(), np.int64, len(seen))
        seen.clear()
        return pa.RecordBatch.from_pydict({"h1": halves[:, 0], "h2": halves[:, 1], "docs": counts})

    for batch in batches:
        for part in slices(batch, "text"):
            for text in texts_of(part.column("text")).cast(pa.large_binary()).to_pylist():
                keys = set(line_keys(text))
                keys.discard(b"")
                seen.update(keys)
            if len(seen) >= _FLUSH_LINES:
                yield flush()
    if seen:
        yield flush()


def _lines_of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text the hashes of its distinct lines, and one of all its lines in their order."""
    for batch in batches:
        for part in slices(batch, "text"):
            texts = texts_of(part.column("text")).cast(pa.large_binary()).to_pylist()
            keys = [list(filter(None, line_keys(text))) for text in texts]
            own = np.array([xxhash.xxh3_64_intdigest(b"\n".join(k)) for k in keys], _U64).view(np.int64)
            blobs = [b"".join(map(xxhash.xxh3_128_digest, set(k))) for k in keys]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(own), pa.array(blobs, pa.binary())], ["id", "own", "blob"]
            )


def _lines_of_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per line hash and group, without the repeats within a batch."""
    for batch in batches:
        blobs = batch.column("blob").to_pylist()
        halves = np.frombuffer(b"".join(blobs), np.int64).reshape(-1, 2)
        sizes = [len(b) // 16 for b in blobs]
        grouped, known = (
            np.repeat(batch.column(c).to_numpy(zero_copy_only=False), sizes).astype(np.int64) for c in ("group", "known")
        )
        rows = np.unique(np.stack([halves[:, 0], halves[:, 1], grouped, known], axis=1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in rows.T], ["h1", "h2", "group", "known"])


def _counted_by_group(docs: DataFrame, text: str, groups: DataFrame) -> DataFrame:
    """(h1, h2, docs) with ``docs`` the number of groups."""
    of_id = groups.groupBy(F.col("doc_id").alias("id")).agg(F.min("component_id").alias("component"))
    lines = docs.select(F.col("doc_id").alias("id"), F.col(text).alias("text")).mapInArrow(
        _lines_of_texts, "id long, own long, blob binary"
    )
    placed = lines.join(of_id, "id", "left").select(
        "blob", F.coalesce("component", "own").alias("group"), F.col("component").isNotNull().cast("long").alias("known")
    )
    rows = placed.mapInArrow(_lines_of_groups, "h1 long, h2 long, group long, known long")
    return rows.distinct().groupBy("h1", "h2").agg(F.count("*").alias("docs"))


def _build_index(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    halves = rows[["h1", "h2"]].to_numpy().view(_U64)
    blob = pickle.dumps(LineIndex(halves, rows["docs"].to_numpy()), protocol=5)
    return pd.DataFrame({"shard": [key[0]], "kind": [0], "chunk": [None], "blob": [blob]})


def _shard_of(halves: np.ndarray, bits: int) -> np.ndarray:
    return (halves[:, 0] >> _U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(halves), np.int64)


def _prober(text: str, chunk: str, bits: int):
    """Each chunk's distinct line hashes, a row per shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, set] = {}
        for batch in batches:
            for part in slices(batch, text):
                texts = texts_of(part.column(text)).cast(pa.large_binary()).to_pylist()
                for value, where in zip(texts, part.column(chunk).to_pylist()):
                    found.setdefault(where, set()).update(line_keys(value))
        for where, keys in found.items():
            keys.discard(b"")
            halves = _digests(keys)
            shard = _shard_of(halves, bits)
            order = np.argsort(shard, kind="stable")
            halves, shard = halves[order], shard[order]
            cuts = np.flatnonzero(np.diff(shard, prepend=-1, append=-1)) if len(shard) else [0]
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([int(shard[a]) for a in cuts[:-1]], pa.int64()),
                    "kind": pa.array([1] * (len(cuts) - 1), pa.int32()),
                    "chunk": pa.array([where] * (len(cuts) - 1), pa.int64()),
                    "blob": pa.array([halves[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                }
            )

    return run


def _answerer(min_docs: int):
    """Probes stream past the index of their shard; the hashes to drop go back to the chunk."""

    def answer(index: LineIndex, chunks: list, blobs: list) -> pa.RecordBatch:
        halves = np.frombuffer(b"".join(blobs), _U64).reshape(-1, 2)
        where = np.repeat(np.arange(len(blobs)), [len(b) // 16 for b in blobs])
        common = index.lookup(halves) >= min_docs
        halves, where = halves[common], where[common]
        cuts = np.searchsorted(where, np.arange(len(blobs) + 1))
        hit = np.flatnonzero(np.diff(cuts))
        return pa.RecordBatch.from_pydict(
            {
                "chunk": pa.array([chunks[i] for i in hit], pa.int64()),
                "blob": pa.array([halves[cuts[i] : cuts[i + 1]].tobytes() for i in hit], pa.binary()),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, own = None, None
        for batch in batches:
            chunks, blobs = [], []
            for shard, kind, chunk, blob in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == 0:
                    if blobs:
                        yield answer(index, chunks, blobs)
                    index, own, chunks, blobs = pickle.loads(blob), shard, [], []
                    continue
                assert own == shard, "a shard has probes but no index"
                chunks.append(chunk)
                blobs.append(blob)
            if blobs:
                yield answer(index, chunks, blobs)

    return run


def _cleaner(text: str, chunk: str, columns: list[str]):
    """The documents of a chunk without the lines to drop."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        raw = b"".join(answers.column("blob").to_pylist())
        drop = {raw[i : i + 16] for i in range(0, len(raw), 16)}
        texts, n_lines, n_dropped = [], [], []
        for value in docs.column(text).cast(pa.large_binary()).to_pylist():
            lines = (value or b"").split(b"\n")
            kept = lines
            if drop:
                digest = xxhash.xxh3_128_digest
                kept = [x for x in lines if digest(x.strip().lower()) not in drop]
            texts.append(value if len(kept) == len(lines) else b"\n".join(kept))
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(kept))
        made = {
            text: pa.array(texts, pa.large_binary()).cast(pa.large_string()).cast(docs.schema.field(text).type),
            "n_lines": pa.array(n_lines, pa.int64()),
            "n_dropped": pa.array(n_dropped, pa.int64()),
        }
        return pa.table({c: made.get(c, docs.column(c) if c not in made else None) for c in columns})

    return run


def dedup_lines(
    docs: DataFrame, text: str = "text", min_docs: int = MIN_DOCS, groups: DataFrame | None = None
) -> DataFrame:
    """Every row of ``docs`` without the lines whose key is found in at least ``min_docs`` rows.

    A key is the line with white space stripped at both ends and A-Z in lower case; empty keys
    always stay. The columns are those of ``docs``, with ``text`` cut down, then ``n_lines``
    (before dropping; 1 for a null or empty text) and ``n_dropped``; columns of these two names in
    the input are replaced. A null text stays null; a text that loses all lines becomes empty.
    A repeated row counts as another document. With ``groups`` (doc_id, component_id) the documents
    of one group count once for each line; those of no group, or without an id, count once if
    their keys, leaving out empty ones, are the same in the same order. An empty table gives an
    empty result.
    """
    chunk = "__chunk"
    docs = docs.drop("n_lines", "n_dropped")
    if groups is None:
        counted = docs.select(F.col(text).alias("text")).mapInArrow(_count_lines, "h1 long, h2 long, docs long")
        counted = counted.groupBy("h1", "h2").agg(F.sum("docs").alias("docs"))
    else:
        counted = _counted_by_group(docs, text, groups)
    counts = staged(counted, "line-counts")
    bits = max(0, math.ceil(math.log2(max(1, counts.count()) / SHARD_LINES)))
    shard = F.shiftrightunsigned("h1", 64 - bits) if bits else F.lit(0).cast("long")
    index = (
        counts.withColumn("shard", shard)
        .groupBy("shard")
        .applyInPandas(_build_index, "shard long, kind int, chunk long, blob binary")
    )
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    chunks = max(1, math.ceil(size / CHUNK_BYTES))
    whole = F.xxhash64(*[c for c, kind in docs.dtypes if not kind.startswith("map")])
    dealt = docs.withColumn(chunk, F.pmod(whole, F.lit(chunks))).repartition(chunks, chunk)
    probes = dealt.mapInArrow(_prober(text, chunk, bits), "shard long, kind int, chunk long, blob binary")
    answers = (
        index.union(probes)
        .repartition(max(1, 1 << bits), "shard")
        .sortWithinPartitions("shard", "kind")
        .mapInArrow(_answerer(min_docs), "chunk long, blob binary")
    )
    answers = answers.withColumnRenamed("chunk", chunk)
    schema = T.StructType(
        [*docs.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    )
    return dealt.groupBy(chunk).cogroup(answers.groupBy(chunk)).applyInArrow(
        _cleaner(text, chunk, schema.fieldNames()), schema
    )

"""Token-id files: frequency-ranked ids in a byte-aligned variable-length code.

Frequent ids get small ranks. A rank takes one to four data bytes; a separate control byte holds
the lengths of four ranks, so a reader looks up lengths in a table, adds them up to offsets and
gathers all values at once, with no loop over ids. The files are written by Spark in ascending
order of the documents, a row per document in part files that follow one another, next to the
table of ranks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .stages import new_work_path, staged
from .text import slices, texts_of
from .tokens import encoder

PART_TOKENS = 8 << 20
BROADCAST_PARTS = 100_000
_ROWS = 512
_LENGTHS = np.array([[(byte >> (2 * i) & 3) + 1 for i in range(4)] for byte in range(256)], np.uint8)
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def encode_ranks(ranks: np.ndarray, counts: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """Control and data bytes of each row; ``ranks`` (uint32) holds ``counts`` values per row."""
    ranks = ranks.astype("<u4")
    codes = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    blocks = -(-counts // 4)
    first = np.cumsum(counts) - counts
    at = np.arange(len(ranks)) + np.repeat(4 * (np.cumsum(blocks) - blocks) - first, counts)
    padded = np.zeros(4 * int(blocks.sum()), np.uint8)
    padded[at] = codes
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) <= codes[:, None]]
    ends = np.concatenate([[0], np.cumsum(codes + np.int64(1))])[np.concatenate([[0], np.cumsum(counts)])]
    return _cut(control, np.concatenate([[0], np.cumsum(blocks)])), _cut(data, ends)


def _cut(values: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    bounds = bounds.tolist()
    return [values[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]


def decode_ranks(controls: list[bytes], data: list[bytes], counts: np.ndarray) -> np.ndarray:
    """The ranks of all rows in a row (uint32)."""
    lengths = _LENGTHS[np.frombuffer(b"".join(controls), np.uint8)].ravel().astype(np.int64)
    blocks = np.array([len(c) for c in controls], np.int64)
    place = np.arange(len(lengths)) - np.repeat(4 * (np.cumsum(blocks) - blocks), 4 * blocks)
    lengths = lengths[place < np.repeat(counts, 4 * blocks)]
    begins = np.cumsum(lengths) - lengths
    raw = np.frombuffer(b"".join([*data, bytes(3)]), np.uint8)
    out = raw[begins].astype(np.uint32)
    for i in range(1, int(lengths.max(initial=1))):
        out |= raw[begins + i].astype(np.uint32) << np.uint32(8 * i)
    return out & _MASKS[lengths]


def _tokenizer(path: str, end_id: int | None):
    """The ids of each text as 16- or 32-bit integers in one binary value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path, spaced=True)
        largest = max(tokens.tokenizer.get_vocab_size() - 1, end_id or 0)
        kind = np.dtype("<u2") if largest < 1 << 16 else np.dtype("<u4")
        tail = b"" if end_id is None else np.array([end_id], kind).tobytes()
        for batch in batches:
            for part in slices(batch, "text"):
                ids, counts = tokens.encode(texts_of(part.column("text")))
                rows = _cut(ids.astype(kind), np.concatenate([[0], np.cumsum(counts)]))
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": part.column("id"),
                        "width": pa.array([kind.itemsize] * len(rows), pa.int32()),
                        "ids": pa.array([r + tail for r in rows], pa.binary()),
                    }
                )

    return run


def _ids_of(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    raw = part.column("ids").to_pylist()
    width = part.column("width")[0].as_py()
    return np.frombuffer(b"".join(raw), f"<u{width}").astype(np.int64), np.array([len(r) // width for r in raw], np.int64)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, _ROWS):
            yield batch.slice(i, _ROWS)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for part in _parts(batches):
        ids, _ = _ids_of(part)
        own = np.bincount(ids, minlength=len(total))
        own[: len(total)] += total
        total = own
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"token": some.astype(np.int64), "n": total[some].astype(np.int64)})


def _writer(ranks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank_of, place, begin = ranks.value, TaskContext.get().partitionId(), 0
        for part in _parts(batches):
            ids, counts = _ids_of(part)
            control, data = encode_ranks(rank_of[ids], counts)
            ends = np.cumsum(counts)
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([place] * len(counts), pa.int32()),
                    "id": part.column("id"),
                    "begin": begin + ends - counts,
                    "n_tokens": counts,
                    "control": pa.array(control, pa.binary()),
                    "data": pa.array(data, pa.binary()),
                }
            )
            begin += int(ends[-1])

    return run


def write_token_files(
    docs: DataFrame, path: str, vocabulary: str, end_id: int | None, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Tokenizes every text and writes ``path``/ids and ``path``/ranks.

    Documents lie in ascending order of their id, null first; rows that share an id lie in the
    order of their ids' bytes. A null text is an empty one: it holds ``end_id`` alone. Other
    columns are ignored; an empty table gives files without rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    tokenized = staged(
        rows.mapInArrow(_tokenizer(vocabulary, end_id), "id long, width int, ids binary"), "token-ids", "zstd"
    )
    counted = (
        tokenized.select("width", "ids")
        .mapInArrow(_frequencies, "token long, n long")
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "token")
        .toArrow()  # a row per id of the vocabulary at most
    )
    order = counted.column("token").to_numpy()
    total = int(counted.column("n").to_numpy().sum())
    ranks = np.zeros(int(order.max(initial=0)) + 1, np.uint32)
    ranks[order] = np.arange(len(order), dtype=np.uint32)
    table = pa.table({"rank": np.arange(len(order), dtype=np.int64), "token": order.astype(np.int64)})
    spark.createDataFrame(table).coalesce(1).write.parquet(f"{path}/ranks")
    parts = max(1, math.ceil(total / PART_TOKENS))
    written = (
        tokenized.repartitionByRange(parts, "id")
        .sortWithinPartitions("id", "ids")
        .mapInArrow(
            _writer(spark.sparkContext.broadcast(ranks)),
            "part int, id long, begin long, n_tokens long, control binary, data binary",
        )
    )
    written.write.option("compression", "zstd").parquet(f"{path}/ids")


def _reader(tokens):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token_of = tokens.value
        for part in _parts(batches):
            counts = part.column("n_tokens").to_numpy()
            ranks = decode_ranks(part.column("control").to_pylist(), part.column("data").to_pylist(), counts)
            ids = token_of[ranks].astype("<u4")
            rows = _cut(ids, np.concatenate([[0], np.cumsum(counts)]))
            kept = [part.column(c) for c in ("id", "start", "n_tokens")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(rows, pa.binary())], ["id", "start", "n_tokens", "ids"])

    return run


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """id, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids`` (little-endian
    unsigned 32-bit) of each document in the files."""
    rows = spark.read.parquet(f"{path}/ids")
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").toArrow()
    tokens = spark.sparkContext.broadcast(ranks.column("token").to_numpy().astype(np.uint32))
    sizes = rows.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    starts = sizes.select("part", (before - F.col("size")).alias("base"))  # a row per part file
    if sizes.count() <= BROADCAST_PARTS:
        starts = F.broadcast(starts)
    placed = rows.join(starts, "part").withColumn("start", F.col("base") + F.col("begin"))
    return placed.select("id", "start", "n_tokens", "control", "data").mapInArrow(
        _reader(tokens), "id long, start long, n_tokens long, ids binary"
    )


def token_ids(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Writes the documents' files to a new place in the shared folder and reads them back."""
    path = new_work_path(docs.sparkSession, "token-files")
    write_token_files(docs, path, vocabulary, end_id)
    return read_token_files(docs.sparkSession, path)

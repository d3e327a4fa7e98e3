"""Near-duplicate vectors: random-hyperplane sign hashing in several tables, exact cosines, and
distributed connected components.

Equal vectors are grouped first and count as one class from then on. Each table cuts the space
with its own hyperplanes; the pattern of signs names a bucket. Within a bucket cosines are
computed in double precision, block against block of bounded size, so a crowded bucket becomes
many tasks. A pair that meets in several tables counts in the first of them only. A block sends
on a count and one root per vector, never its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .components import connected_components
from .stages import staged

BLOCK_ROWS = 2_048
BUCKET_ROWS = 512
BROADCAST_ROWS = 100_000
_SEED = 20_090
_STRIP = 256


def table_plan(classes: int, threshold: float, recall: float) -> tuple[int, int]:
    """Signs per table, and tables, for so many vectors: buckets keep about ``BUCKET_ROWS``
    unrelated vectors, and a pair at the threshold meets in some table with ``recall``."""
    bits = min(30, max(4, math.ceil(math.log2(max(1, classes) / BUCKET_ROWS + 1))))
    same = (1 - math.acos(min(1.0, threshold)) / math.pi) ** bits
    tables = 1 if same >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - same))
    return bits, tables


def _planes(dim: int, count: int) -> np.ndarray:
    return np.random.default_rng((_SEED, dim)).standard_normal((dim, count))


def _hasher(bits: int, tables: int, with_vectors: bool):
    """(dim, tab, bucket) of each vector in each table, with id, weight, all its buckets, and the
    vector unless only counts are wanted."""
    weights = 1 << np.arange(bits, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 2_000):
                part = batch.slice(begin, 2_000)
                lists = part.column("vector")
                sizes = lists.value_lengths().to_numpy()
                flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                at = np.concatenate([[0], np.cumsum(sizes)])
                ids, copies = part.column("id").to_numpy(), part.column("copies").to_numpy()
                for dim in np.unique(sizes):
                    rows = np.flatnonzero(sizes == dim)
                    x = flat[(at[rows][:, None] + np.arange(dim)).ravel()].reshape(len(rows), dim)
                    x /= np.abs(x).max(axis=1, keepdims=True)  # keeps squares finite
                    signs = x @ _planes(int(dim), bits * tables) >= 0
                    buckets = (signs.reshape(len(rows), tables, bits) @ weights).astype(np.int32)
                    n = len(rows)
                    out = {
                        "dim": np.full(n * tables, dim, np.int32),
                        "tab": np.tile(np.arange(tables, dtype=np.int32), n),
                        "bucket": buckets.ravel(),
                    }
                    if with_vectors:
                        out["id"] = np.repeat(ids[rows], tables)
                        out["copies"] = np.repeat(copies[rows], tables)
                        own = [b.tobytes() for b in buckets]
                        out["buckets"] = [own[i] for i in range(n) for _ in range(tables)]
                        raw = [v.tobytes() for v in x]
                        out["vector"] = [raw[i] for i in range(n) for _ in range(tables)]
                    yield pa.RecordBatch.from_pydict(out)

    return run


def _block_linker(threshold: float):
    """Links inside one block pair: per vector with a link, the vectors linked and a root."""

    def matrix(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        x = np.frombuffer(b"".join(pdf["vector"]), np.float64).reshape(len(pdf), -1)
        x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
        return x, np.frombuffer(b"".join(pdf["buckets"]), np.int32).reshape(len(pdf), -1)

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        tab, low, high = int(key[1]), int(key[3]), int(key[4])
        pdf = pdf.sort_values("id", kind="stable")
        left = pdf[pdf["chunk"] == low] if low != high else pdf
        right = pdf[pdf["chunk"] == high] if low != high else pdf
        if left.empty or right.empty:
            return pd.DataFrame({"id": [], "links": [], "root": []})
        (x, bx), (y, by) = matrix(left), matrix(right)
        ix, iy = left["id"].to_numpy(), right["id"].to_numpy()
        new = np.zeros((len(x), len(y)), bool)
        for i in range(0, len(x), _STRIP):
            r, c = np.nonzero(x[i : i + _STRIP] @ y.T >= threshold)
            r += i
            keep = ix[r] < iy[c] if low == high else ix[r] != iy[c]
            r, c = r[keep], c[keep]
            for t in range(tab):
                fresh = bx[r, t] != by[c, t]
                r, c = r[fresh], c[fresh]
            new[r, c] = True
        cx, cy = left["copies"].to_numpy(), right["copies"].to_numpy()
        nx, ny = new @ cy, cx @ new
        if low == high:
            new |= new.T
        rx, ry = ix.copy(), iy.copy()
        far = np.iinfo(np.int64).max
        while new.any():
            was = (rx, ry)
            rx, ry = rx.copy(), ry.copy()
            for i in range(0, len(x), _STRIP):
                strip = slice(i, i + _STRIP)
                rx[strip] = np.minimum(rx[strip], np.where(new[strip], ry, far).min(axis=1))
                ry = np.minimum(ry, np.where(new[strip], rx[strip][:, None], far).min(axis=0))
            if low == high:
                rx = ry = np.minimum(rx, ry)
            if (rx == was[0]).all() and (ry == was[1]).all():
                break
        if low == high:
            ids, links, roots = ix, nx + ny, rx
        else:
            ids, links = np.concatenate([ix, iy]), np.concatenate([nx, ny])
            roots = np.concatenate([rx, ry])
        some = links > 0
        return pd.DataFrame({"id": ids[some], "links": links[some], "root": roots[some]})

    return run


def near_duplicate_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = 0.95,
    recall: float = 0.998,
) -> DataFrame:
    """One row per input row: id, ``n_links`` (other rows with a cosine of at least
    ``threshold``), ``component_id`` (least id reachable) and ``kept`` (it is that id).

    Pairs are missed with probability ``1 - recall`` at the threshold and less above it; no pair
    below it is linked, and equal vectors always are. Vectors of different lengths are never
    compared. Null or zero vectors and those with null or non-finite components link with
    nothing. A row without an id links with nothing, has a null component and is kept.
    Repeated rows count as copies of each other. Other columns are ignored; an empty table gives
    an empty result.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.col("id").isNotNull() & finite & F.exists("vector", lambda v: v != 0)
    keyed = rows.withColumn("usable", F.coalesce(usable, F.lit(False))).withColumns(
        {"k1": F.xxhash64("vector"), "k2": F.xxhash64(F.lit(1), F.col("vector"))}
    )
    classes = staged(
        keyed.where("usable")
        .groupBy("k1", "k2", "vector")
        .agg(F.min("id").alias("id"), F.count("*").alias("copies")),
        "vector-classes",
    )
    bits, tables = table_plan(classes.count(), threshold, recall)
    place = "dim int, tab int, bucket int"
    source = classes.select("id", "copies", "vector")
    crowded = (
        source.mapInArrow(_hasher(bits, tables, False), place)
        .groupBy("dim", "tab", "bucket")
        .count()
        .where(F.col("count") > BLOCK_ROWS)
        .select("dim", "tab", "bucket", F.ceil(F.col("count") / BLOCK_ROWS).cast("int").alias("chunks"))
    )
    crowded = staged(crowded, "vector-crowded")
    if crowded.count() <= BROADCAST_ROWS:
        crowded = F.broadcast(crowded)
    hashed = source.mapInArrow(
        _hasher(bits, tables, True), f"{place}, id long, copies long, buckets binary, vector binary"
    ).join(crowded, ["dim", "tab", "bucket"], "left")
    chunk = F.pmod(F.xxhash64("id"), F.coalesce("chunks", F.lit(1))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1))
    blocks = (
        hashed.withColumn("chunk", chunk)
        .withColumn("other", other)
        .select(
            "dim", "tab", "bucket", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"),
            "chunk", "id", "copies", "buckets", "vector",
        )
    )
    found = staged(
        blocks.groupBy("dim", "tab", "bucket", "low", "high").applyInPandas(
            _block_linker(threshold), "id long, links long, root long"
        ),
        "vector-links",
    )
    components = connected_components(found, "id", "root", "vector-components")
    counted = found.groupBy("id").agg(F.sum("links").alias("links"))
    known = (
        classes.select("k1", "k2", "id", "copies")
        .join(counted, "id", "left")
        .join(components.withColumnRenamed("node", "id"), "id", "left")
        .select(
            "k1",
            "k2",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "id").alias("component"),
        )
    )
    alone = keyed.where("not usable").select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component")
    )
    linked = keyed.where("usable").select("id", "k1", "k2").join(known, ["k1", "k2"]).select("id", "n_links", "component")
    return linked.union(alone).select(
        F.col("id").alias("vec_id"),
        "n_links",
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )

"""Exact k-nearest-neighbour classification as a blocked join.

Training rows are grouped around pivots and cut into blocks of bounded
size; query rows likewise. From the distances to the pivots the triangle inequality tells which
groups can hold a neighbour of a query, and only those blocks meet. Blocks travel as arrays and
each task keeps the best k rows per query over all its pairs of blocks, so pairs of rows are never
shuffled.
(The idea is the partition-based kNN join of Lu, Shen, Chen and Ooi, VLDB 2012.)

A sample of the training rows, and then a block of rows in a query's own cell, bound its k-th distance
from above. In few dimensions, rows beyond the bound are sorted out by rough distances in single
precision. In many dimensions the pivots tell little. There partial distances bound all others from below: in coordinates
rotated to the axes of the sample's spread, the distance in the leading ones and the difference of
the lengths of what remains never exceed the whole distance. Rows that these bounds leave out
are not measured, and a pair of blocks without any other is skipped. The sample decides only how much is
left out, never the result.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from ..session import new_work_path
from ..sources.sinks import sink_stage_table
from .split import sample_n

# Pivots grow with the square root of the number of training blocks at first, then with that number, so
# that a cell stays about as large as a block.
PIVOTS_PER_ROOT = 8
# Training rows that bound each query's k-th distance at first, and numbers they may hold in all.
SAMPLE_ROWS, SAMPLE_VALUES = 4_096, 4_000_000
# Share of the sample's spread that the leading coordinates should hold, and of the coordinates they
# may be; share of pairs below which pairs are measured one by one and not as a product.
LEADING_SHARE, LEADING_MOST, SPARSE = 0.9, 0.25, 0.1
# Coordinates up to which whole distances cost no more than these bounds, and pairs in cache at a time.
FEW_COORDINATES, CACHED_PAIRS = 16, 1 << 18
# Least number of tasks that blocks meet in. More than Spark's own number, so that it stays.
MEETING_TASKS = 256
# Training blocks that travel together: as many groups as LEAST_GROUPS first, then groups of that many
# blocks; query blocks that one copy of them may meet.
LEAST_GROUPS, BLOCKS_PER_GROUP, BLOCKS_PER_COPY = 64, 16, 64


def knn_classify(
    train: DataFrame,
    queries: DataFrame,
    key: str,
    vector: str,
    label: str,
    k: int,
    block_rows: int = 2_048,
) -> DataFrame:
    """(key, prediction): the majority label of the k nearest training rows by Euclidean
    distance. Equal distances go to the smaller key, equal votes to the smaller label.
    ``vector`` is an array<double>; ``key`` is unique. Rows whose vector is NULL or holds NULL,
    NaN or infinity are nobody's neighbours and get no prediction."""
    nearest = knn_neighbours(train, queries, key, vector, label, k, block_rows)
    votes = nearest.groupBy(key, "label").agg(F.count("*").alias("votes"))
    return votes.groupBy(key).agg(
        F.min(F.struct((-F.col("votes")).alias("v"), "label")).getField("label").alias("prediction")
    )


def knn_neighbours(
    train: DataFrame,
    queries: DataFrame,
    key: str,
    vector: str,
    label: str,
    k: int,
    block_rows: int = 2_048,
) -> DataFrame:
    """(key, neighbour, label, distance), the k nearest training rows of each query row."""
    key_type = dict(train.dtypes)[key]
    shape = f"`{key}` {key_type}, neighbour {key_type}, label int, distance double"
    found = _meetings(train, queries, key, vector, label, k, block_rows)
    if found is None:
        return queries.sparkSession.createDataFrame([], shape)
    pairs, axes = found
    best = Window.partitionBy(key).orderBy("distance", "neighbour")
    near = pairs.mapInArrow(partial(_search, k=k, axes=axes), shape)
    return near.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= k).drop("_rank")


def search_effort(
    train: DataFrame,
    queries: DataFrame,
    key: str,
    vector: str,
    label: str,
    k: int,
    block_rows: int = 2_048,
) -> DataFrame:
    """One row: pairs of blocks that meet, those skipped whole, pairs of rows in them and pairs of rows
    whose distance is measured in all coordinates. Pairs that the pivots keep apart never meet."""
    shape = "blocks long, skipped long, pairs long, measured long"
    found = _meetings(train, queries, key, vector, label, k, block_rows)
    if found is None:
        return queries.sparkSession.createDataFrame([(0, 0, 0, 0)], shape)
    pairs, axes = found
    counted = pairs.mapInArrow(partial(_search, k=k, axes=axes, effort=True), shape)
    return counted.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counted.columns])


def _meetings(train, queries, key, vector, label, k, block_rows):
    """The pairs of blocks to search and the axes of the sample; None where a side has no rows."""
    key_type = dict(train.dtypes)[key]
    train = train.select(
        F.col(key).alias("id"), F.col(label).cast("int").alias("label"), F.col(vector).alias("vec")
    )
    queries = queries.select(F.col(key).alias("id"), F.lit(0).alias("label"), F.col(vector).alias("vec"))

    usable = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    train, queries = train.where(usable), queries.where(usable)
    rows, width = train.agg(F.count("*"), F.max(F.size("vec"))).first()
    if not rows:
        return None
    blocks = rows / block_rows
    n_pivots = max(1, math.ceil(math.sqrt(blocks) * PIVOTS_PER_ROOT), min(SAMPLE_ROWS, math.ceil(blocks)))
    taken = max(n_pivots, min(SAMPLE_ROWS, SAMPLE_VALUES // max(1, width)))
    sample = np.array([r["vec"] for r in sample_n(train, "id", taken).collect()], dtype=float)
    pivots = sample[:n_pivots]
    placed = f"id {key_type}, label int, vec array<double>, cell int, distance double"
    train = _stage(train.mapInArrow(partial(_place, pivots=pivots), placed), "knn-train")
    train_cells = _cell_sizes(train, k)
    placed_queries = _stage(
        queries.mapInArrow(
            partial(_place_queries, pivots=pivots, cells=train_cells, k=k, sample=sample), placed + ", bound double"
        ),
        "knn-queries",
    )
    query_sizes = {
        r["cell"]: r["n"] for r in placed_queries.groupBy("cell").agg(F.count("*").alias("n")).collect()
    }
    if not query_sizes:
        return None

    train_subs = {c: math.ceil(s["n"] / block_rows) for c, s in train_cells.items()}
    query_subs = {c: math.ceil(n / block_rows) for c, n in query_sizes.items()}
    train_blocks = _blocks(train, train_subs).select(
        "cell", "sub", *[F.col(c).alias(f"t_{c}") for c in ("ids", "labels", "vecs")]
    )
    train_blocks = _stage(train_blocks, "knn-train-blocks")
    # A query block first meets one block of its own cell. The rows there are near, so they bound the
    # k-th distance far better than the sample, and few other cells remain to be searched.
    home = _blocks(placed_queries, query_subs, bounds=F.col("rows.bound")).withColumn("spread", F.xxhash64("cell", "sub"))
    home = _numbered(home, train_subs).withColumn("sub", F.pmod("spread", "number").cast("int"))
    near = train_blocks.select("cell", "sub", "t_vecs")
    axes = _axes(sample)
    together = min(BLOCKS_PER_GROUP, math.ceil(sum(train_subs.values()) / LEAST_GROUPS))
    begins, groups = _groups(train_subs, (pivots - axes[0]) @ axes[1][:, 0], together)
    query_blocks = (
        home.join(near, ["cell", "sub"], "left")
        .select("ids", "vecs", "bounds", "spread", "t_vecs")
        .mapInArrow(
            partial(_reached, pivots=pivots, cells=train_cells, groups=groups, k=k),
            f"ids array<{key_type}>, vecs array<double>, bounds array<double>, spread long, "
            "reach array<int>, groups array<int>",
        )
    )
    query_blocks = _stage(query_blocks, "knn-query-blocks").withColumn("group", F.explode("groups")).drop("groups")
    visits = _visits(query_blocks)
    copies = {group: math.ceil(n / BLOCKS_PER_COPY) for group, n in visits.items()}
    # Few bytes and much work: a fixed number of tasks, which adaptive execution doesn't put together.
    tasks = max(sum(copies.values()), min(MEETING_TASKS, sum(visits.values())))

    train_blocks = (
        _numbered(train_blocks, begins)
        .withColumn("group", F.floor((F.col("number") + F.col("sub")) / together).cast("int"))
        .withColumnRenamed("cell", "t_cell")
    )
    train_blocks = _numbered(train_blocks, copies, "group").withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.col("number") - 1))
    )
    query_blocks = _numbered(query_blocks, copies, "group").withColumn("copy", F.pmod("spread", "number").cast("int"))
    query_blocks, train_blocks = (
        side.drop("number").repartition(tasks, "group", "copy") for side in (query_blocks, train_blocks)
    )
    pairs = query_blocks.join(train_blocks, ["group", "copy"]).where(F.array_contains("reach", F.col("t_cell")))
    return pairs.select("spread", "ids", "vecs", "bounds", "t_ids", "t_labels", "t_vecs"), axes


def _groups(subs: dict[int, int], place: np.ndarray, together: int) -> tuple[dict[int, int], dict[int, range]]:
    """Blocks numbered by the place of their cell, so that near ones travel together: the first
    number of each cell, and the groups that hold its blocks."""
    order = sorted(subs, key=lambda c: (place[c], c))
    ends = np.cumsum([subs[c] for c in order]).tolist()
    begins = {c: end - subs[c] for c, end in zip(order, ends)}
    return begins, {c: range(b // together, (b + subs[c] - 1) // together + 1) for c, b in begins.items()}


def _axes(sample: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Centre of the sample, its axes by falling spread, and how many of them lead."""
    centre = sample.mean(axis=0)
    spread, axes = np.linalg.eigh((sample - centre).T @ (sample - centre))
    share = np.cumsum(np.maximum(spread[::-1], 0))
    leading = int(np.searchsorted(share, LEADING_SHARE * share[-1])) + 1
    return centre, axes[:, ::-1], min(leading, math.ceil(LEADING_MOST * len(centre)))


def _stage(df: DataFrame, name: str) -> DataFrame:
    """Placed rows are read several times; they are computed once."""
    return sink_stage_table(df, new_work_path(df.sparkSession, name))


def _numbered(df: DataFrame, numbers: dict[int, int], by: str = "cell") -> DataFrame:
    """``df`` with the number of its cell or group, 1 if none is given. A row per pivot is broadcast."""
    columns = pa.array(numbers.keys(), pa.int32()), pa.array(numbers.values(), pa.int32())
    listed = df.sparkSession.createDataFrame(pa.Table.from_arrays(columns, [by, "number"]))
    joined = df.drop("number").join(F.broadcast(listed), by, "left")
    return joined.withColumn("number", F.coalesce("number", F.lit(1)))


def _cell_sizes(train: DataFrame, k: int) -> dict[int, dict[str, float]]:
    """Per pivot: rows, smallest, largest and k-th smallest distance. One row per pivot."""
    nearest = Window.partitionBy("cell").orderBy("distance")
    kth = (
        train.select("cell", "distance")
        .withColumn("_rank", F.row_number().over(nearest))
        .where(F.col("_rank") <= k)
        .groupBy("cell")
        .agg(F.max(F.when(F.col("_rank") == k, F.col("distance"))).alias("kth"))
    )
    sizes = train.groupBy("cell").agg(
        F.count("*").alias("n"), F.min("distance").alias("low"), F.max("distance").alias("high")
    )
    rows = sizes.join(kth, "cell").collect()
    return {r["cell"]: {c: r[c] for c in ("n", "low", "high", "kth")} for r in rows}


def _visits(query_blocks: DataFrame) -> dict[int, int]:
    """The number of query blocks that will visit each group of training blocks. A row per group."""
    return {r["group"]: r["count"] for r in query_blocks.groupBy("group").count().collect()}


def _blocks(placed: DataFrame, subs: dict[int, int], **extra) -> DataFrame:
    """Rows packed into arrays in key order, about ``block_rows`` at a time."""
    packed = (
        _numbered(placed, subs)
        .withColumn("sub", F.pmod(F.xxhash64("id"), "number").cast("int"))
        .groupBy("cell", "sub")
        .agg(F.array_sort(F.collect_list(F.struct("id", "label", "vec", *(c for c in ("bound",) if c in placed.columns)))).alias("rows"))
    )
    return packed.select(
        "cell",
        "sub",
        F.col("rows.id").alias("ids"),
        F.col("rows.label").alias("labels"),
        F.flatten("rows.vec").alias("vecs"),
        *[value.alias(name) for name, value in extra.items()],
    )


# -- inside the tasks ---------------------------------------------------------------------


def _vectors(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([((x - p) ** 2).sum(axis=1) for p in pivots], axis=1))


def _to_pivots(batch: pa.RecordBatch, pivots: np.ndarray) -> np.ndarray:
    return _distances(_vectors(batch.column("vec"), batch.num_rows), pivots)


def _with(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*batch.columns, *columns.values()], names=[*batch.schema.names, *columns]
    )


def _placement(distances: np.ndarray) -> dict[str, pa.Array]:
    cell = distances.argmin(axis=1)
    return {
        "cell": pa.array(cell.astype(np.int32)),
        "distance": pa.array(distances[np.arange(len(cell)), cell]),
    }


def _place(batches: Iterator[pa.RecordBatch], pivots: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield _with(batch, **_placement(_to_pivots(batch, pivots)))


def _products(q: np.ndarray, t: np.ndarray, kind=np.float64) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances in product form, and the greatest sum of squares in a row of them."""
    q_size, t_size = (q**2).sum(axis=1), (t**2).sum(axis=1)
    left, right = np.column_stack([q, q_size, np.ones(len(q))]), np.column_stack([-2 * t, np.ones(len(t)), t_size])
    return left.astype(kind, copy=False) @ right.astype(kind, copy=False).T, q_size + t_size.max(initial=0)


def _rough_products(q: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances of few coordinates in single precision, where they stay in its range, and what
    rounding may add to a row of them."""
    if max(np.abs(q).max(initial=0), np.abs(t).max(initial=0)) > 1e12:
        rough, sizes = _products(q, t)
        return rough, 1e-12 * sizes + 1e-300
    rough, sizes = _products(q, t, np.float32)
    return rough, 8e-6 * sizes + 1e-30


def _sample_bound(x: np.ndarray, sample: np.ndarray, k: int) -> np.ndarray:
    """What the k-th distance of each row cannot exceed."""
    if len(sample) < k:
        return np.full(len(x), np.inf)
    bounds = []
    for i in range(0, len(x), 512):
        rough, sizes = _products(x[i : i + 512], sample)
        kth = np.partition(rough, k - 1, axis=1)[:, k - 1]
        bounds.append(np.sqrt(np.maximum(kth + 1e-12 * sizes + 1e-300, 0)))
    return np.concatenate(bounds) if bounds else np.zeros(0)


def _cell_arrays(cells: dict[int, dict[str, float]]) -> tuple[np.ndarray, ...]:
    names = np.array(sorted(cells))
    n, low, high = (np.array([cells[c][x] for c in names], dtype=float) for x in ("n", "low", "high"))
    kth = np.array([np.inf if cells[c]["kth"] is None else cells[c]["kth"] for c in names])
    return names, n, low, high, kth


def _rounded_up(bound: np.ndarray) -> np.ndarray:
    return bound * (1 + 1e-9) + 1e-9


def _place_queries(batches, pivots, cells, k, sample):
    """Adds the cell and a bound of the k-th distance."""
    names, n, _, high, kth = _cell_arrays(cells)
    for batch in batches:
        if not batch.num_rows:
            continue
        all_distances = _to_pivots(batch, pivots)
        d = all_distances[:, names]
        # k rows lie within the k-th distance of one cell ...
        bound = (d + kth).min(axis=1)
        # ... or in the cells whose far ends come first.
        far = d + high
        order = far.argsort(axis=1)
        enough = n[order].cumsum(axis=1) >= k
        first = enough.argmax(axis=1)
        whole = np.take_along_axis(far, np.take_along_axis(order, first[:, None], 1), 1)[:, 0]
        bound = np.minimum(bound, np.where(enough[:, -1], whole, np.inf))
        bound = np.minimum(bound, _sample_bound(_vectors(batch.column("vec"), batch.num_rows), sample, k))
        yield _with(batch, **_placement(all_distances), bound=pa.array(_rounded_up(bound)))


def _reached(batches, pivots, cells, groups, k):
    """Blocks of queries with bounds that the training rows beside them tighten, the cells that may
    hold one of the k nearest training rows of any of them, and the groups of these cells."""
    names, _, low, high, _ = _cell_arrays(cells)
    for batch in batches:
        for i in range(batch.num_rows):
            part = batch.slice(i, 1)
            q = _matrix(part.column("vecs")[0].values, pivots.shape[1])
            bound = part.column("bounds")[0].values.to_numpy()
            if part.column("t_vecs")[0].is_valid:
                t = _matrix(part.column("t_vecs")[0].values, pivots.shape[1])
                bound = np.minimum(bound, _rounded_up(_sample_bound(q, t, k)))
            d = _distances(q, pivots)[:, names]
            reach = names[(np.maximum(d - high, low - d) <= bound[:, None]).any(axis=0)]
            columns = {
                "ids": part.column("ids"),
                "vecs": part.column("vecs"),
                "bounds": pa.array([bound], pa.list_(pa.float64())),
                "spread": part.column("spread"),
                "reach": pa.array([reach], pa.list_(pa.int32())),
                "groups": pa.array([sorted({g for c in reach.tolist() for g in groups[c]})], pa.list_(pa.int32())),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


HELD_ROWS = 2_000_000


def _search(batches, k, axes, effort=False):
    """The k nearest rows of each query over all pairs of blocks of the task. What is held is
    bounded: beyond it the best so far are sent on and the search starts anew. ``axes`` may be just the
    number of coordinates; blocks without names or bounds are told apart by their ids and unbounded."""
    if isinstance(axes, int):
        axes = np.zeros(axes), np.eye(axes), math.ceil(LEADING_MOST * axes)
    held: dict[object, list] = {}
    few = len(axes[0]) <= FEW_COORDINATES
    size, counts = 0, np.zeros(4, np.int64)
    for batch in batches:
        for i in range(batch.num_rows):
            block = batch.column("spread" if "spread" in batch.schema.names else "ids")[i].as_py()
            block = tuple(block) if isinstance(block, list) else block
            names = _names(batch.column("t_ids")[i].values)
            q_ids = batch.column("ids")[i].values
            q, t = (_matrix(batch.column(c)[i].values, len(axes[0])) for c in ("vecs", "t_vecs"))
            labels = batch.column("t_labels")[i].values.to_numpy()
            if block not in held:
                if "bounds" in batch.schema.names:
                    bound = batch.column("bounds")[i].values.to_numpy(zero_copy_only=False)
                else:
                    bound = np.full(len(q), np.inf)
                held[block] = [q_ids, [], bound, 0]
            mine = held[block]
            bound = mine[2]
            q_low, t_low = (None, None) if few else (_lowered(q, axes), _lowered(t, axes))
            # Some query rows at a time, to bound the distance matrix.
            step = max(1, (CACHED_PAIRS if few else 4_000_000) // max(1, len(t)))
            measured = found = 0
            for start in range(0, len(q), step):
                part = slice(start, start + step)
                low = None if few else q_low[part]
                rows, cols, distance, n = _nearest(q[part], t, k, bound[part], low, t_low)
                if len(rows):
                    mine[1].append((rows + start, names[cols], labels[cols], distance))
                measured, found = measured + n, found + len(rows)
            counts += [1, measured == 0, len(q) * len(t), measured]
            mine[3], size = mine[3] + found, size + found
            # To sort is dear: only once enough has come together, which then tightens the bounds.
            if mine[3] > 2 * k * len(q):
                best = _best(mine[1], k)
                size += len(best[0]) - mine[3]
                mine[1:] = [best], _tightened(bound, best, k), len(best[0])
            if size > HELD_ROWS:
                if not effort:
                    yield from _send(held, k)
                held, size = {}, 0
    if effort:
        columns = ["blocks", "skipped", "pairs", "measured"]
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in counts.tolist()], names=columns)
    else:
        yield from _send(held, k)


def _names(ids: pa.Array) -> np.ndarray:
    found = ids.to_numpy(zero_copy_only=False)
    return found.astype(str) if found.dtype == object else found


def _matrix(values: pa.Array, width: int) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False).reshape(-1, width)


def _lowered(x: np.ndarray, axes: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
    """Leading coordinates and the length of the rest: no distance grows by this."""
    centre, directions, leading = axes
    turned = (x - centre) @ directions
    return np.column_stack([turned[:, :leading], np.linalg.norm(turned[:, leading:], axis=1)])


def _tightened(bound: np.ndarray, best: tuple, k: int) -> np.ndarray:
    """Bounds of the query rows, by the k-th distance of those that have k neighbours already."""
    rows, distance = best[0], best[3]
    last = np.flatnonzero(np.append(rows[1:] != rows[:-1], True)) if len(rows) else np.zeros(0, int)
    full = last[last - np.searchsorted(rows, rows[last]) == k - 1]
    bound = bound.copy()
    bound[rows[full]] = np.minimum(bound[rows[full]], distance[full] * (1 + 1e-9) + 1e-9)
    return bound


def _best(parts, k):
    rows, names, labels, distance = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((names, distance, rows))
    rows, names, labels, distance = (x[order] for x in (rows, names, labels, distance))
    keep = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
    return rows[keep], names[keep], labels[keep], distance[keep]


def _send(held, k):
    for q_ids, parts, _, _ in held.values():
        if not parts:
            continue
        rows, names, labels, distance = _best(parts, k)
        columns = [q_ids.take(pa.array(rows)), pa.array(names), pa.array(labels), pa.array(distance)]
        yield pa.RecordBatch.from_arrays(columns, names=["query", "neighbour", "label", "distance"])


def _nearest(q, t, k, bound, q_low, t_low):
    """(query row, training row, distance, pairs measured) of the k nearest within the bounds;
    equals by training position. Without the lowered rows all pairs are measured."""
    limit = bound**2
    if q_low is None:
        rough, slack = _rough_products(q, t)
        measured, near = rough.size, rough <= (limit + slack)[:, None].astype(rough.dtype)
        if k < len(t) and np.count_nonzero(near) > 2 * k * len(q):
            near &= rough <= (np.partition(rough, k - 1, axis=1)[:, k - 1] + 2 * slack)[:, None].astype(rough.dtype)
        rows, cols = np.divmod(np.flatnonzero(near), len(t))
        return *_measured(q, t, k, rows, cols), measured
    low, _ = _products(q_low, t_low)
    slack = 1e-11 * ((q**2).sum(axis=1) + (t**2).sum(axis=1).max(initial=0)) + 1e-300
    near = low <= (limit + slack)[:, None]
    measured = int(np.count_nonzero(near))
    if measured < SPARSE * near.size:
        rows, cols = np.nonzero(near)
    else:
        some_q, some_t = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        rough, sizes = _products(q[some_q], t[some_t])
        measured, cut, slack = rough.size, limit[some_q], 1e-12 * sizes + 1e-300
        if k < len(some_t):
            # The product form rounds. What it might have misplaced is measured again below.
            cut = np.minimum(cut, np.partition(rough, k - 1, axis=1)[:, k - 1])
        rows, cols = np.nonzero(rough <= (cut + slack)[:, None])
        rows, cols = some_q[rows], some_t[cols]
    return *_measured(q, t, k, rows, cols), measured


def _measured(q, t, k, rows, cols):
    distance = np.empty(len(rows))
    for start in range(0, len(rows), 100_000):
        part = slice(start, start + 100_000)
        distance[part] = np.sqrt(((q[rows[part]] - t[cols[part]]) ** 2).sum(axis=1))
    order = np.lexsort((cols, distance, rows))
    rows, cols, distance = rows[order], cols[order], distance[order]
    rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
    keep = rank < k
    return rows[keep], cols[keep], distance[keep]


# Tasks get these functions by value, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Near-duplicate documents by min-max hashing.

Each permutation of the shingle hashes yields two signature values, its minimum and its maximum,
so half the hash evaluations give a signature of the same length; both agree with the
probability of the Jaccard similarity. Bands of the signature name buckets. Candidates are
confirmed on the full shingle sets.

No bucket is expanded into all its pairs: documents with equal sets count once; the others meet
the least id of their bucket first, and what is then linked is one component. What lies outside
the largest component of a bucket meets further members of it. Then all pairs of a bucket that
still lie in different components and could be similar are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .components import connected_components
from .stages import staged
from .text import mix64, shingle_hashes, slices, texts_of, words_of

WORDS = 5
SIMILARITY = 80  # per cent
BANDS = 40
BAND_PERMUTATIONS = 4  # two values each
TURNS = 1
BROADCAST_IDS = 1_000_000
_BLOCK = 4_096
_SKETCH_BITS = 1_024
_U32, _U64 = np.uint32, np.uint64

_COUNT = BANDS * BAND_PERMUTATIONS
_RANDOM = np.random.default_rng(71).integers(0, 1 << 32, (2, _COUNT, 1), dtype=np.uint64).astype(_U32)
_FLIP, _TIMES = _RANDOM[0], _RANDOM[1] | _U32(1)
_BAND_MIX = mix64(np.arange(1, BANDS * BAND_PERMUTATIONS + 1, dtype=_U64)).reshape(BANDS, BAND_PERMUTATIONS) | _U64(1)


def signature(hashes: np.ndarray) -> np.ndarray:
    """(permutations, 2): minimum and maximum of the hashes under each permutation."""
    low = hashes.astype(_U32)
    out = np.empty((_COUNT, 2), _U32)
    for i in range(0, len(low), _BLOCK):
        values = (low[None, i : i + _BLOCK] ^ _FLIP) * _TIMES
        least, most = values.min(axis=1), values.max(axis=1)
        out[:, 0] = np.minimum(out[:, 0], least) if i else least
        out[:, 1] = np.maximum(out[:, 1], most) if i else most
    return out


def band_keys(signed: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; equal values in another band give another key."""
    pairs = np.ascontiguousarray(signed).view(_U64).reshape(BANDS, BAND_PERMUTATIONS)
    return mix64((mix64(pairs) * _BAND_MIX).sum(axis=1, dtype=_U64))


def parity_sketch(hashes: np.ndarray) -> np.ndarray:
    """Parity of the number of hashes that fall on each bit. Two sets that differ in d elements
    differ in at most d bits."""
    odd = np.bincount((hashes >> _U64(40)).astype(np.int64) & (_SKETCH_BITS - 1), minlength=_SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sets(part: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    hashes, first = shingle_hashes(words_of(texts_of(part.column("text"))), size)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        own = np.sort(hashes[a:b])
        yield own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) else own


def _profiler(size: int):
    width = _SKETCH_BITS // 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                counts, keys, bands, sketches = [], [], [], []
                for own in _sets(part, size):
                    counts.append(len(own))
                    keys.append(xxhash.xxh3_128_digest(own.tobytes()))
                    if len(own):
                        bands.append(band_keys(signature(own)))
                        sketches.append(parity_sketch(own))
                some = np.array(counts, np.int64) > 0
                halves = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": part.column("id"),
                        "n": pa.array(counts, pa.int64()),
                        "k1": halves[:, 0],
                        "k2": halves[:, 1],
                        "bands": _lists(bands, some, BANDS),
                        "sketch": _lists(sketches, some, width),
                    }
                )

    return run


def _lists(rows: list[np.ndarray], some: np.ndarray, width: int) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(some * width)]).astype(np.int32)
    values = np.concatenate(rows).view(np.int64) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _set_writer(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = pa.array([own.tobytes() for own in _sets(part, size)], pa.binary())
                yield pa.RecordBatch.from_pydict({"id": part.column("id"), "hashes": sets})

    return run


def _confirmer(similarity: int):
    """Pairs of full sets that are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                a, b = np.frombuffer(x, _U64), np.frombuffer(y, _U64)
                both = np.concatenate([a, b])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                good.append(100 * shared >= similarity * (len(a) + len(b) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def _could_be_similar(similarity: int) -> Column:
    """False only for pairs that cannot reach the similarity: their sizes are too far apart, or
    their sketches differ in more bits than sets so similar can differ in elements."""
    n, m = F.col("n_a"), F.col("n_b")
    apart = sum(
        F.bit_count(F.col("sketch_a")[i].bitwiseXOR(F.col("sketch_b")[i])) for i in range(_SKETCH_BITS // 64)
    )
    return (100 * F.least(n, m) >= similarity * F.greatest(n, m)) & (
        (100 + similarity) * apart <= (100 - similarity) * (n + m)
    )


def _confirmed(pairs: DataFrame, reps: DataFrame, texts: DataFrame, size: int, similarity: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    side = reps.select("id", "n", "sketch")
    likely = staged(
        pairs.join(side.toDF("a", "n_a", "sketch_a"), "a")
        .join(side.toDF("b", "n_b", "sketch_b"), "b")
        .where(_could_be_similar(similarity))
        .select("a", "b"),
        "minmax-likely",
    )
    wanted = likely.select(F.col("a").alias("id")).union(likely.select("b")).distinct()
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    sets = staged(
        texts.join(wanted, "id", "left_semi").mapInArrow(_set_writer(size), "id long, hashes binary"), "minmax-sets"
    )
    both = likely.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    return both.select("a", "b", "x", "y").mapInArrow(_confirmer(similarity), "a long, b long")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    similarity: int = SIMILARITY,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles`` (distinct runs of ``words`` words, A-Z in
    lower case), ``component_id`` (least id reachable by links, itself included) and ``kept``.

    Documents are linked if their shingle sets have a Jaccard similarity of at least
    ``similarity`` per cent, confirmed on the full sets; a pair at the threshold is missed with
    a probability below 0.1 %. Fewer words than ``words`` are one shingle; a null text or one
    without words has none and links with nothing. A row without an id links with nothing, has
    a null component and is kept. Rows that share an id count as one document. Other columns are
    ignored; an empty table gives an empty result.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    profile = staged(
        texts.mapInArrow(
            _profiler(words), "id long, n long, k1 long, k2 long, bands array<long>, sketch array<long>"
        ),
        "minmax-profile",
    )
    usable = F.col("id").isNotNull() & (F.col("n") > 0)
    classes = profile.where(usable).groupBy("k1", "k2").agg(F.min("id").alias("rep"))
    is_rep = F.col("id") == F.col("rep")
    members = staged(
        profile.where(usable)
        .join(classes, ["k1", "k2"])
        .select("id", "n", "rep", F.when(is_rep, F.col("bands")).alias("bands"), F.when(is_rep, F.col("sketch")).alias("sketch")),
        "minmax-members",
    )
    reps = members.where("bands is not null").dropDuplicates(["id"]) if _repeats(members) else members.where("bands is not null")
    banded = reps.select("id", F.explode("bands").alias("key"))

    # Each member of a bucket against the least id of the bucket.
    leaders = banded.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    shared = staged(banded.join(leaders.select("key", "low"), "key"), "minmax-buckets")
    star = shared.where("id <> low").select(F.col("low").alias("a"), F.col("id").alias("b")).distinct()
    star = staged(star, "minmax-star")
    links = staged(_confirmed(star, reps, texts, words, similarity), "minmax-links")

    # What lies outside the main component of its bucket meets other members of it, one a round.
    components = connected_components(links, "a", "b", "minmax-components")
    tested = star
    for turn in range(1, TURNS + 1):
        rest = staged(_unsettled(shared, components), "minmax-rest")
        if rest.isEmpty():
            break
        inside = rest.where("component = main").groupBy("key")
        leaders = inside.agg(F.min_by("id", F.xxhash64("id", F.lit(turn))).alias("leader"))
        met = _pairs(rest.where("component <> main").join(leaders, "key"), "id", "leader", tested)
        met = staged(met, "minmax-star")
        more = staged(_confirmed(met, reps, texts, words, similarity), "minmax-links")
        tested = tested.union(met)
        components = _merged(components, more)

    # All pairs of one bucket that are in different components still, and could be similar.
    side = reps.select("id", "n", "sketch")
    rest = staged(_unsettled(shared, components).join(side, "id"), "minmax-rest")
    if not rest.isEmpty():
        inner = rest.toDF("b", "key", "component", "main", "n_b", "sketch_b")
        outer = rest.where("component <> main").drop("main").toDF("a", "key", "outer", "n_a", "sketch_a")
        crossed = inner.join(
            outer.withColumnRenamed("key", "outer_key"),
            (F.col("key") == F.col("outer_key"))
            & (F.col("component") != F.col("outer"))
            & ((F.col("component") == F.col("main")) | (F.col("b") < F.col("a")))
            & _could_be_similar(similarity),
        )
        met = staged(_pairs(crossed, "a", "b", tested), "minmax-star")
        more = staged(_confirmed(met, reps, texts, words, similarity), "minmax-links")
        components = _merged(components, more)

    linked = members.select("id", "n", "rep").join(
        components.select(F.col("node").alias("rep"), "component"), "rep", "left"
    )
    alone = profile.where(~F.coalesce(usable, F.lit(False))).select("id", "n", F.col("id").alias("component"))
    return (
        linked.select("id", "n", F.coalesce("component", "rep").alias("component"))
        .union(alone)
        .select(
            F.col("id").alias("doc_id"),
            F.col("n").alias("n_shingles"),
            F.col("component").alias("component_id"),
            F.col("id").eqNullSafe(F.col("component")).alias("kept"),
        )
    )


def _merged(components: DataFrame, more: DataFrame) -> DataFrame:
    """Components after further links, which join whole components."""
    if more.isEmpty():
        return components
    ends = more
    for end in ("a", "b"):
        ends = ends.join(components.toDF(end, f"of_{end}"), end, "left").withColumn(
            f"of_{end}", F.coalesce(f"of_{end}", end)
        )
    joined = connected_components(ends, "of_a", "of_b", "minmax-components").toDF("component", "joined")
    moved = components.join(joined, "component", "left").select("node", F.coalesce("joined", "component").alias("component"))
    # Nodes that were alone before are in the second result only.
    fresh = joined.join(components.select(F.col("node").alias("component")), "component", "left_anti")
    return staged(moved.union(fresh), "minmax-components")


def _unsettled(shared: DataFrame, components: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components: id, key, component, and the bucket's
    main component, the largest (ties: the last)."""
    placed = (
        shared.select("key", "id")
        .join(components.withColumnRenamed("node", "id"), "id", "left")
        .select("id", "key", F.coalesce("component", "id").alias("component"))
    )
    mains = (
        placed.groupBy("key", "component")
        .count()
        .groupBy("key")
        .agg(F.count("*").alias("parts"), F.max_by("component", F.struct("count", "component")).alias("main"))
        .where("parts > 1")
        .select("key", "main")
    )
    return placed.join(mains, "key").select("id", "key", "component", "main")


def _pairs(rows: DataFrame, x: str, y: str, tested: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) of two id columns, without those already tested."""
    pairs = rows.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).where("a < b").distinct()
    return pairs.join(tested, ["a", "b"], "left_anti")


def _repeats(members: DataFrame) -> bool:
    return not members.where("bands is not null").groupBy("id").count().where("count > 1").isEmpty()

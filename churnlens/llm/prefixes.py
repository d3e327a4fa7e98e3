"""A prefix trie of conversations, without building a tree.

Identical conversations collapse to one weighted sequence with the list of those that end there.
A sequence that is a proper prefix of another drops out by an anti-join; what stays are the leaves.
Each distinct sequence then adds its weight, once, to all of its prefixes.

A prefix is named by its number of turns and the exclusive or of 128 bits per turn, taken from
place, role and text. So names of prefixes, and of whole conversations, are plain aggregates: no
conversation is ever gathered. Conversations lie in segments, the pieces of a range partitioning
by conversation and turn, so one that holds a large part of all rows is many segments; windows run
inside a segment, and what lies before it comes from a row per segment.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .stages import staged

HEAD_TURNS = 6  # rebuilt conversations take fewer than so many turns from another one
BLOCK = 100
CHUNK_BITS = 13
HOT_SHARE = 1_000
_ROOT, _HEAD = -2, -1  # segments before those of the table


@dataclass(frozen=True)
class Conversations:
    """``convs``: conv_id of every conversation, turnless ones too, each once. ``turns``: conv_id,
    segment, place (from 1, rising with the segment), n1 and n2 (what names role and text), chars
    (code points of the text)."""

    convs: DataFrame
    turns: DataFrame


def _digest(role: Column, text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))


def _segmented(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns by segment, and a row per segment with the number of its conversation's turns before."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        _digest(role, text).alias("digest"),
        F.length(text).cast("long").alias("chars"),
    )
    order = [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), F.col("digest").asc()]
    turns = staged(turns.repartitionByRange(*order).withColumn("segment", F.spark_partition_id()), "trie-turns")
    segments = turns.groupBy("conv_id", "segment").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    return turns, segments.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))


def _in_segment():
    return Window.partitionBy("conv_id", "segment").orderBy(F.col("turn").asc_nulls_first(), "digest")


def _names() -> list[Column]:
    """What names the digest of a turn: 128 bits."""
    return [F.xxhash64(F.lit(k), "digest").alias(f"n{k}") for k in (1, 2)]


def numbered(conversations: DataFrame) -> Conversations:
    """Conversations as they are, in the order of ``turn``: null first, ties by the SHA-256 of
    length of role, colon, role and text. Null role and text are empty; rows without a conv_id are in no
    conversation; a repeated row is another turn; other columns are ignored."""
    turns, segments = _segmented(conversations)
    rows = turns.withColumn("rank", F.row_number().over(_in_segment())).join(segments, ["conv_id", "segment"])
    place = (F.col("before") + F.col("rank")).alias("place")
    return Conversations(segments.select("conv_id").distinct(), rows.select("conv_id", "segment", place, *_names(), "chars"))


def rebuilt(conversations: DataFrame, block: int = BLOCK, heads: int = HEAD_TURNS) -> Conversations:
    """Conversations whose first turns come from another one.

    Conversation c becomes the first h turns of conversation ``c - c % block`` (all, if it has
    fewer; none, if there is no such), then c's own turns after its first h, with h the checksum of its id modulo
    ``heads``. Order and odd values as in :func:`numbered`. A conversation may be left without turns.
    """
    turns, segments = _segmented(conversations)
    base = F.col("conv_id") - F.col("conv_id") % block
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    # Fewer than ``heads`` turns of one conversation in each block.
    first = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    head = (
        turns.where(F.col("conv_id") % block == 0)
        .withColumn("rank", F.row_number().over(first))
        .where(F.col("rank") < heads)
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("rank", *_names(), "chars"))).alias("head"))
    )
    convs = segments.groupBy("conv_id").agg(F.sum("n").alias("n")).select("conv_id", base.alias("base"), taken.alias("taken"))
    convs = convs.join(head, "base", "left").select(
        "conv_id", "taken", F.when(F.col("head").isNotNull(), F.expr("slice(head, 1, taken)")).alias("head")
    )
    convs = staged(convs, "trie-conversations")
    copied = convs.select("conv_id", F.explode("head").alias("t")).select(
        "conv_id", F.lit(_HEAD).alias("segment"), F.col("t.rank").cast("long").alias("place"), "t.n1", "t.n2", "t.chars"
    )
    had = convs.select("conv_id", "taken", F.when(F.col("head").isNull(), 0).otherwise(F.size("head")).alias("had"))
    rows = turns.withColumn("rank", F.row_number().over(_in_segment())).join(
        segments.join(had, "conv_id"), ["conv_id", "segment"]
    )
    at = F.col("before") + F.col("rank")
    own = rows.where(at > F.col("taken")).select(
        "conv_id", "segment", (F.col("had") + at - F.col("taken")).alias("place"), *_names(), "chars"
    )
    return Conversations(convs.select("conv_id"), copied.union(own))


def _ends(members: DataFrame) -> DataFrame:
    """(depth, x, y, ends_sha256): SHA-256 of the ascending ids of each sequence's conversations.

    Ids are joined in chunks of a range of ids; where a sequence has several, they pass one after
    the other through one hash. That is sequential by definition, but holds one chunk at a time.
    """
    key = ["depth", "x", "y"]
    chunks = members.groupBy(*key, F.shiftright("conv_id", CHUNK_BITS).alias("chunk")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    )
    chunks = staged(chunks, "trie-ends")
    counted = chunks.groupBy(*key).agg(F.count("*").alias("n"), F.max("ids").alias("ids"))
    single = counted.where("n = 1").select(*key, F.sha2("ids", 256).alias("ends_sha256"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, state, done = None, None, []
        for batch in batches:
            for *key_, ids in zip(*(batch.column(c).to_pylist() for c in (*key, "ids"))):
                if key_ != own:
                    if own is not None:
                        done.append((*own, state.hexdigest()))
                    own, state = key_, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
        if own is not None:
            done.append((*own, state.hexdigest()))
        kinds = [pa.int64()] * 3 + [pa.string()]
        rows = list(zip(*done)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows, kinds)], [*key, "ends_sha256"])

    several = (
        chunks.join(counted.where("n > 1").select(*key), key, "left_semi")
        .repartition(*key)
        .sortWithinPartitions(*key, "chunk")
        .mapInArrow(run, "depth long, x long, y long, ends_sha256 string")
    )
    return single.union(several)


def _with_parents(nodes: DataFrame, known: DataFrame) -> DataFrame:
    """``nodes`` with parent_conv_id, from the nodes ``known``. Parents of a large share of all
    nodes, at most ``HOT_SHARE`` by count, are broadcast; no other has more children than that
    share."""
    limit = max(HOT_SHARE, known.count() // HOT_SHARE)
    parents = known.select(
        (F.col("depth") + 1).alias("depth"), F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv_id").alias("parent_conv_id")
    )
    key = ["depth", "px", "py"]
    below = nodes.where("depth > 0")
    hot = below.groupBy(*key).count().where(F.col("count") > limit).drop("count")
    hot = staged(parents.join(hot, key), "trie-hot")
    columns = [*nodes.columns, "parent_conv_id"]
    root = nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    many = below.join(F.broadcast(hot), key)
    few = below.join(F.broadcast(hot), key, "left_anti").join(parents, key)
    return root.select(columns).union(many.select(columns)).union(few.select(columns))


def prefix_trie(conversations: Conversations) -> DataFrame:
    """A row per distinct sequence of first turns, from the root, which has none:

    conv_id, the smallest member (a conversation that starts with it); depth, its turns;
    parent_conv_id, of the prefix one turn shorter (root: null); n_convs, members; n_children;
    n_leaves, childless nodes from here on; saved_tokens, summed from here on, each node's
    (n_convs - 1) times the code points of its last text; ends_sha256 of the conversations that
    end here, ascending, comma-joined. A node counts among its own. Without conversations there
    is no node; turnless ones make a root.
    """
    bits = lambda *c: F.xxhash64(*[F.col(x) for x in c])
    turns = conversations.turns.select(
        "conv_id", "segment", "place", bits("place", "n1", "n2").alias("x"), bits("n2", "place", "n1").alias("y"), "chars"
    )
    turns = staged(turns, "trie-rebuilt")
    segments = staged(
        turns.groupBy("conv_id", "segment").agg(
            F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.sum("chars").alias("chars"), F.count("*").alias("n")
        ),
        "trie-segments",
    )

    # Identical conversations collapse.
    whole = segments.groupBy("conv_id").agg(
        F.sum("n").alias("depth"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.sum("chars").alias("total")
    )
    members = conversations.convs.join(whole, "conv_id", "left").na.fill(0, ["depth", "x", "y", "total"])
    members = staged(members, "trie-members")
    key = ["depth", "x", "y"]
    sequences = staged(
        members.groupBy(*key).agg(
            F.min("conv_id").alias("conv_id"), F.count("*").alias("weight"), F.first("total").alias("total")
        ),
        "trie-sequences",
    )

    # The prefixes of each distinct sequence. What lies before a segment: one row per segment.
    kept = sequences.select("conv_id", F.col("depth").alias("turns"), "weight", "total")
    earlier = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    roots = kept.select("conv_id", F.lit(_ROOT).alias("segment"))
    zero = F.lit(0).cast("long")
    offsets = segments.join(kept, "conv_id").select(
        "conv_id",
        "segment",
        *[F.coalesce(f(c).over(earlier), zero).alias(f"{c}0") for f, c in ((F.bit_xor, "x"), (F.bit_xor, "y"), (F.sum, "chars"))],
        "turns",
        "weight",
        "total",
    )
    so_far = Window.partitionBy("conv_id", "segment").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    inside = turns.join(offsets, ["conv_id", "segment"]).select(
        "conv_id",
        "segment",
        F.col("place").alias("depth"),
        F.bit_xor("x").over(so_far).bitwiseXOR(F.col("x0")).alias("x"),
        F.bit_xor("y").over(so_far).bitwiseXOR(F.col("y0")).alias("y"),
        F.col("x").alias("own_x"),
        F.col("y").alias("own_y"),
        (F.sum("chars").over(so_far) + F.col("chars0") - F.col("chars")).alias("before"),
        "turns",
        "weight",
        "total",
    )
    prefixes = inside.select(
        "conv_id", "segment", *key,
        F.col("x").bitwiseXOR(F.col("own_x")).alias("px"), F.col("y").bitwiseXOR(F.col("own_y")).alias("py"),
        "before", "turns", "weight", "total",
    )
    nothing = F.lit(None).cast("long")
    prefixes = prefixes.union(
        roots.join(kept, "conv_id").select(
            "conv_id", "segment", zero, zero, zero, nothing, nothing, zero, "turns", "weight", "total"
        )
    )
    prefixes = staged(prefixes, "trie-prefixes")
    nodes = staged(
        prefixes.groupBy(*key).agg(
            F.min("conv_id").alias("conv_id"),
            F.max("turns").alias("longest"),
            F.min("before").alias("before"),
            F.min("px").alias("px"),
            F.min("py").alias("py"),
        ),
        "trie-nodes",
    )

    # Leaves are sequences that are no proper prefix of another. A node belongs to the sequence of its smallest
    # conversation, which then owns all nodes from there on, so that each text counts once.
    leaves = sequences.join(nodes.where("longest > depth"), key, "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    owned = nodes.groupBy("conv_id").agg(F.min(F.struct("depth", "before"))["before"].alias("owned"))
    known = kept.select("conv_id").join(leaves, "conv_id", "left").join(owned, "conv_id", "left")
    places = segments.select("conv_id", "segment").union(roots)
    rows = prefixes.join(places.join(known, "conv_id"), ["conv_id", "segment"])

    longer = F.col("weight") * (F.col("total") - F.col("before"))
    once = F.when(F.col("owned").isNotNull(), F.col("total") - F.greatest("before", "owned")).otherwise(zero)
    none = F.lit(None)
    parts = rows.select(
        *key, "conv_id", F.col("weight").alias("convs"), F.coalesce("leaf", F.lit(0)).cast("long").alias("leaf"),
        (longer - once).alias("saved"), zero.alias("child"), none.cast("string").alias("ends"), "px", "py",
    ).union(
        nodes.where("depth > 0").select(
            F.col("depth") - 1, "px", "py", nothing, zero, zero, zero, F.lit(1).cast("long"), none.cast("string"), nothing, nothing
        )
    ).union(
        _ends(members.select(*key, "conv_id")).select(*key, nothing, zero, zero, zero, zero, "ends_sha256", nothing, nothing)
    )
    counted = staged(
        parts.groupBy(*key).agg(
            F.min("conv_id").alias("conv_id"),
            F.sum("convs").alias("n_convs"),
            F.sum("child").alias("n_children"),
            F.sum("leaf").alias("n_leaves"),
            F.sum("saved").alias("saved_tokens"),
            F.coalesce(F.max("ends"), F.sha2(F.lit(""), 256)).alias("ends_sha256"),
            F.min("px").alias("px"),
            F.min("py").alias("py"),
        ),
        "trie-counted",
    )
    return _with_parents(counted, nodes).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )

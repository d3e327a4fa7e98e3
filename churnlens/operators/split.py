"""Deterministic shuffles, samples and splits by a hash of a unique key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.scalars import hash_order
from ..session import col

BUCKETS = 1 << 16
_BUCKET_BITS = 52 - 16


def shuffle(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Rows in a random but repeatable order (a range-partitioned sort)."""
    return df.orderBy(hash_order(col(key), seed), col(key))


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` random rows: per-task top n, then a merge."""
    return shuffle(df, key, seed).limit(n)


def split_by_hash(
    df: DataFrame, key: str, seed: int = 42, cuts: tuple[float, float] = (0.7, 0.85)
) -> DataFrame:
    """Adds ``part``; the sizes are met on average. No shuffle, one pass."""
    u = hash_order(col(key), seed) / F.lit(float(1 << 52))
    return df.withColumn(
        "part",
        F.when(u < cuts[0], "train").when(u < cuts[1], "validate").otherwise("test"),
    )


def split_exact(
    df: DataFrame, key: str, seed: int = 42, cuts: tuple[float, float] = (0.7, 0.85)
) -> DataFrame:
    """Adds ``part`` with exactly int(cut*n) rows before each cut.

    No global sort: rows are counted per hash range (a fixed number of ranges), and only the
    two ranges that hold a cut are looked at, hash by hash. Rows of one key, NULL too, stay
    together: if a cut falls among them, they come after it.
    """
    h = hash_order(col(key), seed)
    bucket = F.shiftright(h, _BUCKET_BITS).cast("int")
    counts = df.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    # At most BUCKETS rows, however large the table.
    running = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = counts.select("bucket", "n", F.sum("n").over(running).alias("upto"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    placed = upto.withColumn("total", total)

    def threshold(share: float):
        """The hash at rank int(share*n); rows below it come before the cut."""
        cut = F.floor(F.lit(share) * F.col("total")).cast("bigint")
        holder = (
            placed.where((F.col("upto") > cut) & (F.col("upto") - F.col("n") <= cut))
            .select(F.struct("bucket", (cut - (F.col("upto") - F.col("n"))).alias("rank")))
            .scalar()
        )
        w = Window.orderBy("h")
        inside = df.select(h.alias("h"), bucket.alias("bucket")).where(
            F.col("bucket") == holder["bucket"]
        )
        upto_h = F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return (
            # A row per key of the range, however often the key repeats.
            inside.groupBy("h")
            .agg(F.count("*").alias("n"))
            .withColumn("upto", upto_h)
            .where(F.col("upto") > holder["rank"])
            .agg(F.min("h").alias("h"))
            .scalar()
        )

    # No such hash (the cut is at the end) means that all rows come before it.
    first, second = threshold(cuts[0]), threshold(cuts[1])
    return df.withColumn(
        "part",
        F.when(first.isNull() | (h < first), "train")
        .when(second.isNull() | (h < second), "validate")
        .otherwise("test"),
    )

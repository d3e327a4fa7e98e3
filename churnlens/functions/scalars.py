"""Column functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_date(value: Column, strict: bool = True) -> Column:
    """Text to date; bad text is an error, or NULL when not strict."""
    return F.to_date(value) if strict else F.try_to_date(value)


def date_parts(date: Column) -> tuple[Column, Column]:
    """(month, year)."""
    return F.month(date), F.year(date)


def user_prefix(address: Column) -> Column:
    """The part before '@' with dots as underscores, and one more underscore."""
    return F.concat(F.replace(F.substring_index(address, "@", 1), F.lit("."), F.lit("_")), F.lit("_"))


def bool_label(flag: Column) -> Column:
    return flag.cast("int")


def threshold_label(probability: Column, threshold: float = 0.5) -> Column:
    """1 strictly above the threshold, else 0; NaN and NULL are not above it."""
    return F.when((probability > threshold) & ~F.isnan(probability), 1).otherwise(0)


def monthly_spend() -> Column:
    return F.col("avg_utilization_ratio") * F.col("credit_limit")


def hash_order(key: Column, seed: int = 42) -> Column:
    """A number below 2**52 that looks random but depends on key and seed alone.

    It gives shuffles, samples and splits that any engine with md5 can repeat. NULL counts as
    an empty text.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substr(digest, F.lit(1), F.lit(13)), 16, 10).cast("bigint")

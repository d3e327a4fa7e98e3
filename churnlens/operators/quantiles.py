"""Exact interpolated quantiles of large columns.

The exact aggregate keeps every distinct value. So a sketch first brackets the wanted ranks; a
second sketch of the values inside the bracket narrows it. All values outside the bracket are
pulled onto its ends, which moves no order statistic inside it, and the exact aggregate keeps
only the few distinct values that remain: about rows / accuracy**2 of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import col

ACCURACY = 100_000
GRID = 1_000


def exact_quantiles(
    df: DataFrame, wanted: dict[str, tuple[str, float]], accuracy: int = ACCURACY
) -> DataFrame:
    """One row; ``wanted`` maps an output name to (column, quantile). NULLs are left out.

    A sketch's rank error is at most rows/accuracy, and a bracket is twice that wide on each
    side. The second sketch sees only what is inside the first bracket, and the ranks there
    follow from the number of values below it. Up to ten times ``accuracy`` values need no
    bracket.
    """
    margin = 2.0 / accuracy
    brackets = df.agg(
        F.struct(
            *[
                F.when(
                    F.count(col(c)) > 10 * accuracy,
                    F.percentile_approx(
                        col(c), [max(q - margin, 0.0), min(q + margin, 1.0)], accuracy
                    ),
                ).alias(name)
                for name, (c, q) in wanted.items()
            ]
        ).alias("brackets")
    ).scalar()
    brackets = _narrowed(df, wanted, brackets, accuracy)

    def clamped(name: str, c: str) -> Column:
        # greatest and least skip NULL, that is, a missing bracket.
        low, high = brackets[name][0], brackets[name][1]
        return F.when(col(c).isNotNull(), F.greatest(F.least(col(c), high), low))

    return df.agg(
        *[F.percentile(clamped(name, c), q).alias(name) for name, (c, q) in wanted.items()]
    )


def _narrowed(df: DataFrame, wanted: dict[str, tuple[str, float]], first: Column, accuracy: int) -> Column:
    """Brackets around the same ranks from a sketch of the values inside the first brackets: a grid
    of ``GRID`` quantiles of those values, and the two of it that surround the wanted rank."""
    def inside(name: str, c: str) -> Column:
        return F.when((col(c) >= first[name][0]) & (col(c) <= first[name][1]), col(c))

    grid = [i / GRID for i in range(GRID + 1)]
    facts = df.agg(
        *[
            F.struct(
                F.count(col(c)).alias("n"),
                F.count_if(col(c) < first[name][0]).alias("below"),
                F.count(inside(name, c)).alias("within"),
                F.percentile_approx(inside(name, c), grid, accuracy).alias("grid"),
            ).alias(name)
            for name, (c, _) in wanted.items()
        ]
    )
    brackets = []
    for name, (_, q) in wanted.items():
        f = F.col(name)
        # The wanted rank, from 0, among the values within; one step more on either side for the
        # neighbour that is interpolated with, the error of the sketch and rounding.
        place = (F.lit(q) * (f["n"] - 1) - f["below"]) / F.greatest(f["within"], F.lit(1)) * GRID
        slack = F.lit(2.0 + 2.0 * GRID / accuracy) + F.lit(2.0 * GRID) / F.greatest(f["within"], F.lit(1))
        low = F.greatest(F.floor(place - slack), F.lit(0)).cast("int")
        high = F.least(F.ceil(place + slack), F.lit(GRID)).cast("int")
        ends = F.array(F.get(f["grid"], low), F.get(f["grid"], high))
        brackets.append(ends.alias(name))
    return facts.select(F.struct(*brackets).alias("brackets")).scalar()


def median_value(df: DataFrame, column: str, accuracy: int = ACCURACY) -> DataFrame:
    return exact_quantiles(df, {column: (column, 0.5)}, accuracy)


def quantile_caps(
    df: DataFrame, quantiles: dict[str, float], accuracy: int = ACCURACY
) -> DataFrame:
    return exact_quantiles(df, {c: (c, q) for c, q in quantiles.items()}, accuracy)


def trim_outliers(
    df: DataFrame, quantiles: dict[str, float], accuracy: int = ACCURACY
) -> DataFrame:
    """Rows strictly below all caps. The caps are a scalar subquery, so this stays one plan."""
    caps = quantile_caps(df, quantiles, accuracy)
    cap = caps.select(F.struct(*[col(c) for c in quantiles])).scalar()
    keep = F.lit(True)
    for c in quantiles:
        keep = keep & (col(c) < cap[c])
    return df.where(keep)

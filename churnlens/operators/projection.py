"""Column and row selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import col, quoted


def project(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.selectExpr(*[quoted(c) for c in columns])


def drop_columns(df: DataFrame, columns: list[str], strict: bool = True) -> DataFrame:
    """Drop by name; ``strict`` raises on a missing name, otherwise it is ignored."""
    missing = [c for c in columns if c not in df.columns]
    if strict and missing:
        raise ValueError(f"columns not found: {missing}")
    return df.drop(*columns)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def insert_at(df: DataFrame, position: int, name: str, value: Column) -> DataFrame:
    """Put a new column, or an existing one, at a position."""
    others = [c for c in df.columns if c != name]
    if not 0 <= position <= len(others):
        raise ValueError(f"position {position} is outside 0..{len(others)}")
    order = others[:position] + [name] + others[position:]
    return df.withColumn(name, value).select(*[col(c) for c in order])


def select_existing(df: DataFrame, columns: list[str]) -> DataFrame:
    """The listed columns that exist."""
    return project(df, [c for c in columns if c in df.columns])


def filter_null_rows(df: DataFrame, column: str, n: int, order: list[str]) -> DataFrame:
    """The first ``n`` rows whose column is missing."""
    return head_n(df.where(missing_sql(df, [column])[column]), n, order)


def drop_null_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.na.drop(subset=columns)


def fill_constant(df: DataFrame, column: str, value) -> DataFrame:
    return df.na.fill({column: value})


def head_n(df: DataFrame, n: int, order: list) -> DataFrame:
    """First rows in a stated order: per-task top n, then a merge."""
    return df.orderBy(*order).limit(n)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """Any ``n`` rows; reads as few tasks as it can."""
    return df.limit(n)


def sort_desc(df: DataFrame, column: str, *ties: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(column), *ties)


def drop_tail(scores: DataFrame, column: str, n: int, *ties: str) -> DataFrame:
    """All but the ``n`` lowest rows, highest first; a missing value is lower than any. For
    tables with a row per feature: the ranks are worked out in one task."""
    lowest = Window.orderBy(F.asc_nulls_first(column), *[F.desc_nulls_first(t) for t in ties])
    kept = scores.withColumn("_place", F.row_number().over(lowest)).where(F.col("_place") > n)
    return sort_desc(kept.drop("_place"), column, *ties)


def axis_projection(
    df: DataFrame, x: str = "status_Attrited Customer", y: str = "avg_trans_per_month"
) -> DataFrame:
    """A chosen pair of columns as x and y."""
    return df.select(col(x).alias("x"), col(y).alias("y"))


def missing_sql(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """Per column a test for NULL, or NaN in a floating column, as SQL text."""
    kinds = dict(df.dtypes)
    return {
        c: f"({quoted(c)} is null or isnan({quoted(c)}))"
        if kinds[c] in ("double", "float")
        else f"({quoted(c)} is null)"
        for c in columns
    }


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating columns becomes NULL, so that one test for missing will do."""
    return df.select(
        *[
            F.when(~F.isnan(col(c)), col(c)).alias(c) if t in ("double", "float") else col(c)
            for c, t in df.dtypes
        ]
    )

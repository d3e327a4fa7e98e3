"""Missing values: profiles and imputation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import ACCOUNT_GRAIN_COLUMNS, GOLD_COLUMNS, TRANSACTION_COLUMNS
from ..session import col, quoted
from .projection import missing_sql
from .quantiles import median_value


def long_form(row: DataFrame, records: list[dict[str, Column]]) -> DataFrame:
    """A one-row frame as one row per record, without a shuffle."""
    return row.select(
        F.inline(
            F.array(*[F.struct(*[v.alias(k) for k, v in r.items()]) for r in records])
        )
    )


def _null_totals(df: DataFrame, columns: list[str], weight: str | None) -> DataFrame:
    """One row: all rows, and the missing values of each column."""
    w = "1" if weight is None else quoted(weight)
    counts = [
        f"coalesce(sum(case when {test} then {w} else 0 end), 0) as {quoted(c)}"
        for c, test in missing_sql(df, columns).items()
    ]
    return df.selectExpr(f"coalesce(sum({w}), 0) as _rows", *counts)


def _per_column(row: DataFrame, columns: list[str], value: str) -> DataFrame:
    """A one-row frame as (column, value), other columns kept."""
    others = [c for c in row.columns if c not in columns]
    return row.unpivot(others, [quoted(c) for c in columns], "column", value)


def null_counts(
    df: DataFrame, columns: list[str] | None = None, weight: str | None = None
) -> DataFrame:
    """(column, nulls) for every column, in one pass; ``weight`` counts a row that often."""
    columns = columns or df.columns
    return _per_column(_null_totals(df, columns, weight), columns, "nulls").drop("_rows")


def null_percent(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, null_percent)."""
    columns = columns or df.columns
    counts = _per_column(_null_totals(df, columns, None), columns, "nulls")
    return counts.selectExpr("column", "try_divide(nulls * 100D, _rows) as null_percent")


def gold_null_counts(weighted: DataFrame) -> DataFrame:
    """Null counts of the denormalised table from its weighted account grain. There, a
    transaction column is missing wherever it was not counted."""
    missing = [f"gold_rows - n_{c} as {c}" for c in TRANSACTION_COLUMNS]
    tests = missing_sql(weighted, ACCOUNT_GRAIN_COLUMNS)
    lost = [f"case when {t} then gold_rows else 0 end as {c}" for c, t in tests.items()]
    sums = [f"coalesce(sum({c}), 0) as {c}" for c in GOLD_COLUMNS]
    return _per_column(weighted.selectExpr(*lost, *missing).selectExpr(*sums), GOLD_COLUMNS, "nulls")


def value_counts(df: DataFrame, column: str, weight: str | None = None) -> DataFrame:
    """(value, n) descending, NULL left out."""
    n = F.count("*") if weight is None else F.sum(weight)
    return (
        df.where(col(column).isNotNull())
        .groupBy(col(column).alias("value"))
        .agg(n.alias("n"))
        .orderBy(F.desc("n"), "value")
    )


def mode_value(df: DataFrame, column: str) -> DataFrame:
    """The most frequent value, the smallest among equals. One row, or none if all are NULL."""
    return value_counts(df, column).limit(1).select(F.col("value").alias(column))


def impute_mode(df: DataFrame, column: str) -> DataFrame:
    mode = mode_value(df, column).scalar()
    return df.withColumn(column, F.coalesce(col(column), mode))


def impute_median(df: DataFrame, column: str) -> DataFrame:
    """Missing values, NaN among them, take the exact median of the others."""
    given = df.withColumn(column, F.when(~F.expr(missing_sql(df, [column])[column]), col(column)))
    median = median_value(given, column).scalar()
    return given.withColumn(column, F.coalesce(col(column), median))


def clean_customers(customer: DataFrame) -> DataFrame:
    """The three imputations of the customer table."""
    out = impute_mode(customer, "marital_status")
    out = impute_mode(out, "education_level")
    return impute_median(out, "income")


def table_profile(df: DataFrame, weight: str | None = None) -> DataFrame:
    """(rows, columns)."""
    n = F.count("*") if weight is None else F.sum(weight)
    return df.agg(n.alias("rows")).withColumn("columns", F.lit(len(df.columns)))

"""Dashboard figures. ``weight`` names the number of denormalised rows a row stands for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import KPI_MEAN_COLUMNS, LABEL
from ..session import col


def _mean(column: str, weight: str | None) -> Column:
    if weight is None:
        return F.avg(col(column))
    present = F.when(col(column).isNotNull(), F.col(weight))
    return F.try_divide(F.sum(col(column) * F.col(weight)), F.sum(present))


def kpi_means(df: DataFrame, columns: list[str] | None = None, weight: str | None = None) -> DataFrame:
    return df.agg(*[_mean(c, weight).alias(c) for c in columns or KPI_MEAN_COLUMNS])


def kpi_avg_credit_limit(df: DataFrame, weight: str | None = None) -> DataFrame:
    return df.agg(_mean("credit_limit", weight).alias("avg_credit_limit"))


def kpi_total_customers(accounts: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct customers. The account grain holds the same ones as the denormalised table."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return accounts.agg(count(F.col("customer_id")).alias("total_customers"))


def kpi_avg_revolving_bal(df: DataFrame, weight: str | None = None) -> DataFrame:
    return df.agg(_mean("total_revolving_bal", weight).alias("total_revolving_bal"))


def kpi_status_counts(features: DataFrame, label: str = LABEL) -> DataFrame:
    """Customers per status, captioned by the label's value."""
    caption = F.when(col(label) == 1, "Attrited").otherwise("Active")
    return (
        features.where(col(label).isNotNull())
        .groupBy(caption.alias("status"))
        .agg(F.count("*").alias("customers"))
    )


def kpi_total_transactions(gold: DataFrame) -> DataFrame:
    return gold.agg(F.count("transaction_date").alias("transaction_date"))


def kpi_total_transactions_weighted(weighted: DataFrame) -> DataFrame:
    return weighted.agg(F.sum("n_transaction_date").alias("transaction_date"))

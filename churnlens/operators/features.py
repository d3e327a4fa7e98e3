"""Features: 0/1 columns, spend, monthly activity, one row per customer.

The row-level forms take the denormalised table. The ``_by_account`` forms and
``customer_features`` take the account grain and the transactions, reduce the transactions per
account before any join, and give the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import date_parts, monthly_spend
from ..schemas import (
    ENGINEERED_COLUMNS,
    KEY_COLUMNS,
    NUMERIC_FEATURES,
    dummy_names,
)
from ..session import col, literal, quoted
from .joins import DEFAULT_POLICY, Dealt, SkewPolicy, deal, heavy_keys, hot_of, outer_join, own_salt, parts_of, salts_of
from .projection import project

# Which row of a customer comes first; missing values last.
FIRST_ROW_ORDER = ["account_id", "transaction_date", "transaction_id", "transaction_amount"]
# Parts that the customers without an account are dealt to.
OWNER_SALTS, LEAST_OWNER_PARTS = 1_000, 8


def discover_domains(df: DataFrame, columns: list[str], limit: int = 1_000) -> dict[str, list[str]]:
    """Sorted distinct values per column. They become columns, so more than ``limit`` is an
    error, and no more than that reaches the driver."""
    found = [
        df.where(col(c).isNotNull())
        .select(F.lit(c).alias("column"), col(c).cast("string").alias("value"))
        .distinct()
        .limit(limit + 1)
        for c in columns
    ]
    domains: dict[str, list[str]] = {c: [] for c in columns}
    for row in reduce(DataFrame.unionByName, found).collect():
        domains[row["column"]].append(row["value"])
    for c, values in domains.items():
        if len(values) > limit:
            raise ValueError(f"{c} has more than {limit} distinct values")
        values.sort()
    return domains


def one_hot(df: DataFrame, domains: dict[str, list[str]]) -> DataFrame:
    """Replace each categorical column by one 0/1 column per category, appended at the end.
    A missing value has 0 in all of them."""
    kept = [quoted(c) for c in df.columns if c not in domains]
    dummies = [
        f"coalesce(cast({quoted(c)} = {literal(v)} as int), 0) as {quoted(f'{c}_{v}')}"
        for c, values in domains.items()
        for v in values
    ]
    return df.selectExpr(*kept, *dummies)


def add_monthly_spend(df: DataFrame) -> DataFrame:
    return df.withColumn("avg_monthly_spend", monthly_spend())


# -- monthly activity ---------------------------------------------------------------------


def _dated(df: DataFrame) -> DataFrame:
    month, year = date_parts(F.col("transaction_date"))
    return df.where(F.col("transaction_date").isNotNull()).withColumns(
        {"year": year, "month": month}
    )


def monthly_txn_counts(gold: DataFrame) -> DataFrame:
    """Rows per customer, year and month; rows with a missing key do not count."""
    return (
        _dated(gold.where(F.col("customer_id").isNotNull()))
        .groupBy("customer_id", "year", "month")
        .agg(F.count("*").alias("num_transactions"))
    )


def deal_transactions(transactions: DataFrame) -> Dealt:
    """The transactions dealt by account, so that what a task counts or sorts is bounded."""
    return deal(transactions.select([c for c in FIRST_ROW_ORDER if c in transactions.columns]), "account_id")


@dataclass(frozen=True)
class Owners:
    """How rows are dealt by customer: over parts whose number grows with the accounts and
    transactions (None: few, left to Spark), and a hot customer's over salts first. ``hot_account``: whether too many rows of
    the account grain share an account (or have none) for one task."""

    parts: int | None
    salts: dict[object, int]
    hot_account: bool

    def salted(self, rows: DataFrame) -> DataFrame:
        """The rows dealt by customer and by a column ``_salt``."""
        rows = own_salt(rows, "_salt", F.col("customer_id"), self.salts)
        return rows.repartition(self.parts, "customer_id", "_salt") if self.parts else rows

    def dealt(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(self.parts, "customer_id") if self.parts else rows


def owners_of(accounts: DataFrame, dealt: Dealt, policy: SkewPolicy = DEFAULT_POLICY) -> Owners:
    """The layout by customer; one pass over the keys of the account grain."""
    found = heavy_keys([(c, accounts, c) for c in ("customer_id", "account_id")], policy)
    parts = parts_of(max(found["customer_id"].rows, dealt.parts * policy.rows_per_part), policy)
    salts = salts_of(found["customer_id"].counts, policy)
    return Owners(parts, salts, bool(hot_of(found["account_id"].counts, {}, policy)))


def _owned_months(accounts: DataFrame, transactions: DataFrame, dealt: Dealt | None = None) -> DataFrame:
    """(customer, year, month, n) of each account and month; NULL accounts match."""
    dealt = dealt or deal_transactions(transactions)
    keyed = _dated(dealt.rows.where(F.col("account_id").isNotNull()))
    monthly = keyed.groupBy(*dealt.keys, "year", "month").agg(F.count("*").alias("n"))
    if len(dealt.keys) > 1:
        monthly = monthly.groupBy("account_id", "year", "month").agg(F.sum("n").alias("n"))
    owners = accounts.where(F.col("customer_id").isNotNull()).select("customer_id", "account_id")
    held = owners.where(F.col("account_id").isNotNull()).repartition(dealt.parts, "account_id")
    # As many rows as transactions at worst, so not for broadcasting.
    owned = held.join(monthly.hint("merge"), "account_id").select("customer_id", "year", "month", "n")
    # All customers without an account meet the months of the transactions without one. They are
    # dealt over salts, and those few months copied to each, so that no task gets them all.
    loose = _dated(transactions.where(F.col("account_id").isNull())).groupBy("year", "month").agg(F.count("*").alias("n"))
    loose = loose.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(OWNER_SALTS - 1))))
    own = F.pmod(F.xxhash64("customer_id"), F.lit(OWNER_SALTS)).cast("int")
    without = owners.where(F.col("account_id").isNull()).withColumn("_salt", own)
    # Few bytes and many pairs: a fixed number of parts, which adaptive execution doesn't put together.
    salted = max(dealt.parts, LEAST_OWNER_PARTS)
    without, loose = (side.repartition(salted, "_salt") for side in (without, loose))
    met = without.join(loose.hint("merge"), "_salt").select("customer_id", "year", "month", "n")
    return owned.union(met)


def monthly_txn_counts_by_account(
    accounts: DataFrame, transactions: DataFrame, dealt: Dealt | None = None, owners: Owners | None = None
) -> DataFrame:
    """The same from the account grain: count per account and month, then join."""
    dealt = dealt or deal_transactions(transactions)
    owners = owners or owners_of(accounts, dealt)
    owned, keys = _owned_months(accounts, transactions, dealt), ["customer_id", "year", "month"]
    if owners.salts:
        owned = owners.salted(owned).groupBy(*keys, "_salt").agg(F.sum("n").alias("n"))
    return owners.dealt(owned).groupBy(keys).agg(F.sum("n").alias("num_transactions"))


def avg_txn_per_month(monthly: DataFrame) -> DataFrame:
    """Mean over the months in which the customer was active."""
    return monthly.groupBy("customer_id").agg(
        F.avg("num_transactions").alias("avg_trans_per_month")
    )


def attach_customer_agg(rows: DataFrame, aggregate: DataFrame) -> DataFrame:
    """Join a per-customer figure to every row; a NULL customer gets none."""
    return rows.join(aggregate, "customer_id", "left")


# -- one row per customer -----------------------------------------------------------------


def _nulls_last(names: list[str]) -> list[Column]:
    return [F.asc_nulls_last(c) for c in names]


def first_row_per_customer(df: DataFrame, order: list[str] | None = None, *salt: str) -> DataFrame:
    """The first row of each customer (and salt); NULL is a customer too. Every task keeps only its own
    first rows before the shuffle."""
    w = Window.partitionBy("customer_id", *salt).orderBy(*_nulls_last(order or FIRST_ROW_ORDER))
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def first_transactions(transactions: DataFrame, dealt: Dealt | None = None) -> DataFrame:
    """The first transaction of each account; where some account is hot, by minima of its salts."""
    dealt = dealt or deal_transactions(transactions)
    names = FIRST_ROW_ORDER[1:]
    # A struct compares field by field; the flag before each field puts its NULLs last.
    ordered = F.struct(*[x for c in names for x in (F.isnull(c).alias(f"no_{c}"), F.col(c))])
    first = dealt.rows.groupBy(dealt.keys).agg(F.min(ordered).alias("first"))
    if len(dealt.keys) > 1:
        first = first.groupBy("account_id").agg(F.min("first").alias("first"))
    return first.select("account_id", *[F.col("first")[c].alias(c) for c in names])


def first_row_by_account(
    accounts: DataFrame, transactions: DataFrame, dealt: Dealt | None = None, owners: Owners | None = None
) -> DataFrame:
    """The same from the account grain."""
    dealt = dealt or deal_transactions(transactions)
    owners = owners or owners_of(accounts, dealt)
    # One row per account on the right: no product, and adaptive execution may split a hot left.
    parts = None if owners.hot_account else owners.parts
    rows = outer_join(accounts, first_transactions(transactions, dealt), "account_id", "left", [], parts=parts)
    if owners.salts:
        rows = first_row_per_customer(owners.salted(rows), None, "_salt").drop("_salt")
    return first_row_per_customer(owners.dealt(rows))


def feature_columns(domains: dict[str, list[str]]) -> list[str]:
    return KEY_COLUMNS + NUMERIC_FEATURES + dummy_names(domains)


def engineered_rows(
    gold: DataFrame, domains: dict[str, list[str]]
) -> DataFrame:
    """The denormalised table with all features, one row per transaction."""
    average = avg_txn_per_month(monthly_txn_counts(gold))
    rows = attach_customer_agg(add_monthly_spend(one_hot(gold, domains)), average)
    return project(rows, feature_columns(domains))


def account_features(
    accounts: DataFrame, transactions: DataFrame, domains: dict[str, list[str]]
) -> DataFrame:
    """The account grain with all features but those of a single transaction. Joined with the
    transactions it gives ``engineered_rows``, of which then nothing has to be counted or written."""
    average = avg_txn_per_month(monthly_txn_counts_by_account(accounts, transactions))
    return attach_customer_agg(add_monthly_spend(one_hot(accounts, domains)), average)


def customer_features(
    accounts: DataFrame, transactions: DataFrame, domains: dict[str, list[str]]
) -> DataFrame:
    """One row per customer: keys, numeric features, 0/1 columns."""
    dealt = deal_transactions(transactions)
    owners = owners_of(accounts, dealt)
    average = avg_txn_per_month(monthly_txn_counts_by_account(accounts, transactions, dealt, owners))
    first = first_row_by_account(accounts, transactions, dealt, owners)
    rows = attach_customer_agg(add_monthly_spend(one_hot(first, domains)), average)
    return project(rows, feature_columns(domains))


def project_engineered(features: DataFrame, key: str | None = None) -> DataFrame:
    """The nine model columns, after ``key`` if one is to be kept."""
    return project(features, ([key] if key else []) + ENGINEERED_COLUMNS)

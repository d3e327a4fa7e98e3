"""Denormalisation of the five source tables.

``build_gold`` gives one row per customer x account x transaction. Everything computed *from*
that table has a cheaper equal: the account grain (``gold_accounts``) with the number of joined
rows as a weight (``gold_weighted``), because transactions can be counted per account before
they are joined. The weighted form never expands the NULL-account block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..fixtures import Tables
from ..schemas import ACCOUNT_GRAIN_COLUMNS, GOLD_COLUMNS, OPEN_STATUS
from .joins import DEFAULT_POLICY, HotKey, KeyLoad, SkewPolicy, dealt_parts, heavy_keys, hot_of, outer_join, parts_of
from .projection import fill_constant, missing_sql


# -- the four full outer joins, one by one ------------------------------------------------


def join_customer_closed(customer: DataFrame, closed: DataFrame, **skew) -> DataFrame:
    return outer_join(customer, closed, "customer_id", **skew)


def join_accounts(joined: DataFrame, account: DataFrame, **skew) -> DataFrame:
    """The closure table's account_id gives way to the account table's."""
    return outer_join(joined.drop("account_id"), account, "customer_id", **skew)


def join_metrics(joined: DataFrame, metrics: DataFrame, **skew) -> DataFrame:
    return outer_join(joined, metrics, "customer_id", **skew)


def join_transactions(joined: DataFrame, transactions: DataFrame, **skew) -> DataFrame:
    return outer_join(joined, transactions, "account_id", **skew)


# -- the denormalised table ---------------------------------------------------------------


CUSTOMER_SIDES = ("customer", "closed", "account", "metrics")


def _customer_layout(found: dict[str, KeyLoad], policy: SkewPolicy) -> tuple[dict[str, list[HotKey]], int | None]:
    """Hot keys of the sides joined to the metrics, and a number of parts that grows with the largest."""
    hot = {n: hot_of({}, found[n].counts, policy) for n in CUSTOMER_SIDES[:3]}
    return hot, parts_of(max(found[n].rows for n in CUSTOMER_SIDES), policy)


def gold_accounts(
    tables: Tables,
    policy: SkewPolicy = DEFAULT_POLICY,
    hot: dict[str, list[HotKey]] | None = None,
    fill_status: bool = True,
    parts: int | None = None,
) -> DataFrame:
    """One row per customer x account, for customers whose metrics are present.

    Dropping rows without total_relationship_count leaves exactly the metrics rows of the full
    outer chain, so the chain is three left joins from metrics. They are dealt by customer_id over
    ``parts``, whose number is found together with the hot keys where these are not given.
    """
    if hot is None:
        found = heavy_keys([(n, getattr(tables, n), "customer_id") for n in CUSTOMER_SIDES], policy)
        hot, parts = _customer_layout(found, policy)
    count = "total_relationship_count"
    out = tables.metrics.where(~F.expr(missing_sql(tables.metrics, [count])[count]))
    sides = {
        "customer": tables.customer,
        "closed": tables.closed.drop("account_id"),
        "account": tables.account,
    }
    for name, side in sides.items():
        out = outer_join(out, side, "customer_id", "left", hot.get(name, []), policy, parts=parts)
    out = out.select(ACCOUNT_GRAIN_COLUMNS)
    return fill_constant(out, "status", OPEN_STATUS) if fill_status else out


def build_gold(
    tables: Tables,
    null_keys: str = "match",
    policy: SkewPolicy = DEFAULT_POLICY,
    fill_status: bool = True,
) -> DataFrame:
    """The full denormalised table, 21 columns.

    ``null_keys='match'``: customers without an account meet all transactions without one.
    ``'drop'``: transactions without an account join nobody.
    """
    if null_keys not in ("match", "drop"):
        raise ValueError(f"null_keys must be 'match' or 'drop', not {null_keys!r}")
    transactions = tables.transactions
    if null_keys == "drop":
        transactions = transactions.where(F.col("account_id").isNotNull())
    # One sketch job for all joins of the chain.
    found = heavy_keys(
        [(n, getattr(tables, n), "customer_id") for n in CUSTOMER_SIDES]
        + [("transactions", transactions, "account_id")],
        policy,
    )
    hot, parts = _customer_layout(found, policy)
    accounts = gold_accounts(tables, policy, hot, fill_status, parts)
    right = found["transactions"].counts
    left = {}
    if None in right:
        left = {None: _customers_without_account(tables)}
    hot = hot_of(left, right, policy)
    rows = max(found[n].rows for n in CUSTOMER_SIDES)
    return outer_join(
        accounts,
        transactions,
        "account_id",
        "left",
        hot,
        policy,
        null_safe=null_keys == "match",
        # Never broadcast the transactions, however small they look compressed.
        hint="merge",
        parts=dealt_parts(rows, found["transactions"].rows, hot, policy),
    ).select(GOLD_COLUMNS)


def attach_transactions(
    accounts: DataFrame, transactions: DataFrame, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Rows of the account grain, with whatever columns they have, beside their transactions; an
    account or transaction key that is NULL matches NULL, as in ``build_gold``. Both inputs are
    read twice, first for their key alone."""
    found = heavy_keys([("left", accounts, "account_id"), ("right", transactions, "account_id")], policy)
    hot = hot_of(found["left"].counts, found["right"].counts, policy)
    parts = dealt_parts(found["left"].rows, found["right"].rows, hot, policy)
    return outer_join(accounts, transactions, "account_id", "left", hot, policy, hint="merge", parts=parts)


def _customers_without_account(tables: Tables) -> int:
    """Rows of the account grain whose account_id is NULL, for the layout of the join."""
    owners = tables.account.where(F.col("account_id").isNotNull()).select("customer_id").distinct()
    return tables.metrics.join(owners, "customer_id", "left_anti").count()


# -- the same table as weights on the account grain ---------------------------------------


def transactions_by_account(transactions: DataFrame) -> DataFrame:
    """Per account: rows, rows with each field present, sum of amounts. Partial sums first,
    so an account (or NULL) with very many rows costs no more than another."""
    return transactions.groupBy("account_id").agg(
        F.count("*").alias("n_rows"),
        F.count("transaction_id").alias("n_transaction_id"),
        F.count("transaction_amount").alias("n_transaction_amount"),
        F.count("transaction_date").alias("n_transaction_date"),
        F.sum("transaction_amount").alias("sum_transaction_amount"),
    )


def gold_weighted(
    tables: Tables,
    accounts: DataFrame | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
    fill_status: bool = True,
) -> DataFrame:
    """The account grain with ``gold_rows``, the number of rows it has in ``build_gold``,
    and the non-NULL counts of the transaction columns."""
    if accounts is None:
        accounts = gold_accounts(tables, policy, fill_status=fill_status)
    summed = transactions_by_account(tables.transactions)
    # The right side has one row per account: no product, and AQE may split the left.
    return (
        outer_join(accounts, summed, "account_id", "left", [])
        .withColumn("gold_rows", F.coalesce("n_rows", F.lit(1)))
        .drop("n_rows")
        .na.fill(0, ["n_transaction_id", "n_transaction_amount", "n_transaction_date"])
    )

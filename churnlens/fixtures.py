"""The five source tables, derived from the star-schema test tables.

The view texts run unchanged in Spark and, with double quotes for backticks, in DuckDB.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "customer": (
        "customer",
        """
select cast(c_custkey as string) customer_id,
       cast(20 + c_custkey % 60 as double) customer_age,
       case when c_custkey % 2 = 0 then 'F' else 'M' end gender,
       cast(c_nationkey % 6 as double) dependent_count,
       case when c_custkey % 7 = 0 then null else c_mktsegment end education_level,
       case when c_custkey % 11 = 0 then null
            when c_custkey % 3 = 0 then 'Single' else 'Married' end marital_status,
       case when c_custkey % 10 = 0 then null else c_acctbal end income
from {customer} where c_custkey % 13 <> 0""",
    ),
    "closed": (
        "orders",
        """
select cast(o_custkey as string) customer_id, 'Attrited Customer' status,
       cast(min(o_orderkey) as string) account_id
from {orders} where o_custkey % 6 = 0 group by o_custkey""",
    ),
    "account": (
        "orders",
        """
select cast(o_orderkey as string) account_id, cast(o_custkey as string) customer_id,
       o_orderpriority card_category, o_totalprice credit_limit,
       cast(o_orderdate as date) account_open_date
from {orders} where o_custkey % 17 <> 0""",
    ),
    "metrics": (
        "orders",
        """
select cast(o_custkey as string) customer_id,
       case when o_custkey % 19 = 0 then null
            else cast(count(*) as double) end total_relationship_count,
       cast(sum(case when o_orderstatus = 'P' then 1 else 0 end) as double) contacts_count_12mo,
       cast(sum(cast(o_totalprice as decimal(12,2))) as double) total_revolving_bal,
       cast(sum(case when o_orderkey % 2 = 0 then cast(o_totalprice as decimal(12,2))
                     else cast(0 as decimal(12,2)) end) as double)
         / cast(sum(cast(o_totalprice as decimal(12,2))) as double) `total_amt_chng_Q4_Q1`,
       cast(sum(case when o_orderkey % 2 = 0 then 1 else 0 end) as double)
         / cast(count(*) as double) `total_ct_chng_Q4_Q1`,
       min(o_totalprice) / max(o_totalprice) avg_utilization_ratio
from {orders} where o_custkey % 7 <> 3 group by o_custkey""",
    ),
    "transactions": (
        "lineitem",
        """
select concat(cast(l_orderkey as string), '-', cast(l_linenumber as string), '-',
              cast(l_partkey as string), '-', cast(l_suppkey as string)) transaction_id,
       l_extendedprice transaction_amount, cast(l_shipdate as date) transaction_date,
       case when l_orderkey % 997 = 0 then null else cast(l_orderkey as string) end account_id
from {lineitem}""",
    ),
    "predictions": (
        "labels",
        """
select doc_id row_id, quality label, 1 - toxic prediction,
       0.05 + cast(doc_id % 100 as double) * 0.009 score
from {labels}""",
    ),
}

# Category domains of these tables (fixed values).
FIXTURE_DOMAINS = {
    "gender": ["F", "M"],
    "education_level": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "marital_status": ["Married", "Single"],
    "card_category": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    "status": ["Attrited Customer", "Existing Customer"],
}


@dataclass(frozen=True)
class Tables:
    """The five source tables of one data set."""

    customer: DataFrame
    closed: DataFrame
    account: DataFrame
    metrics: DataFrame
    transactions: DataFrame


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, text = VIEWS[name]
    return spark.sql(text, **{table: spark.read.parquet(f"{sf_dir}/{table}.parquet")})


def load_tables(spark: SparkSession, sf_dir: str) -> Tables:
    names = ("customer", "closed", "account", "metrics", "transactions")
    # Each file's schema is looked up once, though several views may use it.
    read = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in {VIEWS[n][0] for n in names}}
    return Tables(**{n: spark.sql(VIEWS[n][1], **{VIEWS[n][0]: read[VIEWS[n][0]]}) for n in names})


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "predictions")


def view_sql(name: str) -> str:
    """The same view as one DuckDB select."""
    table, text = VIEWS[name]
    return text.replace("{" + table + "}", table).replace("`", '"').strip()

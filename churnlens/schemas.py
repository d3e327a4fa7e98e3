"""Table schemas, category domains and feature lists.

Measures are doubles: the source tables hold decimal text, and reading that text
straight into a double keeps the printed value.
"""

from __future__ import annotations

from pyspark.sql import types as T

STRING, DOUBLE, DATE = T.StringType(), T.DoubleType(), T.DateType()


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


# The schemas of the five source tables.
CLOSED_ACCOUNTS = _schema(customer_id=STRING, status=STRING, account_id=STRING)

CREDIT_ACCOUNT = _schema(
    account_id=STRING,
    customer_id=STRING,
    card_category=STRING,
    credit_limit=DOUBLE,
    account_open_date=DATE,
)

CREDIT_METRICS = _schema(
    customer_id=STRING,
    total_relationship_count=DOUBLE,
    contacts_count_12mo=DOUBLE,
    total_revolving_bal=DOUBLE,
    total_amt_chng_Q4_Q1=DOUBLE,
    total_ct_chng_Q4_Q1=DOUBLE,
    avg_utilization_ratio=DOUBLE,
)

CUSTOMER = _schema(
    customer_id=STRING,
    customer_age=DOUBLE,
    gender=STRING,
    dependent_count=DOUBLE,
    education_level=STRING,
    marital_status=STRING,
    income=DOUBLE,
)

TRANSACTIONS = _schema(
    transaction_id=STRING,
    transaction_amount=DOUBLE,
    transaction_date=DATE,
    account_id=STRING,
)

SOURCES = {
    "customer": CUSTOMER,
    "closed": CLOSED_ACCOUNTS,
    "account": CREDIT_ACCOUNT,
    "metrics": CREDIT_METRICS,
    "transactions": TRANSACTIONS,
}

# Columns of the denormalised table, without and with the transaction columns.
ACCOUNT_GRAIN_COLUMNS = [
    *CUSTOMER.names,
    "status",
    *[c for c in CREDIT_ACCOUNT.names if c != "customer_id"],
    *CREDIT_METRICS.names[1:],
]
TRANSACTION_COLUMNS = ["transaction_id", "transaction_amount", "transaction_date"]
GOLD_COLUMNS = ACCOUNT_GRAIN_COLUMNS + TRANSACTION_COLUMNS

# Identifying columns of the feature table.
KEY_COLUMNS = ["customer_id", "account_id", "account_open_date", "transaction_id", "transaction_date"]

# The category domains and the statuses.
OPEN_STATUS = "Existing Customer"
CLOSED_STATUS = "Attrited Customer"
STATUSES = [CLOSED_STATUS, OPEN_STATUS]
DOMAINS = {
    "gender": ["F", "M"],
    "education_level": [
        "College",
        "Doctorate",
        "Graduate",
        "High School",
        "Post-Graduate",
        "Uneducated",
    ],
    "marital_status": ["Divorced", "Married", "Single"],
    "card_category": ["Blue", "Gold", "Platinum", "Silver"],
    "status": STATUSES,
}

# The columns whose skewness is profiled, and the dashboard means.
SKEW_COLUMNS = [
    "customer_age",
    "dependent_count",
    "income",
    "credit_limit",
    "total_relationship_count",
    "contacts_count_12mo",
    "total_revolving_bal",
    "total_amt_chng_Q4_Q1",
    "total_ct_chng_Q4_Q1",
    "avg_utilization_ratio",
]
KPI_MEAN_COLUMNS = [
    "customer_age",
    "dependent_count",
    "income",
    "contacts_count_12mo",
    "total_revolving_bal",
]

# Outlier caps as (column, quantile).
OUTLIER_QUANTILES = {
    "income": 0.98,
    "total_amt_chng_Q4_Q1": 0.99,
    "total_ct_chng_Q4_Q1": 0.99,
}

# The numeric features, and those the models use.
NUMERIC_FEATURES = [
    "customer_age",
    "dependent_count",
    "income",
    "credit_limit",
    "total_relationship_count",
    "contacts_count_12mo",
    "total_revolving_bal",
    "total_amt_chng_Q4_Q1",
    "total_ct_chng_Q4_Q1",
    "avg_monthly_spend",
    "avg_utilization_ratio",
    "transaction_amount",
    "avg_trans_per_month",
]

LABEL = f"status_{CLOSED_STATUS}"
MODEL_FEATURES = [
    "avg_monthly_spend",
    "avg_trans_per_month",
    "total_revolving_bal",
    "total_ct_chng_Q4_Q1",
    "transaction_amount",
    "contacts_count_12mo",
    "gender_M",
    "gender_F",
]
ENGINEERED_COLUMNS = [*MODEL_FEATURES, LABEL]


def dummy_names(domains: dict[str, list[str]], columns: list[str] | None = None) -> list[str]:
    """Names of the 0/1 columns, one per category, in domain order."""
    return [f"{c}_{v}" for c in (columns or domains) for v in domains[c]]


def feature_names(domains: dict[str, list[str]]) -> list[str]:
    """Numeric features followed by the 0/1 columns of everything but the status."""
    return NUMERIC_FEATURES + dummy_names(domains, [c for c in domains if c != "status"])

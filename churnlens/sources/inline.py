"""Small literal tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Feature importances published for the original data.
PUBLISHED_SCORES = {
    "customer_age": 0.04597577,
    "dependent_count": 0.0284699,
    "income": 0.02050902,
    "credit_limit": 0.030101,
    "total_relationship_count": 0.0637918,
    "contacts_count_12mo": 0.06646886,
    "total_revolving_bal": 0.11742444,
    "total_amt_chng_Q4_Q1": 0.0489881,
    "total_ct_chng_Q4_Q1": 0.14684352,
    "avg_monthly_spend": 0.04316612,
    "avg_utilization_ratio": 0.02250511,
    "transaction_amount": 0.09447194,
    "avg_trans_per_month": 0.15370751,
    "gender_F": 0.00947908,
    "gender_M": 0.00966512,
    "education_level_College": 0.00874415,
    "education_level_Doctorate": 0.00596669,
    "education_level_Graduate": 0.01251737,
    "education_level_High School": 0.01123932,
    "education_level_Post-Graduate": 0.00697098,
    "education_level_Uneducated": 0.01037281,
    "marital_status_Divorced": 0.00724174,
    "marital_status_Married": 0.0123886,
    "marital_status_Single": 0.01121777,
    "card_category_Blue": 0.00443716,
    "card_category_Gold": 0.00262531,
    "card_category_Platinum": 0.0009244,
    "card_category_Silver": 0.00378641,
}


def inline_table(spark: SparkSession, columns: dict[str, list], schema: str) -> DataFrame:
    """A table from lists, one per column, in the order of the schema."""
    return spark.createDataFrame(list(zip(*columns.values())), schema)


def published_scores(spark: SparkSession) -> DataFrame:
    """(variable, score), 28 rows."""
    return inline_table(
        spark,
        {"variable": list(PUBLISHED_SCORES), "score": list(PUBLISHED_SCORES.values())},
        "variable string, score double",
    )

"""The registered queries: each reads the test tables below ``sf_dir`` and returns a frame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import fixtures, schemas
from ..fixtures import FIXTURE_DOMAINS as DOMAINS, Tables
from ..functions import scalars
from ..operators import (
    evaluate,
    features as feat,
    gold,
    knn,
    kpi,
    models,
    projection as proj,
    quality,
    quantiles,
    runs,
    split,
    stats,
)
from ..session import col, new_work_path, quoted
from ..sources import csv, inline, landing, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FEATURES = schemas.feature_names(DOMAINS)
LABEL = schemas.LABEL
SUMMARY_COLUMNS = schemas.NUMERIC_FEATURES + schemas.dummy_names(DOMAINS)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return fixtures.load_tables(spark, sf_dir)


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.gold_accounts(tables(spark, sf_dir))


def weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.gold_weighted(tables(spark, sf_dir))


def staged(df: DataFrame, name: str) -> DataFrame:
    """A written stage, for what is read more than once."""
    return sinks.sink_stage_table(df, new_work_path(df.sparkSession, name))


def customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    return feat.customer_features(staged(gold.gold_accounts(t), "accounts"), t.transactions, DOMAINS)


def staged_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table as a written stage, for work that passes over it more than once."""
    path = new_work_path(spark, "features")
    return sinks.sink_stage_table(customer_features(spark, sf_dir), path)


def model_parts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Complete rows, split exactly, features standardised by the training part."""
    rows = feat.project_engineered(staged_features(spark, sf_dir), "customer_id").na.drop()
    marked = sinks.sink_stage_table(
        split.split_exact(rows, "customer_id"), new_work_path(spark, "parts")
    )
    return {p: marked.where(F.col("part") == p).drop("part") for p in ("train", "validate", "test")}


def scaled_parts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    parts = model_parts(spark, sf_dir)
    scaler = models.fit_scaler(parts["train"])
    return {name: models.zscore(part, scaler) for name, part in parts.items()}


def vectors(parts: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: models.features_target(part) for name, part in parts.items()}


def rounded(df: DataFrame, digits: int = 6, only: list[str] | None = None) -> DataFrame:
    """Fractional columns rounded, so that engines that add in another order agree."""
    return df.selectExpr(
        *[
            f"round({quoted(c)}, {digits}) as {quoted(c)}"
            if t == "double" and (only is None or c in only)
            else quoted(c)
            for c, t in df.dtypes
        ]
    )


# -- sources and sinks --------------------------------------------------------------------


@query
def scan_typed_csv(spark, sf_dir):
    path = new_work_path(spark, "typed")
    tables(spark, sf_dir).customer.write.csv(path)
    return csv.scan_typed_csv(spark, path, schemas.CUSTOMER)


@query
def scan_header_csv(spark, sf_dir):
    path = new_work_path(spark, "header")
    sinks.sink_csv(tables(spark, sf_dir).metrics, path)
    return csv.scan_header_csv(spark, path, schemas.CREDIT_METRICS)


@query
def scan_infer_csv(spark, sf_dir):
    path = new_work_path(spark, "infer")
    sinks.sink_csv(tables(spark, sf_dir).account, path)
    return csv.scan_infer_csv(spark, path)


@query
def scan_stage_table(spark, sf_dir):
    path = new_work_path(spark, "stage")
    tables(spark, sf_dir).metrics.write.parquet(path)
    return csv.scan_stage_table(spark, path)


@query
def scan_gzip_csv(spark, sf_dir):
    path = new_work_path(spark, "gzip")
    t = tables(spark, sf_dir).transactions
    sinks.sink_gzip_csv(t.select(F.monotonically_increasing_id().alias("_index"), "*"), path)
    return csv.scan_stage_csv(spark, path, schemas.TRANSACTIONS)


@query
def sink_csv(spark, sf_dir):
    path = new_work_path(spark, "csv")
    sinks.sink_csv(tables(spark, sf_dir).closed, path)
    return csv.scan_header_csv(spark, path, schemas.CLOSED_ACCOUNTS)


@query
def sink_gzip_csv(spark, sf_dir):
    path = new_work_path(spark, "gzip")
    sinks.sink_gzip_csv(feat.project_engineered(customer_features(spark, sf_dir), "customer_id"), path)
    schema = "customer_id string, " + ", ".join(
        f"`{c}` {'int' if c in (LABEL, 'gender_M', 'gender_F') else 'double'}"
        for c in schemas.ENGINEERED_COLUMNS
    )
    written = spark.read.schema(schema).option("header", True).csv(path)
    return rounded(written)


@query
def sink_stage_table(spark, sf_dir):
    return sinks.sink_stage_table(tables(spark, sf_dir).account, new_work_path(spark, "stage"))


@query
def land_raw(spark, sf_dir):
    t = tables(spark, sf_dir)
    base = new_work_path(spark, "raw")
    raw = {name: f"{base}/raw/{name}" for name in schemas.SOURCES}
    for name, path in raw.items():
        getattr(t, name).write.option("header", name == "metrics").csv(path)
    landed = landing.land_raw(spark, raw, f"{base}/landing")
    out = None
    for name in schemas.SOURCES:
        rows = rounded(getattr(landed, name)).select(F.lit(name).alias("table"), "*")
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


@query
def list_landing(spark, sf_dir):
    """Files of a landing folder: one of ids for each of three tables."""
    t = tables(spark, sf_dir)
    base = new_work_path(spark, "listed")
    for name, key in (("customer", "customer_id"), ("account", "account_id"), ("closed", "customer_id")):
        lines = getattr(t, name).select(F.coalesce(key, F.lit("")))
        lines.coalesce(1).write.text(f"{base}/{name}")
    files = landing.list_landing(spark, base, "*.txt")
    folder = F.substring_index("relative", "/", 1)
    return files.groupBy(folder.alias("folder")).agg(F.count("*").alias("files"), F.sum("length").alias("length"))


@query
def inline_table(spark, sf_dir):
    """The published scores beside the scores measured on the data."""
    measured = stats.anova_f(customer_features(spark, sf_dir), FEATURES, LABEL)
    return rounded(
        inline.published_scores(spark)
        .join(measured.withColumnRenamed("feature", "variable"), "variable", "left")
        .select("variable", "score", "f_score")
    , 6, ["f_score"])


@query
def preview(spark, sf_dir):
    return proj.head_n(tables(spark, sf_dir).account, 20, ["account_id"])


# -- projections, filters -----------------------------------------------------------------


@query
def project_engineered(spark, sf_dir):
    return rounded(feat.project_engineered(customer_features(spark, sf_dir), "customer_id"))


@query
def drop_columns(spark, sf_dir):
    keys = [c for c in schemas.KEY_COLUMNS if c != "customer_id"]
    return rounded(proj.drop_columns(customer_features(spark, sf_dir), keys))


@query
def drop_if_exists(spark, sf_dir):
    return proj.drop_columns(
        tables(spark, sf_dir).customer, ["income", "num_transactions"], strict=False
    )


@query
def rename(spark, sf_dir):
    monthly = _monthly(spark, sf_dir).groupBy("customer_id").agg(
        F.sum("num_transactions").alias("num_transactions")
    )
    return proj.rename(monthly, {"num_transactions": "total_transactions"})


@query
def insert_at(spark, sf_dir):
    """The spend at position 12 of the denormalised table."""
    return proj.insert_at(
        gold.build_gold(tables(spark, sf_dir)), 12, "avg_monthly_spend", scalars.monthly_spend()
    )


@query
def derive_monthly_spend(spark, sf_dir):
    return feat.add_monthly_spend(gold.build_gold(tables(spark, sf_dir))).select(
        "customer_id", "account_id", "transaction_id", "avg_monthly_spend"
    )


@query
def engineered_rows(spark, sf_dir):
    """Every row of the denormalised table with all features, worked out before the transactions fan out."""
    t = tables(spark, sf_dir)
    featured = feat.account_features(staged(gold.gold_accounts(t), "accounts"), t.transactions, DOMAINS)
    rows = gold.attach_transactions(staged(rounded(featured), "featured"), rounded(t.transactions))
    return proj.project(rows, feat.feature_columns(DOMAINS))


@query
def insert_at_accounts(spark, sf_dir):
    return proj.insert_at(
        accounts(spark, sf_dir).select("customer_id", "account_id", "avg_utilization_ratio", "credit_limit"),
        2,
        "avg_monthly_spend",
        scalars.monthly_spend(),
    )


@query
def derive_monthly_spend_accounts(spark, sf_dir):
    return feat.add_monthly_spend(accounts(spark, sf_dir)).select(
        "customer_id", "account_id", "avg_monthly_spend"
    )


def _filter_null_rows(column):
    def run(spark, sf_dir):
        return proj.filter_null_rows(tables(spark, sf_dir).customer, column, 10, ["customer_id"])

    return run


for _c in ("education_level", "marital_status", "income"):
    QUERIES[f"filter_null_rows_{_c}"] = _filter_null_rows(_c)


@query
def drop_null_rows(spark, sf_dir):
    return proj.drop_null_rows(tables(spark, sf_dir).metrics, ["total_relationship_count"])


@query
def trim_outliers(spark, sf_dir):
    kept = quantiles.trim_outliers(staged_features(spark, sf_dir), schemas.OUTLIER_QUANTILES)
    return kept.select("customer_id", *schemas.OUTLIER_QUANTILES)


@query
def select_existing(spark, sf_dir):
    engineered = feat.project_engineered(customer_features(spark, sf_dir))
    return proj.select_existing(engineered, ["customer_id", LABEL])


@query
def threshold_label(spark, sf_dir):
    return fixtures.predictions(spark, sf_dir).select(
        "row_id", scalars.threshold_label(F.col("score")).alias("predicted")
    )


@query
def axis_projection(spark, sf_dir):
    return rounded(proj.axis_projection(customer_features(spark, sf_dir)))


@query
def table_profile(spark, sf_dir):
    profile = quality.table_profile(weighted(spark, sf_dir), "gold_rows")
    return profile.withColumn("columns", F.lit(len(schemas.GOLD_COLUMNS)))


@query
def features_target(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    x = models.features_target(customer_features(spark, sf_dir))
    v = vector_to_array("features")
    return rounded(
        x.select(
            "customer_id",
            "label",
            *[v[i].alias(c) for i, c in enumerate(schemas.MODEL_FEATURES)],
        )
    )


# -- joins --------------------------------------------------------------------------------


@query
def join_customer_closed(spark, sf_dir):
    t = tables(spark, sf_dir)
    return gold.join_customer_closed(t.customer, t.closed)


@query
def join_accounts(spark, sf_dir):
    t = tables(spark, sf_dir)
    return gold.join_accounts(staged(join_customer_closed(spark, sf_dir), "join-1"), t.account)


@query
def join_metrics(spark, sf_dir):
    joined = staged(join_accounts(spark, sf_dir), "join-2")
    return gold.join_metrics(joined, tables(spark, sf_dir).metrics)


@query
def join_transactions(spark, sf_dir):
    joined = staged(join_metrics(spark, sf_dir), "join-3")
    return gold.join_transactions(joined, tables(spark, sf_dir).transactions)


@query
def build_gold(spark, sf_dir):
    return gold.build_gold(tables(spark, sf_dir))


@query
def build_gold_drop_null_keys(spark, sf_dir):
    return gold.build_gold(tables(spark, sf_dir), null_keys="drop")


@query
def gold_weighted(spark, sf_dir):
    return weighted(spark, sf_dir).select(
        "customer_id", "account_id", "gold_rows", "n_transaction_date"
    )


@query
def attach_customer_agg(spark, sf_dir):
    """Attached to every row of the denormalised table, as it is to the account grain under it."""
    t = tables(spark, sf_dir)
    owners = staged(gold.gold_accounts(t).select("customer_id", "account_id"), "accounts")
    average = feat.avg_txn_per_month(feat.monthly_txn_counts_by_account(owners, t.transactions))
    attached = staged(rounded(feat.attach_customer_agg(owners, average)), "attached")
    rows = gold.attach_transactions(attached, t.transactions.select("account_id", "transaction_id"))
    return proj.project(rows, ["customer_id", "account_id", "transaction_id", "avg_trans_per_month"])


@query
def attach_customer_agg_accounts(spark, sf_dir):
    """Attached at the account grain, before the transactions fan out."""
    t = tables(spark, sf_dir)
    owners = gold.gold_accounts(t)
    average = feat.avg_txn_per_month(feat.monthly_txn_counts_by_account(owners, t.transactions))
    rows = feat.attach_customer_agg(owners.select("customer_id", "account_id"), average)
    return rounded(rows)


# -- aggregations -------------------------------------------------------------------------


@query
def null_counts(spark, sf_dir):
    return quality.null_counts(tables(spark, sf_dir).customer)


@query
def null_counts_gold(spark, sf_dir):
    """Before the status is filled."""
    return quality.gold_null_counts(gold.gold_weighted(tables(spark, sf_dir), fill_status=False))


@query
def null_percent(spark, sf_dir):
    return rounded(quality.null_percent(tables(spark, sf_dir).customer))


@query
def value_counts(spark, sf_dir):
    return quality.value_counts(weighted(spark, sf_dir), "status", "gold_rows")


@query
def mode_value(spark, sf_dir):
    customer = tables(spark, sf_dir).customer
    return customer.sparkSession.range(1).select(
        quality.mode_value(customer, "marital_status").scalar().alias("marital_status"),
        quality.mode_value(customer, "education_level").scalar().alias("education_level"),
    )


@query
def median_value(spark, sf_dir):
    return rounded(quantiles.median_value(tables(spark, sf_dir).customer, "income"))


@query
def skew_profile(spark, sf_dir):
    t = tables(spark, sf_dir)
    owners = gold.gold_accounts(t)
    rows = gold.gold_weighted(t, owners)
    return rounded(stats.skew_profile(rows, schemas.SKEW_COLUMNS, "gold_rows", pilot=owners))


@query
def skew_profile_trimmed(spark, sf_dir):
    kept = quantiles.trim_outliers(staged_features(spark, sf_dir), schemas.OUTLIER_QUANTILES)
    return rounded(stats.skew_profile(kept, schemas.SKEW_COLUMNS))


def _monthly(spark, sf_dir):
    t = tables(spark, sf_dir)
    return feat.monthly_txn_counts_by_account(gold.gold_accounts(t), t.transactions)


@query
def monthly_txn_counts(spark, sf_dir):
    return _monthly(spark, sf_dir)


@query
def avg_txn_per_month(spark, sf_dir):
    return rounded(feat.avg_txn_per_month(_monthly(spark, sf_dir)))


@query
def quantile_caps(spark, sf_dir):
    caps = quantiles.quantile_caps(staged_features(spark, sf_dir), schemas.OUTLIER_QUANTILES)
    return rounded(caps)


@query
def mean_variance_summary(spark, sf_dir):
    summary = stats.mean_variance_summary(customer_features(spark, sf_dir), SUMMARY_COLUMNS)
    return _significant(summary, ["mean", "variance"])


@query
def mean_variance_wide(spark, sf_dir):
    wide = stats.mean_variance_wide(customer_features(spark, sf_dir), SUMMARY_COLUMNS)
    return _significant(wide, SUMMARY_COLUMNS)


def _significant(df, names):
    """Rounded to nine significant digits: variances of money have many before the point."""
    def digits(c):
        x = quoted(c)
        size = f"power(10D, floor(log10(abs({x}))))"
        return f"case when {x} <> 0 then round({x} / {size}, 8) when {x} = 0 then 0D end as {x}"

    return df.selectExpr(*[digits(c) if c in names else quoted(c) for c in df.columns])


@query
def kpi_means(spark, sf_dir):
    return rounded(kpi.kpi_means(weighted(spark, sf_dir), weight="gold_rows"), 4)


@query
def kpi_avg_credit_limit(spark, sf_dir):
    return rounded(kpi.kpi_avg_credit_limit(weighted(spark, sf_dir), "gold_rows"), 4)


@query
def kpi_total_customers(spark, sf_dir):
    return kpi.kpi_total_customers(accounts(spark, sf_dir))


@query
def kpi_avg_revolving_bal(spark, sf_dir):
    return rounded(kpi.kpi_avg_revolving_bal(weighted(spark, sf_dir), "gold_rows"), 4)


@query
def kpi_status_counts(spark, sf_dir):
    return kpi.kpi_status_counts(customer_features(spark, sf_dir))


@query
def kpi_total_transactions(spark, sf_dir):
    return kpi.kpi_total_transactions_weighted(weighted(spark, sf_dir))


@query
def crosstab(spark, sf_dir):
    return stats.crosstab(customer_features(spark, sf_dir), "contacts_count_12mo", LABEL)


@query
def chi_square(spark, sf_dir):
    return rounded(stats.chi_square(customer_features(spark, sf_dir), FEATURES, LABEL))


@query
def chi_square_expected(spark, sf_dir):
    categorical = schemas.dummy_names(DOMAINS, [c for c in DOMAINS if c != "status"])
    return rounded(
        stats.chi_square_expected(
            customer_features(spark, sf_dir), ["contacts_count_12mo", *categorical], LABEL
        )
    )


@query
def chi_square_test(spark, sf_dir):
    return rounded(stats.chi_square_test(customer_features(spark, sf_dir), FEATURES, LABEL))


@query
def chi_square_p_even(spark, sf_dir):
    """p-values of the features with an even number of degrees of freedom, up to 60."""
    tested = stats.chi_square_test(customer_features(spark, sf_dir), FEATURES, LABEL)
    few = tested.where("dof % 2 = 0 and dof between 2 and 60")
    return rounded(few.select("feature", "dof", "p_value"))


@query
def anova_f(spark, sf_dir):
    return rounded(stats.anova_f(customer_features(spark, sf_dir), FEATURES, LABEL))


@query
def low_variance(spark, sf_dir):
    return rounded(stats.low_variance(customer_features(spark, sf_dir), SUMMARY_COLUMNS))


@query
def high_variance(spark, sf_dir):
    high = stats.high_variance(customer_features(spark, sf_dir), SUMMARY_COLUMNS)
    return _significant(high, ["variance"])


@query
def first_row_per_customer(spark, sf_dir):
    t = tables(spark, sf_dir)
    return feat.first_row_by_account(gold.gold_accounts(t), t.transactions)


# -- sorts, limits, samples ---------------------------------------------------------------


@query
def sort_desc(spark, sf_dir):
    scores = stats.anova_f(customer_features(spark, sf_dir), FEATURES, LABEL)
    return proj.sort_desc(rounded(scores), "f_score", "feature")


@query
def drop_tail(spark, sf_dir):
    scores = stats.anova_f(customer_features(spark, sf_dir), FEATURES, LABEL)
    return proj.drop_tail(rounded(scores), "f_score", 8, "feature")


@query
def select_k_best(spark, sf_dir):
    best = stats.select_k_best_values(
        staged_features(spark, sf_dir), "customer_id", FEATURES, LABEL, 4
    )
    return rounded(best)


@query
def head_n(spark, sf_dir):
    clean = quality.clean_customers(tables(spark, sf_dir).customer)
    return rounded(proj.head_n(clean, 30, ["customer_id"]))


@query
def sample_n(spark, sf_dir):
    return split.sample_n(tables(spark, sf_dir).customer, "customer_id", 10)


@query
def shuffle(spark, sf_dir):
    shuffled = split.shuffle(tables(spark, sf_dir).customer, "customer_id")
    return shuffled.withColumn("position", scalars.hash_order(F.col("customer_id")))


# -- scalar functions ---------------------------------------------------------------------


@query
def parse_date(spark, sf_dir):
    text = tables(spark, sf_dir).transactions.select(
        "transaction_id", F.col("transaction_date").cast("string").alias("text")
    )
    return text.withColumn("parsed", scalars.parse_date(F.col("text")))


@query
def date_parts(spark, sf_dir):
    month, year = scalars.date_parts(F.col("transaction_date"))
    return tables(spark, sf_dir).transactions.select(
        "transaction_id", month.alias("month"), year.alias("year")
    )


@query
def fill_constant(spark, sf_dir):
    joined = join_customer_closed(spark, sf_dir)
    return proj.fill_constant(joined, "status", schemas.OPEN_STATUS).select("customer_id", "status")


@query
def impute_mode(spark, sf_dir):
    customer = quality.impute_mode(tables(spark, sf_dir).customer, "marital_status")
    return quality.impute_mode(customer, "education_level")


@query
def impute_median(spark, sf_dir):
    return rounded(quality.impute_median(tables(spark, sf_dir).customer, "income"))


@query
def one_hot(spark, sf_dir):
    """Of every row of the denormalised table."""
    names = ["customer_id", "account_id", "transaction_id", *DOMAINS]
    return feat.one_hot(gold.build_gold(tables(spark, sf_dir)).select(names), DOMAINS)


@query
def one_hot_accounts(spark, sf_dir):
    names = ["customer_id", "account_id", *DOMAINS]
    return feat.one_hot(accounts(spark, sf_dir).select(names), DOMAINS)


@query
def zscore(spark, sf_dir):
    parts = scaled_parts(spark, sf_dir)
    return rounded(parts["train"].unionByName(parts["validate"]).unionByName(parts["test"]))


@query
def user_prefix(spark, sf_dir):
    address = F.concat(
        F.replace(F.lower("c_name"), F.lit("#"), F.lit(".")), F.lit("@example.com")
    )
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return customer.select("c_custkey", scalars.user_prefix(address).alias("prefix"))


@query
def bool_label(spark, sf_dir):
    score = F.col("score")
    return fixtures.predictions(spark, sf_dir).select(
        "row_id", scalars.bool_label(score > 0.5).alias("label")
    )


# -- models and evaluation ----------------------------------------------------------------


@query
def split_70_15_15(spark, sf_dir):
    return split.split_exact(tables(spark, sf_dir).customer, "customer_id").select(
        "customer_id", "part"
    )


@query
def split_by_hash(spark, sf_dir):
    return split.split_by_hash(tables(spark, sf_dir).customer, "customer_id").select(
        "customer_id", "part"
    )


@query
def logistic_regression(spark, sf_dir):
    parts = vectors(scaled_parts(spark, sf_dir))
    return models.batch_score(models.logistic_regression(parts["train"]), parts["test"])


@query
def logistic_moments(spark, sf_dir):
    """Sums that equal those of the labels where the fitted weights are the optimum."""
    train = vectors(scaled_parts(spark, sf_dir))["train"]
    return rounded(models.logistic_regression(train).moments(train, schemas.MODEL_FEATURES), 5)


@query
def gbt_classifier(spark, sf_dir):
    parts = vectors(scaled_parts(spark, sf_dir))
    return models.batch_score(models.gbt_classifier(parts["train"]), parts["test"])


@query
def gbt_losses(spark, sf_dir):
    parts = vectors(scaled_parts(spark, sf_dir))
    return models.gbt_losses(models.gbt_classifier(parts["train"]), {p: parts[p] for p in ("train", "validate")})


@query
def knn_classify(spark, sf_dir):
    vecs = spark.read.parquet(f"{sf_dir}/embeddings.parquet").withColumn(
        "vector", F.col("embedding").cast("array<double>")
    )
    is_query = F.col("vec_id") % 10 == 0
    return knn.knn_classify(vecs.where(~is_query), vecs.where(is_query), "vec_id", "vector", "label", 5)


@query
def knn_customers(spark, sf_dir):
    """The 265 nearest training customers in the space of standardised features."""
    vector = F.array(*[col(c) for c in schemas.MODEL_FEATURES]).alias("vector")
    parts = {
        name: part.select("customer_id", vector, col(LABEL).alias("label"))
        for name, part in scaled_parts(spark, sf_dir).items()
    }
    return knn.knn_classify(
        parts["train"], parts["test"], "customer_id", "vector", "label", models.KNN_NEIGHBOURS
    )


@query
def linear_svm(spark, sf_dir):
    parts = vectors(scaled_parts(spark, sf_dir))
    return models.batch_score(models.linear_svm(parts["train"]), parts["test"])


@query
def random_forest(spark, sf_dir):
    parts = vectors(model_parts(spark, sf_dir))
    return models.batch_score(models.random_forest(parts["train"]), parts["test"])


@query
def majority_baseline(spark, sf_dir):
    parts = model_parts(spark, sf_dir)
    return models.majority_baseline(parts["train"], parts["test"])


@query
def grid_search(spark, sf_dir):
    return models.grid_search(vectors(model_parts(spark, sf_dir))["train"]).scores


@query
def batch_score(spark, sf_dir):
    """Held-out rows scored by the best model of a search, saved and loaded."""
    parts = vectors(model_parts(spark, sf_dir))
    path = new_work_path(spark, "model")
    models.save_model(models.grid_search(parts["train"]).model, path, spark)
    return models.batch_score(models.TreeModel.load(spark, path), parts["validate"])


@query
def gaussian_nb(spark, sf_dir):
    parts = model_parts(spark, sf_dir)
    scored = models.predict_gaussian_nb(parts["test"], models.fit_gaussian_nb(parts["train"]))
    return rounded(scored)


@query
def gaussian_nb_mllib(spark, sf_dir):
    parts = vectors(model_parts(spark, sf_dir))
    return models.batch_score(models.gaussian_nb_mllib(parts["train"]), parts["test"])


@query
def feature_importance(spark, sf_dir):
    found = models.grid_search(vectors(model_parts(spark, sf_dir))["train"])
    return models.feature_importance(found.model, spark)


@query
def forest_regress_importance(spark, sf_dir):
    rows = staged_features(spark, sf_dir)
    return models.forest_regress_importance(rows, "customer_id", FEATURES)


@query
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion_matrix(fixtures.predictions(spark, sf_dir))


@query
def classification_report(spark, sf_dir):
    return rounded(evaluate.classification_report(fixtures.predictions(spark, sf_dir)))


@query
def binary_metrics(spark, sf_dir):
    return rounded(evaluate.binary_metrics(fixtures.predictions(spark, sf_dir)))


@query
def roc_auc_hard(spark, sf_dir):
    return rounded(evaluate.roc_auc_hard(fixtures.predictions(spark, sf_dir)))


@query
def roc_auc_score(spark, sf_dir):
    return rounded(evaluate.roc_auc_score(fixtures.predictions(spark, sf_dir)))


@query
def log_loss(spark, sf_dir):
    return rounded(evaluate.log_loss(fixtures.predictions(spark, sf_dir)))


def _three_models(spark, sf_dir):
    p = fixtures.predictions(spark, sf_dir)
    return models.stack_predictions(
        {
            "given": p,
            "score": p.withColumn("prediction", scalars.threshold_label(F.col("score"))),
            "majority": models.majority_baseline(p, p, "row_id", "label"),
        }
    )


@query
def compare_models(spark, sf_dir):
    return rounded(evaluate.compare_models(_three_models(spark, sf_dir)))


@query
def run_log(spark, sf_dir):
    log = runs.RunLog(spark, new_work_path(spark, "runs"))
    for name in ("given", "score", "majority"):
        scored = _three_models(spark, sf_dir).where(F.col("model") == name)
        run = log.start(name)
        run.log_params({"threshold": 0.5})
        run.log_metrics(evaluate.binary_metrics(scored))
    return log.entries().select(
        "run_name", "kind", "key", F.round(F.col("value").cast("double"), 6).alias("value")
    )


@query
def filter_run(spark, sf_dir):
    """The first ten entries of one run."""
    log = runs.RunLog(spark, new_work_path(spark, "runs"))
    started = {}
    for name in ("given", "score"):
        scored = _three_models(spark, sf_dir).where(F.col("model") == name)
        started[name] = log.start(name)
        started[name].log_params({"threshold": 0.5})
        started[name].log_metrics(evaluate.binary_metrics(scored))
    return log.filter_run(started["score"].run_id).select(
        "run_name", "kind", "key", F.round(F.col("value").cast("double"), 6).alias("value")
    )


@query
def run_search(spark, sf_dir):
    log = runs.RunLog(spark, new_work_path(spark, "runs"))
    for name in ("given", "score"):
        scored = _three_models(spark, sf_dir).where(F.col("model") == name)
        log.start(name).log_metrics(evaluate.binary_metrics(scored))
    wide = runs.runs_wide(log.search(kind="metric"), evaluate.METRICS).drop("run_id")
    return rounded(wide.withColumns({m: F.col(m).cast("double") for m in evaluate.METRICS}))

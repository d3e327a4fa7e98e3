"""The whole path: raw files, landing, clean tables, denormalised table, features, figures,
models. Stages are written once below one folder and read back; nothing is recomputed."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..fixtures import Tables
from ..operators import evaluate, features, gold, knn, kpi, models, quality, quantiles, runs, split
from ..schemas import DOMAINS, LABEL, MODEL_FEATURES, OUTLIER_QUANTILES
from ..session import col
from ..sources.landing import DEFAULT_HEADERS, land_raw
from ..sources.sinks import sink_gzip_csv, sink_stage_table


@dataclass(frozen=True)
class Stages:
    tables: Tables
    accounts: DataFrame
    weighted: DataFrame
    features: DataFrame
    engineered: DataFrame


def clean_stage(tables: Tables, folder: str) -> Tables:
    """Only the customer table changes; the others stay where they are."""
    customer = sink_stage_table(quality.clean_customers(tables.customer), f"{folder}/customer")
    return replace(tables, customer=customer)


def build_stages(
    spark: SparkSession,
    raw: dict[str, str],
    folder: str,
    headers: dict[str, bool] = DEFAULT_HEADERS,
    domains: dict[str, list[str]] | None = DOMAINS,
    write_gold: bool = False,
    trim: bool = False,
) -> Stages:
    """``domains=None`` takes the categories from the data. ``write_gold`` also writes the row
    per transaction; nothing downstream needs it. ``trim`` leaves outliers out of the model
    table."""
    tables = clean_stage(land_raw(spark, raw, f"{folder}/landing", headers), f"{folder}/clean")
    accounts = sink_stage_table(gold.gold_accounts(tables), f"{folder}/accounts")
    weighted = sink_stage_table(gold.gold_weighted(tables, accounts), f"{folder}/weighted")
    if write_gold:
        gold.build_gold(tables).write.mode("overwrite").parquet(f"{folder}/gold")
    if domains is None:
        domains = features.discover_domains(accounts, list(DOMAINS))
    rows = sink_stage_table(
        features.customer_features(accounts, tables.transactions, domains), f"{folder}/features"
    )
    chosen = quantiles.trim_outliers(rows, OUTLIER_QUANTILES) if trim else rows
    engineered = sink_stage_table(
        features.project_engineered(chosen, "customer_id"), f"{folder}/engineered"
    )
    return Stages(tables, accounts, weighted, rows, engineered)


def export_engineered(engineered: DataFrame, path: str) -> None:
    """The nine model columns as compressed CSV."""
    sink_gzip_csv(features.project_engineered(engineered), path)


def figures(stages: Stages) -> dict[str, DataFrame]:
    """The dashboard tables."""
    w = stages.weighted
    return {
        "means": kpi.kpi_means(w, weight="gold_rows"),
        "avg_credit_limit": kpi.kpi_avg_credit_limit(w, "gold_rows"),
        "total_customers": kpi.kpi_total_customers(stages.accounts),
        "avg_revolving_bal": kpi.kpi_avg_revolving_bal(w, "gold_rows"),
        "status_counts": kpi.kpi_status_counts(stages.features),
        "total_transactions": kpi.kpi_total_transactions_weighted(w),
    }


def _vector() -> Column:
    return F.array(*[col(c) for c in MODEL_FEATURES]).alias("vector")


def train_and_compare(
    engineered: DataFrame,
    folder: str,
    grid: dict[str, list] = models.FOREST_GRID,
    folds: int = models.GRID_FOLDS,
    neighbours: int = models.KNN_NEIGHBOURS,
    boosting: dict | None = None,
    forest: dict | None = None,
) -> DataFrame:
    """Fit every model on the training part, log it, and compare all on the test part; the
    tuned forest is scored on the validation part as well. One row per model, best first."""
    spark = engineered.sparkSession
    marked = sink_stage_table(
        split.split_exact(engineered.na.drop(), "customer_id"), f"{folder}/parts"
    )
    names = ("train", "validate", "test")
    parts = {p: marked.where(F.col("part") == p).drop("part") for p in names}
    scaler = models.fit_scaler(parts["train"])
    scaled = {p: models.zscore(d, scaler) for p, d in parts.items()}
    plain_x = {p: models.features_target(d) for p, d in parts.items()}
    scaled_x = {p: models.features_target(d) for p, d in scaled.items()}

    log = runs.RunLog(spark, f"{folder}/runs")
    scored: dict[str, DataFrame] = {}

    def record(name: str, predictions: DataFrame, params: dict, model=None) -> None:
        # Each prediction is made once; the metrics and the comparison read the written rows.
        stored = sink_stage_table(
            predictions.select("label", "prediction"), f"{folder}/predictions/{name}"
        )
        scored[name] = stored
        run = log.start(name)
        if params:
            run.log_params(params)
        run.log_metrics(evaluate.binary_metrics(stored))
        if model is not None:
            run.log_model(model)

    def fit(name: str, train, x: dict[str, DataFrame], params: dict, **settings) -> None:
        model = train(x["train"], **settings)
        record(name, models.batch_score(model, x["test"]), params, model)

    fit("logistic", models.logistic_regression, scaled_x, {"max_iter": models.LOGISTIC_MAX_ITER})
    boosting = boosting or {}
    fit("boosted", models.gbt_classifier, scaled_x, {**models.BOOSTING, **boosting}, **boosting)
    fit("svm", models.linear_svm, scaled_x, {})
    forest = forest or {}
    fit("forest", models.random_forest, plain_x, {**models.FOREST, **forest}, **forest)

    points = {
        p: d.select("customer_id", _vector(), col(LABEL).alias("label")) for p, d in scaled.items()
    }
    near = knn.knn_classify(
        points["train"], points["test"], "customer_id", "vector", "label", neighbours
    )
    truth = points["test"].select("customer_id", "label")
    record("knn", truth.join(near, "customer_id"), {"k": neighbours})
    bayes = models.fit_gaussian_nb(parts["train"])
    record("bayes", models.predict_gaussian_nb(parts["test"], bayes), {})
    record("majority", models.majority_baseline(parts["train"], parts["test"]), {})

    found = models.grid_search(plain_x["train"], grid=grid, folds=folds)
    best = {**found.best, "mean_cv_accuracy": found.best_score}
    record("tuned_forest", models.batch_score(found.model, plain_x["test"]), best, found.model)
    record("tuned_forest_validate", models.batch_score(found.model, plain_x["validate"]), best)
    return evaluate.compare_models(models.stack_predictions(scored))

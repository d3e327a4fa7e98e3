import pytest
from churnlens.operators import evaluate, models, runs, split
from churnlens.schemas import DOMAINS, ENGINEERED_COLUMNS, LABEL, MODEL_FEATURES
from churnlens.plans import flow
from pyspark.sql import functions as F


def noise(i):
    return (F.xxhash64(F.lit(i), "id") % 1000) / 1000.0


@pytest.fixture(scope="module")
def rows(spark):
    """600 customers whose label follows from two features, up to some noise."""
    df = spark.range(600).select("id", *[noise(i).alias(c) for i, c in enumerate(MODEL_FEATURES)])
    y = F.col("avg_monthly_spend") + F.col("total_revolving_bal") + 0.2 * noise(99) > 0.4
    label = y.cast("int").alias(LABEL)
    return df.select(F.col("id").cast("string").alias("customer_id"), *MODEL_FEATURES, label).cache()


@pytest.fixture(scope="module")
def parts(rows):
    marked = split.split_exact(rows, "customer_id").cache()
    return {p: marked.where(F.col("part") == p).drop("part") for p in ("train", "validate", "test")}


@pytest.fixture(scope="module")
def scaled(parts):
    scaler = models.fit_scaler(parts["train"])
    return {p: models.zscore(d, scaler) for p, d in parts.items()}


def vectors(d):
    return {p: models.features_target(x) for p, x in d.items()}


def accuracy(df):
    got = evaluate.binary_metrics(df).first()["accuracy"]
    assert 0 <= got <= 1
    return got


@pytest.fixture(scope="module")
def floor(parts):
    return accuracy(models.majority_baseline(parts["train"], parts["test"]))


def test_scaling_uses_training_rows_and_population_deviation(parts, scaled, spark):
    c = MODEL_FEATURES[0]
    got = scaled["train"].agg(F.avg(c), F.stddev_pop(c)).first()
    assert got[0] == pytest.approx(0, abs=1e-9) and got[1] == pytest.approx(1)
    off = scaled["test"].agg(F.avg(c)).first()[0]
    assert abs(off) > 1e-6
    flat = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert {r["x"] for r in models.zscore(flat, models.fit_scaler(flat, ["x"]), ["x"]).collect()} == {0.0}


def test_rows_with_missing_features_are_left_out(parts):
    broken = parts["test"].withColumn("gender_M", F.when(F.col("customer_id") < "3", F.col("gender_M")))
    assert models.features_target(broken).count() == broken.where("gender_M is not null").count()


@pytest.mark.parametrize(
    "train, use_scaled",
    [
        (models.logistic_regression, True),
        (models.linear_svm, True),
        (lambda t: models.gbt_classifier(t, rounds=5, depth=3, rate=0.3), True),
        (lambda t: models.random_forest(t, numTrees=10, maxDepth=5), False),
    ],
)
def test_models_beat_the_baseline(parts, scaled, floor, train, use_scaled):
    x = vectors(scaled if use_scaled else parts)
    scored = models.batch_score(train(x["train"]), x["test"])
    assert scored.columns == ["customer_id", "label", "prediction", "score"]
    assert accuracy(scored) > floor + 0.1


def test_gaussian_bayes_agrees_with_mllib(parts):
    mine = models.predict_gaussian_nb(parts["test"], models.fit_gaussian_nb(parts["train"]))
    x = vectors(parts)
    theirs = models.batch_score(models.gaussian_nb_mllib(x["train"]), x["test"])
    both = mine.join(theirs.select("customer_id", F.col("prediction").alias("other")), "customer_id")
    assert both.count() == 90 and both.where("prediction <> other").count() == 0


def test_run_log(spark, tmp_path, scaled):
    log = runs.RunLog(spark, str(tmp_path))
    x = vectors(scaled)
    model = models.logistic_regression(x["train"])
    first, second = log.start("one"), log.start("two")
    first.log_params({"k": 5})
    first.log_metrics(evaluate.binary_metrics(models.batch_score(model, x["test"])))
    second.log_params({"k": 7})
    first.log_model(model)
    assert log.filter_run(first.run_id).count() == 7
    assert log.search(run_name="two").first()["value"] == "7"
    wide = runs.runs_wide(log.entries(), ["k", "accuracy"]).orderBy("run_name").collect()
    assert [r["k"] for r in wide] == ["5", "7"] and wide[1]["accuracy"] is None


def test_logging_twice_leaves_one_set(spark, tmp_path):
    log = runs.RunLog(spark, str(tmp_path))
    metrics = spark.createDataFrame([(0.5, 0.25)], "accuracy double, `odd name` double")
    other = log.start("other")
    other.log_params({"k": 1})
    for attempt in range(2):
        run = log.start("one", "fixed-id")
        run.log_params({"k": 5})
        run.log_params({"more": attempt})
        run.log_params({})
        run.log_metrics(metrics)
    rows = sorted((r["run_name"], r["kind"], r["key"], r["value"]) for r in log.entries().collect())
    one = [("one", "metric", "accuracy", "0.5"), ("one", "metric", "odd name", "0.25"), ("one", "param", "k", "5"), ("one", "param", "more", "1")]
    assert rows == sorted([*one, ("other", "param", "k", "1")])
    run.log_params({"k": 6}, batch="later")
    assert log.search(run_id="fixed-id", key="k").count() == 2
    assert log.entries().columns == ["run_id", "run_name", "kind", "key", "value", "ts"]


def test_compare_all_models(rows, tmp_path):
    got = flow.train_and_compare(
        rows,
        str(tmp_path),
        grid={"trees": [5], "depth": [3, 5], "leaf": [1], "split": [2]},
        folds=2,
        neighbours=15,
        boosting={"rounds": 3},
        forest={"numTrees": 5},
    ).collect()
    assert len(got) == 9 and got[-1]["balanced_accuracy"] == 0.5
    assert [r["balanced_accuracy"] for r in got] == sorted((r["balanced_accuracy"] for r in got), reverse=True)
    log = runs.RunLog(rows.sparkSession, f"{tmp_path}/runs")
    assert log.search(key="accuracy").count() == 9


def test_whole_flow(spark, data_dir, tmp_path):
    from churnlens import fixtures, schemas
    from churnlens.sources import csv

    t = fixtures.load_tables(spark, data_dir)
    raw = {n: str(tmp_path / "raw" / n) for n in schemas.SOURCES}
    for n, path in raw.items():
        getattr(t, n).write.option("header", n == "metrics").csv(path)
    stages = flow.build_stages(spark, raw, str(tmp_path / "out"), domains=None, write_gold=True)
    assert spark.read.parquet(str(tmp_path / "out" / "gold")).count() == 4634
    assert stages.features.count() == stages.engineered.count() == 122
    assert stages.engineered.columns == ["customer_id", *ENGINEERED_COLUMNS]
    assert stages.tables.customer.where("income is null or marital_status is null").isEmpty()
    shown = {k: v.collect() for k, v in flow.figures(stages).items()}
    assert shown["total_customers"][0][0] == 122
    assert sum(r["customers"] for r in shown["status_counts"]) == 122
    flow.export_engineered(stages.engineered, str(tmp_path / "export"))
    back = csv.scan_infer_csv(spark, str(tmp_path / "export"))
    assert back.columns == ENGINEERED_COLUMNS and back.count() == 122
    assert list(DOMAINS) == list(fixtures.FIXTURE_DOMAINS)

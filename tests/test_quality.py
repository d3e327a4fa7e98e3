import math

import pytest
from churnlens.operators import projection, quality, quantiles


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.createDataFrame([(1.0,), (2.0,), (4.0,), (9.0,), (None,)], "x double")


def test_mode_takes_the_smallest_of_equals(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "k string")
    assert quality.mode_value(df, "k").first()[0] == "a"
    assert [r["k"] for r in quality.impute_mode(df, "k").orderBy("k").collect()] == list("aaabb")


def test_mode_of_nothing_imputes_nothing(spark):
    df = spark.createDataFrame([(None,), (None,)], "k string")
    assert quality.mode_value(df, "k").count() == 0
    assert [r[0] for r in quality.impute_mode(df, "k").collect()] == [None, None]


def test_quantiles_interpolate(numbers):
    got = quantiles.exact_quantiles(numbers, {"q": ("x", 0.98), "m": ("x", 0.5)}).first()
    assert got["q"] == pytest.approx(8.7) and got["m"] == 3.0


def test_median_imputation(numbers):
    assert sorted(r[0] for r in quality.impute_median(numbers, "x").collect()) == [1, 2, 3, 4, 9]


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (math.nan, None), (None, "b")], "x double, k string")
    assert {r["column"]: r["nulls"] for r in quality.null_counts(df).collect()} == {"x": 2, "k": 1}
    share = {r["column"]: r["null_percent"] for r in quality.null_percent(df).collect()}
    assert share["x"] == pytest.approx(200 / 3)
    assert projection.nan_to_null(df).where("x is null").count() == 2


def test_weighted_counts(spark):
    df = spark.createDataFrame([("a", None, 3), ("b", 1.0, 2), (None, None, 4)], "k string, x double, w long")
    assert {r["column"]: r["nulls"] for r in quality.null_counts(df, ["k", "x"], "w").collect()} == {"k": 4, "x": 7}
    assert [tuple(r) for r in quality.value_counts(df, "k", "w").collect()] == [("a", 3), ("b", 2)]


def test_trim_is_strict_and_rejects_missing(spark):
    df = spark.createDataFrame([(float(i), float(i)) for i in range(1, 11)] + [(None, 1.0)], "a double, b double")
    kept = quantiles.trim_outliers(df, {"a": 0.9, "b": 1.0})
    assert sorted(r["a"] for r in kept.collect()) == [float(i) for i in range(1, 10)]


@pytest.mark.parametrize("shape", ["uniform", "heavy", "copies"])
def test_bracketed_quantiles_are_exact(spark, shape):
    import numpy as np

    rng = np.random.default_rng(5)
    n = 30_001
    x = {
        "uniform": rng.uniform(0, 1, n),
        "heavy": rng.pareto(0.5, n),
        "copies": np.where(rng.uniform(0, 1, n) < 0.4, 7.0, rng.normal(7, 1, n)),
    }[shape]
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(5)
    for q in (0.0, 0.01, 0.5, 0.98, 0.99, 1.0):
        got = quantiles.exact_quantiles(df, {"q": ("x", q)}, accuracy=500).first()["q"]
        assert got == pytest.approx(float(np.quantile(x, q)), rel=1e-12)


def test_projection_helpers(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert projection.insert_at(df, 1, "d", F.lit(9)).columns == ["a", "d", "b", "c"]
    assert projection.insert_at(df, 0, "c", F.col("c")).columns == ["c", "a", "b"]
    with pytest.raises(ValueError):
        projection.insert_at(df, 7, "d", F.lit(9))
    assert projection.select_existing(df, ["c", "z"]).columns == ["c"]
    assert projection.drop_columns(df, ["a", "z"], strict=False).columns == ["b", "c"]
    with pytest.raises(ValueError):
        projection.drop_columns(df, ["z"])
    assert projection.rename(df, {"a": "x"}).columns == ["x", "b", "c"]
    assert projection.preview(df.union(df), 1).count() == 1

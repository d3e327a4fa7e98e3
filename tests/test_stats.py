import math

import pytest
from churnlens.operators import stats
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.createDataFrame([(1.0,), (2.0,), (4.0,), (9.0,), (None,)], "x double")


def test_skew_is_bias_corrected(numbers):
    assert stats.skew_profile(numbers, ["x"]).first()["skew"] == pytest.approx(1.3309377322)


def test_weighted_skew_equals_repeated_rows(spark):
    df = spark.createDataFrame([(1e6 + 1, 3), (1e6 + 2, 1), (1e6 + 9, 2), (None, 5)], "x double, w long")
    repeated = df.withColumn("i", F.explode(F.sequence(F.lit(1), "w")))
    plain = stats.skew_profile(repeated, ["x"]).first()["skew"]
    assert stats.skew_profile(df, ["x"], "w").first()["skew"] == pytest.approx(plain, rel=1e-9)


def test_too_few_values_have_no_skew(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    assert stats.skew_profile(df, ["x"]).first()["skew"] is None


def test_sample_and_population_variance(numbers):
    got = stats.mean_variance_summary(numbers).first()
    assert (got["mean"], got["variance"]) == (4.0, pytest.approx(12.6667, abs=1e-4))
    assert stats.variances(numbers).first()["variance"] == pytest.approx(9.5)
    wide = {r["statistic"]: r["x"] for r in stats.mean_variance_wide(numbers).collect()}
    assert wide == {"mean": 4.0, "variance": pytest.approx(38 / 3)}


def test_variance_threshold_is_strict(spark):
    df = spark.createDataFrame([(0.0, 5.0), (1.0, 5.0)], "a double, b double")
    assert {r["column"] for r in stats.low_variance(df, threshold=0.25).collect()} == {"a", "b"}
    assert [r["column"] for r in stats.high_variance(df, threshold=0.2).collect()] == ["a"]


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(1.0, 3.0, 5.0, 0), (2.0, 1.0, 5.0, 0), (3.0, 2.0, 5.0, 0), (8.0, 2.0, 5.0, 1), (9.0, None, 5.0, 1), (10.0, 3.0, 5.0, 1)]
    return spark.createDataFrame(rows, "a double, b double, flat double, y int")


def test_anova(labelled):
    got = {r["feature"]: r["f_score"] for r in stats.anova_f(labelled, ["a", "b", "flat"], "y").collect()}
    # a: means 2 and 9, within 2 + 2, between 6 * 3.5**2 = 73.5.
    assert got["a"] == pytest.approx(73.5 / (4 / 4))
    assert got["b"] == pytest.approx((1.2 * 0.5**2) / (2.5 / 3))
    assert got["flat"] is None
    assert stats.select_k_best(labelled, ["flat", "b", "a"], "y", 2).columns == ["b", "a"]


def test_crosstab_and_expected(labelled):
    got = {r["value"]: (r["label_0"], r["label_1"]) for r in stats.crosstab(labelled, "b", "y").collect()}
    assert got == {1.0: (1, 0), 2.0: (1, 1), 3.0: (1, 1)}
    expected = stats.chi_square_expected(labelled, ["b"], "y").where("value = 2").first()
    assert (expected["expected_0"], expected["expected_1"]) == (pytest.approx(1.2), pytest.approx(0.8))


def test_chi_square_uses_yates_for_two_by_two(spark):
    cells = {(0, 0): 10, (0, 1): 20, (1, 0): 30, (1, 1): 5}
    rows = [(float(x), 1.0, y) for (x, y), n in cells.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "x double, one double, y int")
    got = {r["feature"]: r for r in stats.chi_square_test(df, ["x", "one"], "y").collect()}
    n, gap = 65, abs(10 * 5 - 20 * 30) - 65 / 2
    statistic = n * gap**2 / (30 * 35 * 40 * 25)
    assert got["x"]["statistic"] == pytest.approx(statistic) and got["x"]["dof"] == 1
    assert got["x"]["p_value"] == pytest.approx(math.erfc(math.sqrt(statistic / 2)))
    assert (got["one"]["statistic"], got["one"]["p_value"], got["one"]["dof"]) == (0.0, 1.0, 0)


def test_chi_square_agrees_with_mllib(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import ChiSquareTest

    rows = [(float(i * i % 7), float(i % 4), int(i * 37 % 11 < 4)) for i in range(500)]
    df = spark.createDataFrame(rows, "a double, b double, y int")
    mine = {r["feature"]: r for r in stats.chi_square_test(df, ["a", "b"], "y").collect()}
    vec = VectorAssembler(inputCols=["a", "b"], outputCol="v").transform(df)
    theirs = ChiSquareTest.test(vec, "v", "y").first()
    for i, c in enumerate(["a", "b"]):
        assert mine[c]["dof"] == theirs["degreesOfFreedom"][i]
        assert mine[c]["statistic"] == pytest.approx(theirs["statistics"][i])
        assert mine[c]["p_value"] == pytest.approx(theirs["pValues"][i], rel=1e-9)


def plain_tail(x, dof):
    """By the finite sums for whole and half arguments."""
    z, k = x / 2, dof // 2
    if dof % 2 == 0:
        return sum(math.exp(-z + j * math.log(z) - math.lgamma(j + 1)) for j in range(k))
    odd = (math.exp(-z + (j + 0.5) * math.log(z) - math.lgamma(j + 1.5)) for j in range(k))
    return math.erfc(math.sqrt(z)) + sum(odd)


def test_tail_probability(spark):
    from churnlens.functions.special import chi_square_tail

    known = [(x * dof, dof) for dof in (1, 2, 3, 7, 40, 61, 1001, 20_000) for x in (0.05, 0.5, 0.9, 1.0, 1.01, 1.3, 3.0)]
    known += [(1e-9, 1), (700.0, 4), (3.841458820694124, 1)]
    rows = [(float(x), k) for x, k in known] + [(0.0, 3), (-1.0, 3), (5.0, 0), (None, 3), (5.0, None), (1e6, 1_000_000)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, x double, dof long")
    got = [r["p"] for r in df.select("i", chi_square_tail(F.col("x"), F.col("dof")).alias("p")).orderBy("i").collect()]
    for (x, k), p in zip(known, got):
        assert p == pytest.approx(plain_tail(x, k), rel=1e-7, abs=1e-11), (x, k)
    assert got[len(known) : -1] == [1.0, 1.0, 1.0, None, None]
    assert got[-1] == pytest.approx(0.5, abs=1e-3)

import pytest
from churnlens.operators.joins import HotKey, SkewPolicy, exact_hot_keys, heavy_keys, hot_of, outer_join, parts_of
from pyspark.sql import functions as F

TINY = SkewPolicy(rows_per_task=3, pairs_per_task=10)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_null_keys_match(spark):
    a = frame(spark, [("1", "x"), (None, "n")], "k string, a string")
    b = frame(spark, [(None, "m"), ("2", "y")], "k string, b string")
    assert rows(outer_join(a, b, "k")) == sorted(
        [("1", "x", None), ("2", None, "y"), (None, "n", "m")], key=str
    )


@pytest.fixture(scope="module")
def skewed(spark):
    left = [("hot", i) for i in range(20)] + [("left only", i) for i in range(9)]
    left += [(None, i) for i in range(7)] + [(str(i), i) for i in range(10)]
    right = [("hot", 100 + i) for i in range(15)] + [("right only", i) for i in range(8)]
    right += [(None, 200 + i) for i in range(6)] + [(str(i), i) for i in range(5, 15)]
    return (
        frame(spark, left, "k string, a int").repartition(3),
        frame(spark, right, "k string, b int").repartition(3),
    )


@pytest.mark.parametrize("how", ["full", "left"])
def test_salted_join_equals_plain_join(skewed, how):
    left, right = skewed
    hot = exact_hot_keys(left, right, "k", TINY)
    assert {h.value for h in hot} >= {"hot", "left only", "right only", None}
    assert rows(outer_join(left, right, "k", how, hot, TINY)) == rows(
        outer_join(left, right, "k", how, [])
    )


def test_left_join_needs_no_left_counts(skewed):
    left, right = skewed
    hot = hot_of({}, heavy_keys([("r", right, "k")], TINY)["r"].counts, TINY)
    assert rows(outer_join(left, right, "k", "left", hot, TINY)) == rows(
        outer_join(left, right, "k", "left", [])
    )


def test_grid_keeps_both_sides_bounded():
    p = SkewPolicy(rows_per_task=100, pairs_per_task=1_000)
    for left, right in [(1_000, 1), (50, 50), (10_000, 10_000), (3, 1_000_000), (0, 500)]:
        s, t = HotKey("k", left, right).grid(p)
        assert left / s <= 100 and right / t <= 100
        assert left * right / (s * t) <= 1_000


def test_plain_equality(spark):
    a = frame(spark, [("1", "x"), (None, "n")], "k string, a string")
    b = frame(spark, [(None, "m"), ("1", "y")], "k string, b string")
    got = rows(outer_join(a, b, "k", "left", [], null_safe=False))
    assert got == sorted([("1", "x", "y"), (None, "n", None)], key=str)


def test_grid_makes_few_copies():
    p = SkewPolicy()
    for rows in (36_000, 216_000):
        s, t = HotKey(None, rows, rows).grid(p)
        # Left rows are copied t times, right rows s times.
        assert rows * t + rows * s <= 3 * rows * rows / p.pairs_per_task**0.5


@pytest.mark.parametrize("how", ["full", "left"])
def test_dealt_join_equals_plain_join(skewed, how):
    left, right = skewed
    plain = rows(outer_join(left, right, "k", how, []))
    hot = exact_hot_keys(left, right, "k", TINY)
    for keys in ([], hot):
        assert rows(outer_join(left, right, "k", how, keys, TINY, parts=11)) == plain
    dealt = outer_join(left, right, "k", how, [], hint="merge", parts=11)
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    # Dealt as the join needs it, hence shuffled once, over a number of parts that the caller sets.
    assert plan.count("isnull(k") >= 1 and plan.count(", 11), REPARTITION_BY_NUM") == 2
    assert "ENSURE_REQUIREMENTS" not in plan


def test_parts_grow_with_the_rows():
    p = SkewPolicy(rows_per_part=10)
    assert parts_of(50, p) is None and parts_of(100, p) == 10 and parts_of(1_000, p) == 100


def test_pairs_of_a_hot_key_leave_a_full_join_as_they_are_formed(spark):
    key = F.when(F.col("id") >= 350, F.col("id").cast("string"))
    left = spark.range(400).select(key.alias("k"), F.col("id").alias("a"))
    right = spark.range(500).select(key.alias("k"), F.col("id").alias("b"))
    joined = outer_join(left, right, "k")
    # Spark's full outer join would hold the 122,500 pairs of NULL at once.
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "Join FullOuter" in plan
    assert rows(joined) == rows(outer_join(left, right, "k", "full", []))
    assert joined.count() == 350 * 350 + 50 + 100

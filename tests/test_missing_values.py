"""NULL, NaN, constant and one-class inputs, each with the result stated by the definition."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from churnlens.functions import scalars
from churnlens.operators import evaluate, joins, knn, models, projection, quality, quantiles, split, stats
from churnlens.session import _own_dir
from churnlens.sources import csv
from pyspark.sql.types import DoubleType, StructField, StructType

NAN = float("nan")


@pytest.mark.parametrize("how,null_safe,rows", [("left", False, 7), ("full", False, 13), ("full", True, 37)])
def test_hot_null_keys_lose_no_rows(spark, how, null_safe, rows):
    keys = [None] * 6 + ["x"]
    left = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, a int")
    right = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, b int")
    policy = joins.SkewPolicy(rows_per_task=3, pairs_per_task=5)
    assert joins.outer_join(left, right, "k", how, policy=policy, null_safe=null_safe).count() == rows


def test_no_hot_key_is_cut_off(spark):
    """3,000 keys above the limit are all named, and their tasks stay bounded."""
    side = spark.range(30_000).select((F.col("id") % 3_000).cast("string").alias("k"), "id")
    policy = joins.SkewPolicy(rows_per_task=5, pairs_per_task=50)
    hot = joins.exact_hot_keys(side, side.withColumnRenamed("id", "b"), "k", policy)
    assert len(hot) == 3_000 and all(k.left_rows == 10 for k in hot)
    assert all(math.prod(k.grid(policy)) * policy.pairs_per_task >= 100 for k in hot)


def test_log_loss_and_threshold(spark):
    df = spark.createDataFrame([(1, 0.9), (1, None), (0, NAN), (None, 0.5)], "label int, score double")
    assert evaluate.log_loss(df).first()[0] == pytest.approx(-math.log(0.9))
    assert [r[0] for r in df.select(scalars.threshold_label(F.col("score"))).collect()] == [1, 0, 0, 0]


def test_constant_column_has_no_skew(spark):
    df = spark.createDataFrame([(0.1, 1), (0.1, 2), (0.1, 1), (None, 3)], "v double, w int")
    assert stats.skew_profile(df, ["v"]).first()["skew"] == 0.0
    assert stats.skew_profile(df, ["v"], weight="w").first()["skew"] == 0.0


def test_drop_tail_counts_what_is_there(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", None)], "f string, s double")
    assert [r["f"] for r in projection.drop_tail(df, "s", 1, "f").collect()] == ["b", "a"]
    assert [r["f"] for r in projection.drop_tail(df, "s", 2, "f").collect()] == ["b"]


def test_split_keeps_rows_of_a_key_together(spark):
    df = spark.createDataFrame([(str(i),) for i in range(10)] + [(None,)] * 4, "k string")
    parts = split.split_exact(df, "k").groupBy("part").agg(F.count("*").alias("n"), F.count("k").alias("k")).collect()
    assert sum(r["n"] for r in parts) == 14 and sum(r["n"] - r["k"] in (0, 4) for r in parts) == len(parts)
    assert {r["part"]: r["n"] for r in parts}["train"] == 9


def test_nan_is_missing(spark, tmp_path):
    df = spark.createDataFrame([(1.0,), (NAN,), (3.0,), (None,)], "v double")
    assert [r["v"] for r in quality.impute_median(df, "v").collect()] == [1.0, 2.0, 3.0, 2.0]
    (tmp_path / "x.csv").write_text("NaN\n5.5\n")
    read = csv.scan_typed_csv(spark, str(tmp_path / "x.csv"), StructType([StructField("v", DoubleType())]))
    assert sorted((r["v"] for r in read.collect()), key=str) == [5.5, None]


@pytest.mark.parametrize("label,prediction", [(1, 1), (0, 0)])
def test_bayes_on_one_class(spark, label, prediction):
    train = spark.createDataFrame([("a", 1.0, label), ("b", 2.0, label)], "customer_id string, x double, y int")
    rows = train.union(spark.createDataFrame([("c", None, label)], train.schema))
    scored = models.predict_gaussian_nb(rows, models.fit_gaussian_nb(train, ["x"], "y"), features=["x"], label="y")
    assert [(r["customer_id"], r["prediction"], math.isinf(r["score"])) for r in scored.collect()] == [
        ("a", prediction, True), ("b", prediction, True),
    ]


def test_knn_leaves_out_unusable_vectors(spark):
    rows = [("a", [0.0, 0.0], 1), ("b", [NAN, 0.0], 0), ("c", None, 0), ("d", [5.0, 5.0], 2), ("e", [0.0, None], 0)]
    train = spark.createDataFrame(rows, "id string, v array<double>, y int")
    got = knn.knn_classify(train, train, "id", "v", "y", 1).collect()
    assert {r["id"]: r["prediction"] for r in got} == {"a": 1, "d": 2}


def test_knn_search_keeps_k_rows_per_query_and_task():
    import pyarrow as pa

    rng = np.random.default_rng(1)
    q, blocks = rng.normal(size=(5, 3)), rng.normal(size=(4, 50, 3))
    batch = pa.RecordBatch.from_pydict(
        {
            "ids": [[10, 11, 12, 13, 14]] * 4,
            "vecs": [q.ravel().tolist()] * 4,
            "t_ids": [list(range(50 * i, 50 * i + 50)) for i in range(4)],
            "t_labels": pa.array([[0] * 50] * 4, pa.list_(pa.int32())),
            "t_vecs": [b.ravel().tolist() for b in blocks],
        }
    )
    rows = pa.Table.from_batches(list(knn._search([batch], 7, 3)))
    assert rows.num_rows == 5 * 7
    everything = blocks.reshape(-1, 3)
    for i in range(5):
        near = np.argsort(((everything - q[i]) ** 2).sum(axis=1))[:7]
        mine = [n for n, x in zip(rows["neighbour"].to_pylist(), rows["query"].to_pylist()) if x == 10 + i]
        assert mine == near.tolist()


@pytest.mark.parametrize("accuracy", [50, 500, 100_000])
def test_quantiles_with_narrowed_brackets(spark, accuracy):
    x = np.random.default_rng(0).lognormal(size=20_000)
    df = spark.createDataFrame(pd.DataFrame({"a": x, "b": np.round(x, 1)}))
    wanted = {"a1": ("a", 0.02), "a2": ("a", 0.5), "a3": ("a", 0.98), "b1": ("b", 0.5), "b2": ("b", 0.99)}
    got = quantiles.exact_quantiles(df, wanted, accuracy).first()
    for name, (c, q) in wanted.items():
        assert got[name] == pytest.approx(np.quantile(x if c == "a" else np.round(x, 1), q), rel=1e-12)


def test_shared_folder_must_be_named_on_a_cluster():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            _own_dir(master, "app")
    assert _own_dir("local[4]", "app-1") == _own_dir("local[4]", "app-1") != _own_dir("local[4]", "app-2")


def test_chi_square_expands_once(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 0.0, 1), (0.0, 1.0, 0), (1.0, 1.0, 1)], "a double, b double, y int")
    plan = stats.chi_square(df, ["a", "b"], "y")._jdf.queryExecution().toString()
    assert "Expand" not in plan  # done once, when the cells were written

import math
import random

import pytest
from churnlens.operators import evaluate


@pytest.fixture(scope="module")
def scored(spark):
    # tn 3, fp 1, fn 2, tp 4
    rows = [(0, 0)] * 3 + [(0, 1)] + [(1, 0)] * 2 + [(1, 1)] * 4
    return spark.createDataFrame([(y, p, (y + p) / 2 * 0.8 + 0.1) for y, p in rows], "label int, prediction int, score double")


def test_confusion(scored):
    got = {r["label"]: (r["predicted_0"], r["predicted_1"]) for r in evaluate.confusion_matrix(scored).collect()}
    assert got == {0: (3, 1), 1: (2, 4)}


def test_metrics(scored):
    m = evaluate.binary_metrics(scored).first()
    assert m["accuracy"] == pytest.approx(0.7)
    assert m["precision"] == pytest.approx(0.8)
    assert m["recall"] == pytest.approx(4 / 6)
    assert m["f1"] == pytest.approx(8 / 11)
    assert m["balanced_accuracy"] == m["roc_auc_hard"] == pytest.approx((4 / 6 + 3 / 4) / 2)


def test_zero_denominators(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "label int, prediction int")
    m = evaluate.binary_metrics(df).first()
    assert (m["accuracy"], m["precision"], m["recall"], m["f1"]) == (1.0, 0.0, 0.0, 0.0)


def test_report(scored):
    rows = {r["class"]: r for r in evaluate.classification_report(scored).collect()}
    assert rows["0"]["precision"] == pytest.approx(3 / 5) and rows["0"]["support"] == 4
    assert rows["macro avg"]["recall"] == pytest.approx((3 / 4 + 4 / 6) / 2)
    assert rows["weighted avg"]["recall"] == pytest.approx(rows["accuracy"]["recall"]) == pytest.approx(0.7)


def test_auc_counts_ties_half(scored):
    # scores: label 0 -> 3 x .1, 1 x .5; label 1 -> 2 x .5, 4 x .9
    want = (3 * 6 + (0.5 * 2 + 4)) / 24
    assert evaluate.roc_auc_score(scored).first()["roc_auc"] == pytest.approx(want)


def test_auc_of_hard_predictions(scored):
    hard = evaluate.roc_auc_score(scored, score="prediction").first()["roc_auc"]
    assert hard == pytest.approx(evaluate.roc_auc_hard(scored).first()["roc_auc_hard"])


@pytest.mark.parametrize("ranges", [2, 8, 1024])
def test_auc_equals_all_pairs(spark, ranges):
    rng = random.Random(ranges)
    rows = [(rng.randint(0, 1), rng.choice([rng.random() * 1e-6, rng.randint(0, 9) / 3, -rng.random() * 1e9, 0.0, -0.0])) for _ in range(400)]
    odd = [(None, 1.0), (1, None), (0, float("nan"))]
    df = spark.createDataFrame(rows + odd, "label int, score double").repartition(7)
    pos, neg = ([s for y, s in rows if y == k] for k in (1, 0))
    want = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    assert evaluate.roc_auc_score(df, ranges=ranges).first()["roc_auc"] == pytest.approx(want)
    for some in (df.limit(0), df.where("label = 1")):
        assert evaluate.roc_auc_score(some, ranges=ranges).first()["roc_auc"] is None
    with pytest.raises(ValueError):
        evaluate.roc_auc_score(df, ranges=6)


def test_log_loss_clips(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 0.25)], "label int, score double")
    want = (-math.log(1e-15) - math.log(0.75)) / 2
    assert evaluate.log_loss(df).first()["log_loss"] == pytest.approx(want)

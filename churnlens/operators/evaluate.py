"""Evaluation of predictions held in a table with columns label, prediction and score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .quality import long_form

METRICS = ["accuracy", "precision", "recall", "f1", "balanced_accuracy", "roc_auc_hard"]


def _cells(label: str, prediction: str) -> list[Column]:
    return [
        F.count_if((F.col(label) == y) & (F.col(prediction) == p)).alias(name)
        for name, y, p in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))
    ]


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(0.0)


def _metric_columns() -> list[Column]:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    balanced = (_ratio(tp, tp + fn) + _ratio(tn, tn + fp)) / 2
    return [
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        balanced.alias("balanced_accuracy"),
        # The area under the curve of 0/1 predictions, which has one corner.
        balanced.alias("roc_auc_hard"),
    ]


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, predicted_0, predicted_1), a row for each label."""
    row = df.agg(*_cells(label, prediction))
    return long_form(
        row,
        [
            {"label": F.lit(0), "predicted_0": F.col("tn"), "predicted_1": F.col("fp")},
            {"label": F.lit(1), "predicted_0": F.col("fn"), "predicted_1": F.col("tp")},
        ],
    )


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """accuracy, precision, recall, f1, balanced_accuracy and roc_auc_hard in one row."""
    return df.agg(*_cells(label, prediction)).select(*_metric_columns())


def roc_auc_hard(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return binary_metrics(df, label, prediction).select("roc_auc_hard")


def compare_models(df: DataFrame, model: str = "model") -> DataFrame:
    """One row per model over stacked predictions, best first."""
    return (
        df.groupBy(model)
        .agg(*_cells("label", "prediction"))
        .select(model, *_metric_columns())
        .orderBy(F.desc("balanced_accuracy"), model)
    )


def classification_report(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """(class, precision, recall, f1, support): both classes, accuracy, macro and weighted
    averages."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def one(hit: Column, wrong: Column, missed: Column) -> dict[str, Column]:
        return {
            "precision": _ratio(hit, hit + wrong),
            "recall": _ratio(hit, hit + missed),
            "f1": _ratio(2 * hit, 2 * hit + wrong + missed),
            "support": hit + missed,
        }

    zero, one_ = one(tn, fn, fp), one(tp, fp, fn)
    total = zero["support"] + one_["support"]
    names = ("precision", "recall", "f1")
    accuracy = _ratio(tp + tn, total)
    macro = {m: (zero[m] + one_[m]) / 2 for m in names}
    weighted = {
        m: _ratio(zero[m] * zero["support"] + one_[m] * one_["support"], total) for m in names
    }
    rows = [
        {"class": F.lit("0"), **zero},
        {"class": F.lit("1"), **one_},
        {"class": F.lit("accuracy"), **{m: accuracy for m in names}, "support": total},
        {"class": F.lit("macro avg"), **macro, "support": total},
        {"class": F.lit("weighted avg"), **weighted, "support": total},
    ]
    return long_form(df.agg(*_cells(label, prediction)), rows)


def log_loss(
    df: DataFrame, label: str = "label", score: str = "score", epsilon: float = 1e-15
) -> DataFrame:
    """Mean negative log-likelihood of the rows that have both a label and a score."""
    y, s = F.col(label).cast("double"), F.col(score).cast("double")
    p = F.least(F.greatest(s, F.lit(epsilon)), F.lit(1 - epsilon))
    known = y.isNotNull() & ~F.isnan(y) & s.isNotNull() & ~F.isnan(s)
    return df.where(known).agg(F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss"))


def roc_auc_score(
    df: DataFrame, label: str = "label", score: str = "score", ranges: int = 1024
) -> DataFrame:
    """Area under the ROC curve, as a sum of ranks (ties count half), in one lazy plan.

    Rows are reduced to one per distinct score, and scores ranked inside ranges that a sketch
    of quantiles cuts, so that each holds about the same share of the rows; what lies below a range is a
    sum over at most ``ranges`` rows. Rows without a label or score are left out; NULL unless
    both labels are there.
    """
    if ranges < 2 or ranges & (ranges - 1):
        raise ValueError("the number of ranges must be a power of two")
    y, s = F.col(label).cast("double"), F.col(score).cast("double")
    # 0.0 and -0.0 are one score.
    known = df.where(y.isNotNull() & ~F.isnan(y) & s.isNotNull() & ~F.isnan(s)).select(y.alias("y"), (s + F.lit(0.0)).alias("s"))
    shares = [i / ranges for i in range(1, ranges)]
    cuts = known.agg(F.percentile_approx("s", shares, 10 * ranges)).scalar()
    # How many cuts lie below, by halving.
    steps = F.array(*[F.lit(ranges >> (k + 1)) for k in range(ranges.bit_length() - 1)])
    below = F.aggregate(
        steps, F.lit(0), lambda at, k: F.when(F.get("cuts", at + k - 1) < F.col("s"), at + k).otherwise(at)
    )
    counts = (
        known.withColumn("cuts", cuts)
        .select("y", "s", below.alias("range"))
        .groupBy("range", "s")
        .agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))
    )
    inside = Window.partitionBy("range").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    in_range = counts.withColumn("neg_below", F.coalesce(F.sum("neg").over(inside), F.lit(0))).groupBy("range").agg(
        F.sum("pos").alias("pos"),
        F.sum("neg").alias("neg"),
        F.sum(F.col("pos").cast("double") * (F.col("neg_below") + F.col("neg") / 2)).alias("won"),
    )
    # At most ``ranges`` rows.
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    won = F.col("won") + F.col("pos").cast("double") * F.coalesce(F.sum("neg").over(before), F.lit(0))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return in_range.select("pos", "neg", won.alias("won")).agg(F.try_divide(F.sum("won"), pairs).alias("roc_auc"))

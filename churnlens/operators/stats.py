"""Statistics of feature tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.special import chi_square_tail
from ..session import col, new_work_path, quoted
from ..sources.sinks import sink_stage_table


def _long(df: DataFrame, columns: list[str], keep: list[str] = []) -> DataFrame:
    """(keep..., column, x): a row per column. Grouped by column this is far cheaper to compile,
    and faster to run, than one aggregate for each of many columns; only one partial row per
    column and task is shuffled. ``keep`` is SQL text with an alias."""
    wide = df.selectExpr(*keep, *[f"cast({quoted(c)} as double) as {quoted(c)}" for c in columns])
    kept = [quoted(c) for c in wide.columns[: len(keep)]]
    return wide.unpivot(kept, [quoted(c) for c in columns], "column", "x")


def _bias_corrected(skew: Column, n: Column, constant: Column) -> Column:
    """NULL for fewer than three values, 0 for a constant column."""
    corrected = skew * F.sqrt(n * (n - 1.0)) / (n - 2.0)
    return F.when(n > 2, F.when(constant, 0.0).otherwise(corrected))


def skew_profile(
    df: DataFrame,
    columns: list[str],
    weight: str | None = None,
    pilot: DataFrame | None = None,
) -> DataFrame:
    """(column, skew), the bias-corrected sample skewness.

    With ``weight`` a row counts that often. Power sums are then taken around the plain means
    of ``pilot`` (any frame of about the same values; default the frame itself), which keeps
    them free of cancellation.
    """
    n = F.col("n")
    if weight is None:
        moments = (
            _long(df, columns)
            .groupBy("column")
            .agg(
                F.skewness("x").alias("skew"),
                F.count("x").cast("double").alias("n"),
                (F.min("x") == F.max("x")).alias("constant"),
            )
        )
        return moments.select("column", _bias_corrected(F.col("skew"), n, F.col("constant")).alias("skew"))

    shift = _long(df if pilot is None else pilot, columns).groupBy("column").agg(
        F.avg("x").alias("shift")
    )
    sums = (
        _long(df, columns, [f"cast({quoted(weight)} as double) as w"])
        # One row per column.
        .join(F.broadcast(shift), "column")
        .selectExpr("column", "if(x is null, 0D, w) as w", "x - shift as d", "if(w > 0, x, null) as x")
        .groupBy("column")
        .agg(
            F.sum("w").alias("n"),
            (F.min("x") == F.max("x")).alias("constant"),
            *[
                F.expr(f"try_divide(sum(w * {' * '.join(['d'] * p)}), sum(w))").alias(f"m{p}")
                for p in (1, 2, 3)
            ],
        )
    )
    central = sums.selectExpr(
        "column",
        "n",
        "constant",
        "m2 - m1 * m1 as c2",
        "m3 - 3 * m1 * m2 + 2 * m1 * m1 * m1 as c3",
    )
    skew = F.expr("if(c2 > 0, c3 / power(c2, 1.5), 0D)")
    return central.select("column", _bias_corrected(skew, n, F.col("constant")).alias("skew"))


def mean_variance_summary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, mean, variance) with the sample variance, in one pass."""
    return (
        _long(df, columns or df.columns)
        .groupBy("column")
        .agg(F.avg("x").alias("mean"), F.var_samp("x").alias("variance"))
    )


def mean_variance_wide(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The same as two rows, ``mean`` and ``variance``, with a column per feature."""
    columns = columns or df.columns
    return (
        mean_variance_summary(df, columns)
        .unpivot(["column"], ["mean", "variance"], "statistic", "x")
        .groupBy("statistic")
        .pivot("column", columns)
        .agg(F.max("x"))
    )


def variances(df: DataFrame, columns: list[str] | None = None, threshold: float = 0.1) -> DataFrame:
    """(column, variance, keep): the population variance, and whether it exceeds the threshold."""
    return (
        _long(df, columns or df.columns)
        .groupBy("column")
        .agg(F.var_pop("x").alias("variance"))
        .withColumn("keep", F.col("variance") > threshold)
    )


def low_variance(df: DataFrame, columns: list[str] | None = None, threshold: float = 0.1) -> DataFrame:
    return variances(df, columns, threshold).where(~F.col("keep")).drop("keep")


def high_variance(df: DataFrame, columns: list[str] | None = None, threshold: float = 0.1) -> DataFrame:
    return variances(df, columns, threshold).where("keep").drop("keep")


# -- features against a label -------------------------------------------------------------


def anova_f(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """(feature, f_score): variance between the classes over variance within.

    Rows are reduced to one per class; what follows has classes x features rows.
    """
    rows = (
        _long(df.where(col(label).isNotNull()), features, [f"{quoted(label)} as class"])
        .where(F.col("x").isNotNull())
        .groupBy(F.col("column").alias("feature"), "class")
        .agg(
            F.count("x").cast("double").alias("n"),
            F.avg("x").alias("mean"),
            F.var_pop("x").alias("var"),
        )
    )
    w = Window.partitionBy("feature")
    grand = F.sum(F.col("n") * F.col("mean")).over(w) / F.sum("n").over(w)
    sums = (
        rows.withColumn("grand", grand)
        .groupBy("feature")
        .agg(
            F.sum(F.col("n") * F.pow(F.col("mean") - F.col("grand"), 2)).alias("between"),
            F.sum(F.col("n") * F.col("var")).alias("within"),
            F.sum("n").alias("total"),
            F.count("*").cast("double").alias("k"),
        )
    )
    between = F.try_divide(F.col("between"), F.col("k") - 1)
    within = F.try_divide(F.col("within"), F.col("total") - F.col("k"))
    return sums.select("feature", F.try_divide(between, within).alias("f_score"))


def top_features(df: DataFrame, features: list[str], label: str, k: int = 4) -> DataFrame:
    """(feature, f_score) of the k best."""
    return anova_f(df, features, label).orderBy(F.desc_nulls_last("f_score"), "feature").limit(k)


def select_k_best(df: DataFrame, features: list[str], label: str, k: int = 4) -> DataFrame:
    """The k best feature columns. Column names are part of a plan, so k names are fetched."""
    best = {r["feature"] for r in top_features(df, features, label, k).collect()}
    return df.select(*[col(c) for c in features if c in best])


def select_k_best_values(
    df: DataFrame, key: str, features: list[str], label: str, k: int = 4
) -> DataFrame:
    """The same, lazily and in long form: (key, feature, value)."""
    long = _long(df, features, [quoted(key)]).withColumnsRenamed({"column": "feature", "x": "value"})
    # At most k rows.
    return long.join(F.broadcast(top_features(df, features, label, k)), "feature").drop("f_score")


def crosstab(df: DataFrame, column: str, label: str) -> DataFrame:
    """(value, label_0, label_1)."""
    return (
        df.where(col(column).isNotNull() & col(label).isNotNull())
        .groupBy(col(column).alias("value"))
        .agg(
            F.count_if(col(label) == 0).alias("label_0"),
            F.count_if(col(label) == 1).alias("label_1"),
        )
    )


def _contingency(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Per feature and value the counts of both labels, with the feature's totals.

    One grouping for all features, written as a stage: the totals and what follows read it, so
    the rows are expanded and grouped once. The totals have a row per feature, whatever the data.
    """
    cells = sink_stage_table(
        _long(df.where(col(label).isNotNull()), features, [f"{quoted(label)} as _label"])
        .where(F.col("x").isNotNull())
        .groupBy(F.col("column").alias("feature"), F.col("x").alias("value"))
        .agg(
            F.count_if(F.col("_label") == 0).alias("o0"),
            F.count_if(F.col("_label") == 1).alias("o1"),
        ),
        new_work_path(df.sparkSession, "contingency"),
    )
    totals = cells.groupBy("feature").agg(F.sum("o0").alias("t0"), F.sum("o1").alias("t1"))
    return cells.join(F.broadcast(totals), "feature")


def _expected(total: str) -> Column:
    row = F.col("o0") + F.col("o1")
    return row.cast("double") * F.col(total) / (F.col("t0") + F.col("t1"))


def chi_square_expected(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """(feature, value, observed_0, observed_1, expected_0, expected_1)."""
    return _contingency(df, features, label).select(
        "feature",
        "value",
        F.col("o0").alias("observed_0"),
        F.col("o1").alias("observed_1"),
        _expected("t0").alias("expected_0"),
        _expected("t1").alias("expected_1"),
    )


def chi_square(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """(feature, statistic, dof) against a 0/1 label; each distinct value is a category.

    With one degree of freedom each difference shrinks by up to a half (Yates).
    """
    def term(observed: str, expected: Column, yates: bool) -> Column:
        gap = F.abs(F.col(observed) - expected)
        if yates:
            gap = gap - F.least(F.lit(0.5), gap)
        return F.when(expected > 0, gap * gap / expected).otherwise(0.0)

    def terms(yates: bool) -> Column:
        return term("o0", _expected("t0"), yates) + term("o1", _expected("t1"), yates)

    labels = F.when(F.max("t0") > 0, 1).otherwise(0) + F.when(F.max("t1") > 0, 1).otherwise(0)
    summed = (
        _contingency(df, features, label)
        .groupBy("feature")
        .agg(
            F.sum(terms(False)).alias("plain"),
            F.sum(terms(True)).alias("corrected"),
            ((F.count("*") - 1) * (labels - 1)).cast("bigint").alias("dof"),
        )
    )
    statistic = F.when(F.col("dof") == 1, F.col("corrected")).otherwise(F.col("plain"))
    return summed.select(
        "feature", F.when(F.col("dof") > 0, statistic).otherwise(0.0).alias("statistic"), "dof"
    )


def chi_square_test(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """(feature, statistic, p_value, dof)."""
    p_value = chi_square_tail(F.col("statistic"), F.col("dof")).alias("p_value")
    return chi_square(df, features, label).select("feature", "statistic", p_value, "dof")

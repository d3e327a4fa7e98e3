"""Training, tuning and scoring of classifiers, with MLlib and with the trees of :mod:`.trees`.

A model table has a key, the features as columns and a 0/1 label. Scalings are learnt from
training rows only. Scored tables hold key, label, prediction and, where there is one, score.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark import StorageLevel
from pyspark.ml import Model
from pyspark.ml.classification import LinearSVC, NaiveBayes, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import LABEL, MODEL_FEATURES
from ..session import col, literal, quoted, with_row
from . import logistic, trees
from .logistic import LogisticModel
from .projection import missing_sql
from .quality import value_counts
from .trees import TreeModel

SEED = 42
OwnModel = TreeModel | LogisticModel

# Model settings.
LOGISTIC_MAX_ITER = 1000
BOOSTING = {"depth": 6, "rate": 0.1, "rounds": 200}
FOREST = {"numTrees": 100, "maxDepth": 10}
FOREST_GRID = {
    "depth": [10, 15, 20],
    "leaf": [1, 2, 4],
    "split": [2, 5, 10],
    "trees": [50, 100, 150],
}
GRID_FOLDS = 5
IMPORTANCE_TREES = 12
KNN_NEIGHBOURS = 265
VAR_SMOOTHING = 1e-9


# -- preparation --------------------------------------------------------------------------


def features_target(
    df: DataFrame,
    key: str = "customer_id",
    features: list[str] = MODEL_FEATURES,
    label: str = LABEL,
) -> DataFrame:
    """(key, label, features): the columns by name, as a vector and an integer label.
    Rows with a missing feature or label are left out."""
    rows = df.where(col(label).isNotNull()).select(
        col(key), col(label).cast("int").alias("label"), *[col(c).cast("double") for c in features]
    )
    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="skip")
    return assembler.transform(rows).select(key, "label", "features")


def fit_scaler(train: DataFrame, features: list[str] = MODEL_FEATURES) -> DataFrame:
    """Mean and population deviation of each feature, one row."""
    return train.selectExpr(
        *[
            f"named_struct('mean', avg({quoted(c)}), 'dev', stddev_pop({quoted(c)})) as {quoted(c)}"
            for c in features
        ]
    )


def zscore(df: DataFrame, scaler: DataFrame, features: list[str] = MODEL_FEATURES) -> DataFrame:
    """(x - mean) / deviation for every feature; a constant feature is only centred."""
    names = df.columns
    scaled = {
        c: f"({quoted(c)} - _s.{quoted(c)}.mean) / if(_s.{quoted(c)}.dev = 0, 1D, _s.{quoted(c)}.dev)"
        for c in features
    }
    return with_row(df, scaler, "_s").selectExpr(
        *[f"{scaled[c]} as {quoted(c)}" if c in scaled else quoted(c) for c in names]
    )


@contextmanager
def _kept(df: DataFrame):
    """Keep the rows of an iterative fit at hand; what is lost is computed again."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


# -- models -------------------------------------------------------------------------------


def logistic_regression(train: DataFrame, max_iter: int = LOGISTIC_MAX_ITER, c: float = 1.0) -> LogisticModel:
    """Ridge penalty with inverse strength ``c``, summed over rows as is usual elsewhere."""
    return logistic.fit(train, c, max_iter)


def gbt_classifier(train: DataFrame, **settings) -> TreeModel:
    """Second-order boosting, fitted on all rows."""
    return trees.boost(train, **{**BOOSTING, **settings})


def gbt_losses(model: TreeModel, parts: dict[str, DataFrame]) -> DataFrame:
    """(part, round, loss): logistic loss of each part after each boosting round."""
    return trees.boosting_losses(model, parts)


def linear_svm(train: DataFrame, c: float = 1.0, **settings) -> Model:
    with _kept(train):
        rows = max(train.count(), 1)
        return LinearSVC(regParam=1.0 / (c * rows), standardization=False, **settings).fit(train)


def random_forest(train: DataFrame, seed: int = SEED, **settings) -> Model:
    with _kept(train):
        return RandomForestClassifier(seed=seed, **{**FOREST, **settings}).fit(train)


def gaussian_nb_mllib(train: DataFrame) -> Model:
    with _kept(train):
        return NaiveBayes(modelType="gaussian").fit(train)


def batch_score(model: Model | OwnModel, df: DataFrame, key: str = "customer_id") -> DataFrame:
    """(key, label, prediction, score) of a held-out or new table."""
    if isinstance(model, OwnModel):
        return model.batch_score(df, key)
    scored = model.transform(df)
    source = "probability" if "probability" in scored.columns else "rawPrediction"
    return scored.select(
        key,
        "label",
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array(source)[1].alias("score"),
    )


def save_model(model: Model | OwnModel, path: str, spark: SparkSession | None = None) -> None:
    if isinstance(model, OwnModel):
        model.save(spark or SparkSession.active(), path)
    else:
        model.write().overwrite().save(path)


def _by_importance(spark: SparkSession, features: list[str], values) -> DataFrame:
    pairs = [(f, float(v)) for f, v in zip(features, values)]
    rows = spark.createDataFrame(pairs, "feature string, importance double")
    return rows.orderBy(F.desc("importance"), "feature")


def feature_importance(
    model: Model | TreeModel, spark: SparkSession, features: list[str] = MODEL_FEATURES
) -> DataFrame:
    """(feature, importance), most important first."""
    tree_model = isinstance(model, TreeModel)
    return _by_importance(spark, features, model.importances() if tree_model else model.featureImportances.toArray())


def forest_regress_importance(
    df: DataFrame,
    key: str,
    features: list[str],
    label: str = LABEL,
    trees_: int = IMPORTANCE_TREES,
    seed: int = SEED,
    local_rows: int = trees.LOCAL_ROWS,
) -> DataFrame:
    """(feature, importance), most important first, of extremely randomised trees that regress on
    the 0/1 label: each tree's gains in shares of the tree's, averaged. Rows with a missing
    feature or label are left out; a tree without a split counts nowhere."""
    rows = features_target(df, key, features, label)
    points = rows.select(vector_to_array("features").alias("x"), F.col("label").cast("double").alias("y"))
    gains = trees.extra_tree_gains(points, len(features), trees_, seed, local_rows)
    of_tree = gains.groupBy("tree").agg(F.sum("gain").alias("all"))
    shares = gains.join(of_tree, "tree").groupBy("feature").agg(F.sum(F.col("gain") / F.col("all")).alias("share"))
    names = ", ".join(f"named_struct('number', {i}, 'name', {literal(c)})" for i, c in enumerate(features))
    named = df.sparkSession.range(1).selectExpr(f"inline(array({names}))")
    whole = shares.agg(F.sum("share")).scalar()
    return (
        # One row per feature.
        named.join(F.broadcast(shares), F.col("number") == F.col("feature"), "left")
        .select(F.col("name").alias("feature"), F.coalesce(F.try_divide("share", whole), F.lit(0.0)).alias("importance"))
        .orderBy(F.desc("importance"), "feature")
    )


# -- models that are plain aggregates -----------------------------------------------------


def majority_baseline(
    train: DataFrame, df: DataFrame, key: str = "customer_id", label: str = LABEL
) -> DataFrame:
    """(key, label, prediction): everybody gets the most frequent training label."""
    most = value_counts(train, label).limit(1).select("value").scalar()
    return df.select(col(key), col(label).alias("label"), most.alias("prediction"))


def fit_gaussian_nb(
    train: DataFrame, features: list[str] = MODEL_FEATURES, label: str = LABEL
) -> DataFrame:
    """One row: per class the prior and each feature's mean and variance, the variances raised
    by a small share of the largest one."""
    y = quoted(label)

    def of_class(k: int) -> str:
        stats = [
            f"{literal(c)}, named_struct('mean', avg({quoted(c)}) filter (where {y} = {k}),"
            f" 'var', var_pop({quoted(c)}) filter (where {y} = {k}))"
            for c in features
        ]
        prior = f"'prior', try_divide(count_if({y} = {k}), count(*))"
        return f"named_struct({prior}, {', '.join(stats)}) as class_{k}"

    largest = ", ".join(f"var_pop({quoted(c)})" for c in features)
    # greatest needs two arguments.
    return train.selectExpr(
        of_class(0), of_class(1), f"greatest({largest}, 0D) * {VAR_SMOOTHING!r} as raised"
    )


def predict_gaussian_nb(
    df: DataFrame,
    fitted: DataFrame,
    key: str = "customer_id",
    features: list[str] = MODEL_FEATURES,
    label: str = LABEL,
) -> DataFrame:
    """(key, label, prediction, score), the score being the difference of log likelihoods: plus
    or minus infinity if training saw one class. Rows with a missing feature are left out."""

    def log_likelihood(k: int) -> str:
        # A class that training never saw has prior 0: likelihood minus infinity.
        out = f"if(_m.class_{k}.prior > 0, ln(_m.class_{k}.prior), double('-infinity'))"
        for c in features:
            of = f"_m.class_{k}.{quoted(c)}"
            var = f"({of}.var + _m.raised)"
            term = f"0.5D * ln(2D * pi() * {var}) + 0.5D * power({quoted(c)} - {of}.mean, 2) / {var}"
            out += f" - coalesce({term}, 0D)"
        return out

    missing = missing_sql(df, features)
    complete = df.where(" and ".join(f"not {missing[c]}" for c in features))
    scored = with_row(complete, fitted, "_m").selectExpr(
        quoted(key),
        f"{quoted(label)} as label",
        f"({log_likelihood(1)}) - ({log_likelihood(0)}) as score",
    )
    return scored.selectExpr(quoted(key), "label", "if(score > 0, 1, 0) as prediction", "score")


# -- tuning -------------------------------------------------------------------------------


@dataclass(frozen=True)
class GridResult:
    model: TreeModel
    best: dict[str, int]
    best_score: float
    scores: DataFrame


def grid_search(
    train: DataFrame,
    key: str = "customer_id",
    grid: dict[str, list] = FOREST_GRID,
    folds: int = GRID_FOLDS,
    seed: int = SEED,
    bag_rows: int | None = None,
) -> GridResult:
    """Cross-validated forests: every setting of depth, rows in a leaf, rows in a node that is
    split, and trees, scored by the mean accuracy over the folds; the best (of equals, the first
    in the order of the grid) is grown again without leaving out a fold.

    The table is binned once. Only the leaf size changes how a tree grows: lesser depths, larger
    nodes to split and fewer trees are read off the same trees. Folds and bags follow from a hash
    of the key, so they do not change when a task runs again. Every bag is drawn from all rows of its folds
    and as large as they are, unless ``bag_rows`` names an average size. All rows are scored, by the trees
    that did not see their fold.
    """
    spark = train.sparkSession
    bags = trees.Bags.of(train, key, folds, grid["trees"], seed, bag_rows)
    by_setting: dict[int, list[float]] = {}
    for r in bags.hits(grid).collect():
        by_setting.setdefault(r["setting"], []).append(r["hits"] / r["rows"])
    settings = list(product(*(grid[k] for k in ("depth", "leaf", "split", "trees"))))
    scores = [sum(sorted(by_setting[i])) / len(by_setting[i]) for i in range(len(settings))]
    best = max(range(len(settings)), key=lambda i: (scores[i], -i))
    depth, leaf, split, number = settings[best]
    model = bags.model(number, leaf, depth, split)
    rows = spark.createDataFrame(
        [(*s, x) for s, x in zip(settings, scores)], "depth int, leaf int, split int, trees int, accuracy double"
    )
    return GridResult(model, dict(zip(("depth", "leaf", "split", "trees"), settings[best])), scores[best], rows)


def stack_predictions(scored: dict[str, DataFrame]) -> DataFrame:
    """(model, label, prediction) over several models' scored tables."""
    return reduce(
        DataFrame.unionByName,
        [d.select(F.lit(m).alias("model"), "label", "prediction") for m, d in scored.items()],
    )

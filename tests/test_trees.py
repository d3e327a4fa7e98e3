"""Trees against plain builders: one node at a time, every cut tried by a comparison of all rows."""

import hashlib
import itertools
import math

import numpy as np
import pytest
from churnlens.operators import evaluate, models, trees
from churnlens.schemas import LABEL, MODEL_FEATURES
from pyspark.sql import functions as F


def noise(i):
    return (F.xxhash64(F.lit(i), "id") % 1000) / 1000.0


@pytest.fixture(scope="module")
def rows(spark):
    """400 customers; two features are complements of each other, one is constant."""
    df = spark.range(400).select("id", *[noise(i).alias(c) for i, c in enumerate(MODEL_FEATURES)])
    df = df.withColumns({"gender_M": F.col("id") % 2 + 0.0, "gender_F": 1.0 - F.col("id") % 2, "contacts_count_12mo": F.lit(3.0)})
    y = F.col("avg_monthly_spend") + F.col("total_revolving_bal") + 0.3 * F.col("gender_M") + 0.4 * noise(99) > 0.4
    return df.select(F.col("id").cast("string").alias("customer_id"), *MODEL_FEATURES, y.cast("int").alias(LABEL)).cache()


@pytest.fixture(scope="module")
def train(rows):
    return models.features_target(rows).cache()


@pytest.fixture(scope="module")
def table(rows):
    p = rows.toPandas()
    return p[MODEL_FEATURES].to_numpy(float), p[LABEL].to_numpy(float), p["customer_id"].tolist()


def hashed(text, seed):
    return int(hashlib.md5(f"{seed}:{text}".encode()).hexdigest()[:13], 16)


# -- boosting -----------------------------------------------------------------------------


def plain_boosting(x, y, cuts, rounds, depth, rate):
    def grow(idx, g, h, level):
        best = None
        if level < depth:
            for f, c in ((f, c) for f in range(x.shape[1]) for c in cuts[f]):
                left, right = idx[x[idx, f] <= c], idx[x[idx, f] > c]
                if min(h[left].sum(), h[right].sum()) >= 1:
                    score = lambda i: g[i].sum() ** 2 / (h[i].sum() + 1)
                    gain = score(left) + score(right) - score(idx)
                    if best is None or gain > best[0] + 1e-9:
                        best = gain, f, c, left, right
        if best is None or best[0] <= 1e-6:
            step[idx] = -rate * g[idx].sum() / (h[idx].sum() + 1)
            return
        grow(best[3], g, h, level + 1)
        grow(best[4], g, h, level + 1)

    margin, losses = np.zeros(len(y)), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        step = np.zeros(len(y))
        grow(np.arange(len(y)), p - y, p * (1 - p), 0)
        margin += step
        losses.append(np.mean(np.logaddexp(0, margin) - y * margin))
    return losses


@pytest.mark.parametrize("node_rows", [0, 60, 1 << 15])
def test_boosting_equals_plain_implementation(train, table, node_rows):
    x, y, _ = table
    cuts = trees.fit_binning(trees._points(train), x.shape[1], 16).cuts
    assert cuts[MODEL_FEATURES.index("contacts_count_12mo")] == []
    model = trees.boost(train, rounds=5, depth=4, rate=0.3, bins=16, node_rows=node_rows)
    losses = {r["round"]: r["loss"] for r in models.gbt_losses(model, {"train": train}).collect()}
    want = plain_boosting(x, y, cuts, 5, 4, 0.3)
    assert [losses[i] for i in range(1, 6)] == pytest.approx(want, abs=1e-6)
    scored = models.batch_score(model, train)
    assert evaluate.log_loss(scored).first()[0] == pytest.approx(want[-1], abs=1e-6)


def test_boosting_of_small_and_empty_tables(spark, train):
    with pytest.raises(ValueError):
        trees.boost(train.limit(0), 2, 2, 0.1)
    with pytest.raises(ValueError):
        trees.boost(train, 0, 2, 0.1)
    one = trees.boost(train.limit(1), 2, 2, 0.1)
    assert (one.feature == -1).all() and len(one.roots) == 2
    got = models.gbt_losses(one, {"train": train, "none": train.limit(0)}).collect()
    assert {r["round"] for r in got if r["part"] == "train"} == {1, 2}
    assert all((r["loss"] is None) == (r["part"] == "none") for r in got)


# -- extremely randomised trees -----------------------------------------------------------


def plain_extra_trees(x, y, count, seed):
    shares = []
    for tree in range(count):
        gains = np.zeros(x.shape[1])

        def grow(idx, path):
            best = None
            for f in range(x.shape[1]):
                low, high = x[idx, f].min(), x[idx, f].max()
                if len(idx) < 2 or len(set(y[idx])) < 2 or low == high:
                    continue
                u = hashed(f"{tree}|{path}|{f}", seed) / (1 << 52)
                left = x[idx, f] <= low + u * (high - low)
                a, b = y[idx][left], y[idx][~left]
                if len(b):
                    gain = a.sum() ** 2 / len(a) + b.sum() ** 2 / len(b) - y[idx].sum() ** 2 / len(idx)
                    if best is None or (gain, u) > best[:2]:
                        best = gain, u, f, idx[left], idx[~left]
            if best:
                gains[best[2]] += best[0]
                grow(best[3], path + "L")
                grow(best[4], path + "R")

        grow(np.arange(len(y)), "")
        shares.append(gains / gains.sum())
    mean = np.mean(shares, axis=0)
    return mean / mean.sum()


@pytest.mark.parametrize("local_rows", [20, 150, 100_000])
def test_extra_trees_equal_plain_builder(rows, table, local_rows):
    x, y, _ = table
    got = models.forest_regress_importance(rows, "customer_id", MODEL_FEATURES, trees_=3, seed=7, local_rows=local_rows).collect()
    want = dict(zip(MODEL_FEATURES, plain_extra_trees(x, y, 3, 7)))
    assert [r["feature"] for r in got] == sorted(want, key=lambda f: (-want[f], f))
    assert {r["feature"]: r["importance"] for r in got} == pytest.approx(want, abs=1e-9)


def test_extra_trees_of_odd_tables(spark, rows):
    same = rows.withColumn(LABEL, F.lit(1))
    for df in (same, rows.limit(0), rows.limit(1), rows.withColumn("gender_M", F.lit(None).cast("double"))):
        got = models.forest_regress_importance(df, "customer_id", MODEL_FEATURES, trees_=2).collect()
        assert [r["importance"] for r in got] == [0.0] * len(MODEL_FEATURES)


# -- forests over a grid ------------------------------------------------------------------

GRID = {"depth": [2, 4, 9], "leaf": [1, 5], "split": [2, 12, 60], "trees": [3, 7]}


def plain_tree(bins, y, w, idx, width, leaf, split, depth, tries, seed, tree, heap=1, level=0):
    """A function from bins to the share of ones."""
    weight, ones = w[idx].sum(), (w * y)[idx].sum()
    value = ones / weight
    if level == depth or len(idx) < split or value in (0, 1):
        return lambda b: value
    usable = []
    draws = trees.feature_draws(seed, tree, np.array([heap]), bins.shape[1])[0]
    for f in np.argsort(draws >> np.uint64(1), kind="stable"):
        best = None
        for c in range(width - 1):
            left, right = idx[bins[idx, f] <= c], idx[bins[idx, f] > c]
            if min(len(left), len(right)) >= leaf:
                score = sum(((w * y)[i].sum() ** 2 + (w * (1 - y))[i].sum() ** 2) / w[i].sum() for i in (left, right))
                if best is None or score > best[0]:
                    best = score, -f, c, left, right
        if best:
            usable.append(best)
        if len(usable) == tries:
            break
    if not usable:
        return lambda b: value
    _, f, c, left, right = max(usable, key=lambda u: u[:2])
    below = [
        plain_tree(bins, y, w, i, width, leaf, split, depth, tries, seed, tree, 2 * heap + k, level + 1)
        for k, i in enumerate((left, right))
    ]
    return lambda b: below[int(b[-f] > c)](b)


def poisson(u, mean):
    total, term = 0.0, math.exp(-mean)
    for k in range(12):
        total += term
        if u < total:
            return k
        term *= mean / (k + 1)
    return 12


def plain_forests(x, y, keys, cuts, grid, folds, seed, mean):
    order = sorted(range(len(keys)), key=lambda i: keys[i])
    x, y, keys = x[order], y[order], [keys[i] for i in order]
    bins = np.array([[sum(c < v for c in cs) for cs, v in zip(cuts, row)] for row in x])
    fold = np.array([hashed(k, seed) % folds for k in keys])
    width, tries = max(map(len, cuts)) + 1, int(math.sqrt(x.shape[1]))
    weight = [np.array([poisson(hashed(f"bag|{t}|{k}", seed) / (1 << 52), mean) for k in keys], float) for t in range(max(grid["trees"]))]
    out = []
    for depth, leaf, split in itertools.product(grid["depth"], grid["leaf"], grid["split"]):
        scores = {n: [] for n in grid["trees"]}
        for out_fold in range(folds):
            total, own = np.zeros((fold == out_fold).sum()), fold == out_fold
            for t, w in enumerate(weight):
                idx = np.flatnonzero(~own & (w > 0))
                tree = plain_tree(bins, y, w, idx, width, leaf, split, depth, tries, seed, t)
                total += [tree(b) for b in bins[own]]
                if t + 1 in scores:
                    scores[t + 1].append(np.mean((total > 0.5 * (t + 1)) == (y[own] > 0.5)))
        out += [((depth, leaf, split, n), np.mean(s)) for n, s in scores.items()]
    return out


@pytest.mark.parametrize("bag_rows", [2_000, 150])
def test_grid_equals_plain_forests(train, table, bag_rows, monkeypatch):
    monkeypatch.setattr(trees, "BINS", 8)
    x, y, keys = table
    cuts = trees.fit_binning(trees._points(train), x.shape[1], trees.BINS).cuts
    monkeypatch.setattr(trees, "fit_binning", lambda rows, features, bins=8: trees.Binning(cuts))
    found = models.grid_search(train, grid=GRID, folds=2, seed=5, bag_rows=bag_rows)
    want = plain_forests(x, y, keys, cuts, GRID, 2, 5, min(1.0, bag_rows / len(y)))
    got = {(r["depth"], r["leaf"], r["split"], r["trees"]): r["accuracy"] for r in found.scores.collect()}
    assert len(got) == 36 and got == pytest.approx(dict(want))
    assert tuple(found.best.values()) == max(want, key=lambda r: (r[1], -want.index(r)))[0]
    assert found.best_score == pytest.approx(max(s for _, s in want))
    # The grown forest, cut back, is the plain one.
    depth, leaf, split, number = found.best.values()
    order = sorted(range(len(keys)), key=lambda i: keys[i])
    bins = np.array([[sum(c < v for c in cs) for cs, v in zip(cuts, row)] for row in x])[order]
    total = np.zeros(len(y))
    for t in range(number):
        w = np.array([poisson(hashed(f"bag|{t}|{keys[i]}", 5) / (1 << 52), min(1.0, bag_rows / len(y))) for i in order], float)
        tree = plain_tree(bins, y[order], w, np.flatnonzero(w > 0), max(map(len, cuts)) + 1, leaf, split, depth, 2, 5, t)
        total += [tree(b) for b in bins]
    assert found.model.score(x[order]) == pytest.approx(total / number)


def test_every_bag_is_drawn_from_all_rows_and_as_large(spark):
    df = spark.range(4_000).select(F.col("id").cast("string").alias("customer_id"), *[noise(i).alias(c) for i, c in enumerate(MODEL_FEATURES)])
    train = models.features_target(df.withColumn(LABEL, (F.col("avg_monthly_spend") > 0).cast("int")))
    found = models.grid_search(train, grid={"depth": [14], "leaf": [1], "split": [2], "trees": [3]}, folds=2)
    # Splits down to pure leaves win half the weight of the bag where half of the labels are ones.
    won = [found.model.gain[found.model.tree == t].sum() for t in range(3)]
    assert len(won) == 3 and min(won) > 0.45 * 4_000


def test_saved_model_scores_alike(spark, train, rows, tmp_path):
    found = models.grid_search(train, grid={k: v[-1:] for k, v in GRID.items()}, folds=2)
    models.save_model(found.model, str(tmp_path / "m"), spark)
    loaded = models.TreeModel.load(spark, str(tmp_path / "m"))
    a, b = (models.batch_score(m, train).orderBy("customer_id").collect() for m in (found.model, loaded))
    assert a == b and a[0].asDict().keys() == {"customer_id", "label", "prediction", "score"}
    importance = models.feature_importance(loaded, spark).collect()
    assert importance[0]["feature"] in ("avg_monthly_spend", "total_revolving_bal")
    assert sum(r["importance"] for r in importance) == pytest.approx(1)


def test_reference_grid_has_81_settings():
    assert math.prod(map(len, models.FOREST_GRID.values())) == 81


def test_rows_walk_to_the_node_where_each_setting_ends():
    rng = np.random.default_rng(5)
    bins, y = rng.integers(0, 16, (400, 3)), rng.integers(0, 2, 400).astype(float)
    grown = trees.grow_tree(bins, y, np.ones(400), 16, 1, 9, 2, 1, 0)
    depths, splits = [0, 3, 9, 12], [2, 7, 50]
    got = trees.walk(grown, bins, depths, splits)
    for (i, j, r), value in np.ndenumerate(got[:, :, ::40]):
        at, row = 0, bins[40 * r]
        for _ in range(depths[i]):
            if grown["feature"][at] < 0 or grown["count"][at] < splits[j]:
                break
            at = grown["left"][at] + (row[grown["feature"][at]] > grown["cut"][at])
        assert value == grown["value"][at]
    table = trees.stop_values(grown, depths, splits)
    assert table.shape == (4, 3, len(grown["value"]))


def test_levels_are_summed_in_tasks_by_arrays(train, monkeypatch):
    def none(*_):
        raise AssertionError("a row per feature")

    monkeypatch.setattr(trees.F, "posexplode", none)
    assert len(trees.boost(train, rounds=1, depth=2, rate=0.3, bins=16, node_rows=0).roots) == 1

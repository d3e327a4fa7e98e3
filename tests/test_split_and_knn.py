import numpy as np
import pytest
from churnlens.operators import knn, split
from pyspark.sql import functions as F


@pytest.mark.parametrize("n", [0, 1, 7, 1003])
def test_exact_split(spark, n):
    df = spark.range(n).select(F.col("id").cast("string").alias("k"))
    parts = split.split_exact(df, "k")
    sizes = {r["part"]: r["count"] for r in parts.groupBy("part").count().collect()}
    a, b = int(0.7 * n), int(0.85 * n)
    want = {"train": a, "validate": b - a, "test": n - b}
    assert sizes == {p: s for p, s in want.items() if s}
    assert parts.select("k").distinct().count() == n


def test_split_does_not_depend_on_layout(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("k"))
    for method in (split.split_exact, split.split_by_hash):
        one = method(df.repartition(1), "k").collect()
        many = method(df.repartition(7, F.rand(3)), "k").collect()
        assert sorted(one) == sorted(many)
    shares = split.split_by_hash(df, "k").groupBy("part").count().collect()
    assert {r["part"] for r in shares} == {"train", "validate", "test"}


def test_sample_and_shuffle(spark):
    df = spark.range(100).select(F.col("id").alias("k"))
    assert split.sample_n(df, "k", 10).count() == 10
    shuffled = [r["k"] for r in split.shuffle(df, "k").collect()]
    assert sorted(shuffled) == list(range(100)) and shuffled != list(range(100))
    assert [r["k"] for r in split.sample_n(df, "k", 10).collect()] == shuffled[:10]


def brute(points, train, query, k):
    d = np.sqrt(((points[train] - points[query]) ** 2).sum(1))
    return train[np.lexsort((train, d))[:k]].tolist()


@pytest.mark.parametrize("block_rows", [50, 5_000])
def test_neighbours_equal_brute_force(spark, block_rows):
    """Clusters of very different density, and a third of all rows being copies."""
    rng = np.random.default_rng(0)
    clusters = [rng.normal(c, s, (200, 3)) for c, s in ((0, 0.3), (5, 0.1), (20, 2.0))]
    points = np.concatenate([*clusters, np.zeros((300, 3))])
    label = (np.arange(len(points)) * 7 % 3).astype(int)
    rows = [(i, int(label[i]), points[i].tolist()) for i in range(len(points))]
    df = spark.createDataFrame(rows, "id long, y int, v array<double>").repartition(4)
    is_query = F.col("id") % 6 == 0
    found = knn.knn_neighbours(
        df.where(~is_query), df.where(is_query), "id", "v", "y", 20, block_rows
    ).toPandas()
    ids = np.arange(len(points))
    train = ids[ids % 6 != 0]
    got = {q: g.sort_values(["distance", "neighbour"]).neighbour.tolist() for q, g in found.groupby("id")}
    assert got == {q: brute(points, train, q, 20) for q in ids[ids % 6 == 0]}
    votes = knn.knn_classify(df.where(~is_query), df.where(is_query), "id", "v", "y", 20, block_rows)
    for q, prediction in votes.collect():
        counts = np.bincount(label[got[q]], minlength=3)
        assert prediction == counts.argmax()


def test_fewer_rows_than_neighbours(spark):
    df = spark.createDataFrame([("a", 1, [0.0]), ("b", 0, [1.0]), ("c", 0, [5.0])], "id string, y int, v array<double>")
    q = spark.createDataFrame([("q", [0.1])], "id string, v array<double>")
    got = knn.knn_neighbours(df, q, "id", "v", "y", 10).collect()
    assert sorted(r["neighbour"] for r in got) == ["a", "b", "c"]
    assert knn.knn_classify(df, q, "id", "v", "y", 10).first()["prediction"] == 0
    assert knn.knn_classify(df, q, "id", "v", "y", 2).first()["prediction"] == 0
    assert knn.knn_classify(df, q, "id", "v", "y", 1).first()["prediction"] == 1
    assert knn.knn_classify(df.limit(0), q, "id", "v", "y", 1).count() == 0


@pytest.mark.parametrize("spread", [0.8, 0.0])
def test_many_dimensions(spark, spread):
    """Where the pivots tell nothing, partial distances leave out most rows; neighbours stay exact."""
    rng = np.random.default_rng(3)
    scale = spread ** np.arange(48) if spread else np.ones(48)
    points = np.concatenate([rng.normal(0, 1, (900, 48)) * scale, np.ones((300, 48))])
    df = spark.createDataFrame([(i, 0, p.tolist()) for i, p in enumerate(points)], "id long, y int, v array<double>")
    is_query = F.col("id") % 6 == 0
    args = df.where(~is_query), df.where(is_query), "id", "v", "y", 5, 100
    found = knn.knn_neighbours(*args).toPandas()
    got = {q: g.sort_values(["distance", "neighbour"]).neighbour.tolist() for q, g in found.groupby("id")}
    ids = np.arange(len(points))
    assert got == {q: brute(points, ids[ids % 6 != 0], q, 5) for q in ids[ids % 6 == 0]}
    effort = knn.search_effort(*args).first()
    assert 0 < effort["measured"] <= effort["pairs"] <= 200 * 1000
    if spread:
        assert effort["measured"] < 0.5 * effort["pairs"]


def test_effort_without_rows(spark):
    df = spark.createDataFrame([(1, 0, [0.0])], "id long, y int, v array<double>")
    assert knn.search_effort(df.limit(0), df, "id", "v", "y", 1).first() == (0, 0, 0, 0)


def test_rows_of_the_own_cell_tighten_the_bounds():
    import pyarrow as pa

    rng = np.random.default_rng(2)
    q, t = rng.normal(size=(6, 4)), rng.normal(size=(300, 4))
    batch = pa.RecordBatch.from_pydict(
        {
            "ids": [list(range(6))] * 2,
            "vecs": [q.ravel().tolist()] * 2,
            "bounds": [[50.0] * 6] * 2,
            "spread": [1, 2],
            "t_vecs": [t.ravel().tolist(), None],
        }
    )
    pivots = np.array([[0.0] * 4, [30.0] * 4])
    cells = {0: {"n": 300, "low": 0.0, "high": 10.0, "kth": None}, 1: {"n": 9, "low": 0.0, "high": 1.0, "kth": None}}
    near, far = knn._reached([batch], pivots, cells, {0: range(1), 1: range(3, 5)}, 20)
    kth = np.sqrt(((q[:, None] - t[None]) ** 2).sum(axis=2))
    kth.sort(axis=1)
    assert near["bounds"][0].as_py() == pytest.approx(kth[:, 19], rel=1e-6)
    assert (near["reach"][0].as_py(), near["groups"][0].as_py()) == ([0], [0])
    assert far["bounds"][0].as_py() == [50.0] * 6
    wide = [0, 1] if (np.linalg.norm(q - 30, axis=1) - 1 <= 50).any() else [0]
    assert far["reach"][0].as_py() == wide and far["groups"][0].as_py() == ([0, 3, 4] if len(wide) > 1 else [0])


@pytest.mark.parametrize("shift,scale", [(0, 1), (4_000, 1), (0, 1e14), (0, 1e-25)])
def test_rough_distances_lose_no_neighbour(shift, scale):
    """Single precision only sorts out what is too far; far from the origin it may sort out nothing."""
    rng = np.random.default_rng(4)
    q, t = ((rng.normal(size=(n, 5)) + shift) * scale for n in (40, 900))
    exact = ((q[:, None] - t[None]) ** 2).sum(axis=2)
    for bound in (np.inf, 1.5 * scale):
        rows, cols, _, _ = knn._nearest(q, t, 30, np.full(40, bound), None, None)
        for i in range(40):
            want = [j for j in np.lexsort((np.arange(900), exact[i]))[:30] if np.sqrt(exact[i, j]) <= bound]
            assert set(want) <= set(cols[rows == i].tolist())

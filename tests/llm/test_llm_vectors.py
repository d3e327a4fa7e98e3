import numpy as np
import pytest
from brute import Union

from churnlens.llm import queries, vectors


def truth(rows, threshold=0.95):
    x = np.array([v for _, v in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= threshold
    union = Union()
    for i, j in zip(*np.nonzero(near)):
        union.link(rows[i][0], rows[j][0])
    return {k: (int(near[i].sum()) - 1, union.find(k)) for i, (k, _) in enumerate(rows)}


def result(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in df.collect()}


def test_query_equals_brute_force(spark, data_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{data_dir}/embeddings.parquet").collect()]
    assert result(queries.QUERIES["op10_embedding_near_dedup"](spark, data_dir)) == truth(rows)


@pytest.mark.parametrize("block", [2_048, 40])
def test_crowded_buckets_and_copies(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", block)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(6, 16))
    rows = [(i, (centres[i % 6] + rng.normal(scale=0.12, size=16)).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1_000 + i, rows[0][1]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got, want = result(vectors.near_duplicate_vectors(df)), truth(rows)
    assert all(got[k][0] <= want[k][0] for k in want)
    assert sum(g[0] for g in got.values()) >= 0.99 * sum(w[0] for w in want.values())
    assert sum(got[k][1] == want[k][1] for k in want) >= 0.99 * len(want)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, []),
        (8, [1.0, 0.0, 0.0]), (9, [1.0, None]), (None, [1.0, 0.0]), (1, [1.0, 0.0]), (11, [-1.0, 0.0]),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, kept string")
    got = vectors.near_duplicate_vectors(df).collect()
    assert len(got) == len(rows)
    alone = {3, 4, 5, 6, 7, 8, 9, 11}
    for r in got:
        if r["vec_id"] in alone:
            assert tuple(r) == (r["vec_id"], 0, r["vec_id"], True)
    assert {tuple(r) for r in got if r["vec_id"] in (1, 2, None)} == {(1, 2, 1, True), (2, 2, 1, False), (None, 0, None, True)}
    assert vectors.near_duplicate_vectors(df.limit(0)).count() == 0


def test_table_plan_reaches_the_recall():
    for n in (10, 10_000, 10_000_000):
        bits, tables = vectors.table_plan(n, 0.95, 0.998)
        same = (1 - np.arccos(0.95) / np.pi) ** bits
        assert 1 - (1 - same) ** tables >= 0.998

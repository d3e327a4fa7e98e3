import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from brute import components, shingles

from churnlens.llm import minmax, queries
from churnlens.llm.components import connected_components
from churnlens.llm.text import shingle_hashes, texts_of, words_of


def run(df, **options):
    return {r["doc_id"]: r for r in minmax.near_duplicates(df, **options).collect()}


def test_query_equals_brute_force(spark, data_dir):
    got = {r["doc_id"]: r for r in queries.QUERIES["op7_minhash_near_dedup"](spark, data_dir).collect()}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{data_dir}/documents.parquet").collect()}
    assert {i: r["component_id"] for i, r in got.items()} == components(texts, 2)
    assert all(got[i]["n_shingles"] == len(shingles(t, 2)) for i, t in texts.items())
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


@pytest.mark.parametrize("size", [2, 5])
def test_group_of_near_copies(spark, size):
    """Copies with edits of all sizes around the threshold, in one bucket or in many."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    texts = {}
    for i in range(120):
        own = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 5])):
            own[rng.randrange(60)] = f"x{rng.randrange(1000)}"
        texts[i] = " ".join(own)
    texts |= {200 + i: f"Alone {i} with words of its own {i * 7}" for i in range(20)}
    got = run(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), words=size)
    assert {i: r["component_id"] for i, r in got.items()} == components(texts, size)


def test_edge_rows(spark):
    rows = [(1, "A b c"), (2, "a B\tc"), (3, None), (4, ""), (5, " \n"), (6, "one"), (7, "ONE"), (None, "a b c"), (9, "É x"), (10, "é x"), (1, "A b c")]
    df = spark.createDataFrame([(*r, "z", 1) for r in rows], "doc_id long, text string, component_id string, id int")
    got = minmax.near_duplicates(df, words=2).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got}
    assert by_id == {
        1: (2, 1, True), 2: (2, 1, False), 3: (0, 3, True), 4: (0, 4, True), 5: (0, 5, True), 6: (1, 6, True),
        7: (1, 6, False), None: (2, None, True), 9: (1, 9, True), 10: (1, 10, True),
    }
    assert minmax.near_duplicates(df.limit(0)).count() == 0


def test_very_long_texts(spark):
    long = " ".join(f"w{i % 50_021}" for i in range(300_000))
    got = run(spark.createDataFrame([(5, long), (3, long + " tail"), (4, "short one")], "doc_id long, text string"))
    assert [got[i]["component_id"] for i in (3, 4, 5)] == [3, 4, 3]


def test_signature_estimates_similarity():
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 1 << 63, 1_100).astype(np.uint64)
    a, b = minmax.signature(pool[:1_000]), minmax.signature(pool[100:])
    assert abs((a == b).mean() - 900 / 1_100) < 0.06
    wide = minmax.parity_sketch(pool[:1_000]) ^ minmax.parity_sketch(pool[100:])
    assert np.bitwise_count(wide.view(np.uint64)).sum() <= 200


def test_shingles_of_words():

    texts = texts_of(pa.array(["a b c", None, "", "A  B\nC d", "b"]))
    words = words_of(texts)
    assert words.counts.tolist() == [3, 0, 0, 4, 1]
    hashes, first = shingle_hashes(words, 2)
    assert first.tolist() == [0, 2, 2, 2, 5, 6]
    assert hashes[:2].tolist() == hashes[2:4].tolist() and len(set(hashes.tolist())) == 4
    assert len(shingle_hashes(words_of(texts_of(pa.array([], pa.string()))), 2)[0]) == 0


def test_no_two_words_share_a_hash():
    mirror = ["".join("ab"[(i.bit_count() + k) % 2] for i in range(1024)) for k in (0, 1)]
    long = ["x" * n + y + "x" * (200 - n) for n in range(60, 200) for y in ("ab", "ba", "aa")]
    names = sorted({*mirror, *long, *("".join(p) for p in itertools.product("abAB", repeat=5))})
    for fold in (True, False):
        hashes = words_of(texts_of(pa.array([" ".join(names)])), fold).hashes
        assert len(hashes) == len(names)
        assert len(set(hashes.tolist())) == len({n.lower() for n in names} if fold else names)


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 60)] + [(3, 3), (None, 4), (60, 8), (8, 60)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "src long, dst long")).collect()}
    assert got == {i: 100 for i in range(100, 141)} | {i: 7 for i in range(7, 61)}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0

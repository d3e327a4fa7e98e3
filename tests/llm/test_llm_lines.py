import hashlib

import numpy as np
import pytest
from brute import cleaned_lines
from compare import connect, difference

from churnlens.llm import lines, queries


def test_index_is_minimal_and_perfect():
    rng = np.random.default_rng(1)
    halves = rng.integers(0, 1 << 63, (5_000, 2)).astype(np.uint64)
    halves[1] = halves[0] + np.array([0, 1], np.uint64)  # half of the hash in common
    counts = rng.integers(1, 70_000, 5_000)
    index = lines.LineIndex(halves, counts)
    assert (index.lookup(halves) == counts).all()
    assert len(index.counts) == len(index.fingerprints) == 5_000
    assert (index.lookup(halves + np.array([7, 1 << 40], np.uint64)) == 0).all()
    assert len(lines.LineIndex(halves[:0], counts[:0]).lookup(halves[:3])) == 3


def test_hashes_that_no_level_places_are_listed(monkeypatch):
    monkeypatch.setattr(lines, "_LEVELS", 1)
    halves = np.random.default_rng(2).integers(0, 1 << 63, (500, 2)).astype(np.uint64)
    index = lines.LineIndex(halves, np.arange(500))
    assert index.listed and (index.lookup(halves) == np.arange(500)).all()


def test_query_equals_sql(spark, data_dir):
    name = "op5_line_dedup"
    assert difference(queries.QUERIES[name](spark, data_dir), connect(data_dir), queries.ORACLE[name]) is None


@pytest.mark.parametrize("shard_lines", [1 << 17, 4])
def test_lines_equal_brute_force(spark, monkeypatch, shard_lines):
    monkeypatch.setattr(lines, "SHARD_LINES", shard_lines)
    monkeypatch.setattr(lines, "CHUNK_BYTES", 20_000)
    texts = [f"Head {i % 4}\n \t COMMON\x0b \nbody {i}\n\n{'É' if i % 2 else 'é'}" for i in range(12)]
    texts += [None, "", "\n", "common\ncommon", "x " * 50_000 + "\nCommon", texts[0], texts[0]]
    df = spark.createDataFrame([(i if i != 3 else None, t, "n") for i, t in enumerate(texts)], "doc_id long, text string, n_lines string")
    for min_docs in (1, 3, 6):
        got = lines.dedup_lines(df, min_docs=min_docs).collect()
        want = cleaned_lines(texts, min_docs)
        pairs = {(i if i != 3 else None): (*w[:2], None if t is None else w[2]) for i, (w, t) in enumerate(zip(want, texts))}
        assert {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in got} == pairs
    assert lines.dedup_lines(df.limit(0)).count() == 0
    assert lines.dedup_lines(df).columns == ["doc_id", "text", "n_lines", "n_dropped"]


def test_null_text_counts_as_one_empty_line(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op5_line_dedup"](spark, str(tmp_path)).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted(map(tuple, got)) == [(1, 1, 0, empty), (2, 1, 0, empty)]

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from brute import words
from pyspark.sql import functions as F

from churnlens.llm import langid, lbl, quality, queries
from churnlens.llm.text import texts_of, words_of

DOCS = "doc_id long, text string, lang string, extra int"


def remainder(i, m):
    return zlib.crc32(str(i).encode()) % m


# -- language -----------------------------------------------------------------------------


def test_language_of_held_out_documents(spark, data_dir):
    got = {r["doc_id"]: r for r in queries.QUERIES["op6_language_id"](spark, data_dir).collect()}
    docs = spark.read.parquet(f"{data_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    held = [r for r in docs if remainder(r["doc_id"], 4) == 2]
    assert all(got[r["doc_id"]]["held_out"] == (remainder(r["doc_id"], 4) == 2) for r in docs)
    assert sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_codewords_differ():
    for n in (2, 3, 4, 5, 6, 20):
        code = langid.codewords(n)
        apart = [(a != b).sum() for i, a in enumerate(code) for b in code[:i]]
        assert min(apart) >= (1 if n == 2 else 2 if n < 6 else 4)
        assert (np.abs(code.sum(axis=0)) < n).all()


def test_language_edge_rows(spark):
    rows = [(i, t, lang, i) for i, (t, lang) in enumerate([("the cat sat", "en"), ("le chat noir", "fr")] * 6)]
    rows += [(50, None, "en", 1), (51, "123 !!", "fr", 1), (52, "", None, 1), (None, "the cat", None, 1), (53, "the cat sat" * 50_000, None, 1)]
    df = spark.createDataFrame(rows, DOCS)
    model = langid.train(df, F.lit(True))
    got = {r["doc_id"]: r for r in langid.identify(df.withColumn("score", F.lit("old")), model).collect()}
    assert [got[i]["lang_pred"] for i in (50, 51, 52, None, 53)] == ["und", "und", "und", "en", "en"]
    assert all(got[i]["score"] == 0 and got[i]["ambiguous"] for i in (50, 51, 52))
    one = langid.train(df.where("lang = 'en'"), F.lit(True))
    assert {r["lang_pred"] for r in langid.identify(df, one).collect()} == {"en", "und"}
    none = langid.train(df.limit(0), F.lit(True))
    assert {r["lang_pred"] for r in langid.identify(df, none).collect()} == {"und"}
    assert langid.identify(df.limit(0), model).count() == 0


def test_texts_between_two_languages_are_ambiguous(spark):
    rng = np.random.default_rng(5)

    def prose(letters, n):
        return " ".join("".join(rng.choice(list(letters), 5)) for _ in range(n))

    rows = [(2 * i + k, prose(letters, 60), lang, 0) for i in range(40) for k, (letters, lang) in enumerate([("abcdefgh", "a"), ("nopqrstu", "n")])]
    model = langid.train(spark.createDataFrame(rows, DOCS), F.lit(True))
    torn = [(i, f"{prose('abcdefgh', n)} {prose('nopqrstu', n)}", None, 1) for i, n in enumerate([2, 10, 50, 500])]
    clear = [(10 + i, prose(letters, n), None, 0) for i, (letters, n) in enumerate([("abcdefgh", 2), ("nopqrstu", 2), ("abcdefgh", 500), ("nopqrstu", 20)])]
    got = langid.identify(spark.createDataFrame(torn + clear, DOCS), model).collect()
    assert {r["doc_id"]: r["ambiguous"] for r in got} == {r[0]: r[3] == 1 for r in torn + clear}


# -- quality ------------------------------------------------------------------------------


def test_quality_of_held_out_documents(spark, data_dir):
    got = {r["doc_id"]: r for r in queries.QUERIES["op4_quality"](spark, data_dir).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{data_dir}/labels.parquet").collect()}
    assert all(r["held_out"] == (remainder(i, 3) == 1) and r["predicted"] == (r["score"] >= 0.5) for i, r in got.items())
    held = [i for i in labels if remainder(i, 3) == 1]
    pairs = [(got[i]["score"], got[j]["score"]) for i in held if labels[i] for j in held if not labels[j]]
    assert pairs and sum(a > b for a, b in pairs) >= 0.9 * len(pairs)


def test_quality_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, "x", 1), (2, "", "x", 1), (None, "a b", "x", 1), (3, "word " * 100_000, "x", 1), (3, "again", "x", 1)], DOCS)
    labels = spark.createDataFrame([(1, 1), (3, None), (None, 0)], "doc_id long, quality int")
    model = quality.train(docs, labels, F.lit(True))
    got = quality.score(docs.withColumn("score", F.lit("old")), model).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    scores = {r["doc_id"]: r["score"] for r in got}
    assert scores[1] == scores[2]
    none = quality.train(docs.limit(0), labels, F.lit(True))
    assert {r["score"] for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(docs.limit(0), model).count() == 0


def test_word_buckets_tell_words_apart():
    buckets, first = quality.word_buckets(texts_of(pa.array(["the THE the!! 12 345", "", None, "!!the"])))
    assert first.tolist() == [0, 6, 6, 6, 8]
    b = buckets.tolist()
    assert b[0] == b[2] == b[7] != b[1] and b[3] == b[6] and b[4] == b[5]


def test_temperature_calibrates():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3_000, 5))
    y = (rng.random(3_000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(int)
    net = quality.fit_network(x.astype(np.float32), y)
    p = net.probabilities(x)
    assert abs(p.mean() - y.mean()) < 0.05 and 0.25 <= net.temperature <= 8


# -- language model -----------------------------------------------------------------------


def test_language_model_scores(spark, data_dir):
    got = {r["doc_id"]: r for r in queries.QUERIES["op9_lm_scoring"](spark, data_dir).collect()}
    tokens = {r["doc_id"]: [*words(r["text"]), None] for r in spark.read.parquet(f"{data_dir}/documents.parquet").collect()}
    count = Counter(w for i, t in tokens.items() if remainder(i, 7) != 2 for w in t)
    total, distinct = sum(count.values()), len(count)
    for i, t in tokens.items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(count[w] > 0 for w in t), total)
        base = sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in t)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and r["held_out"] == (remainder(i, 7) == 2)
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def keyed(df):
    return df.select(F.xxhash64("text").alias("key"), "text")


def test_model_distribution_sums_to_one(spark):
    rows = [(f"the cat {i} sat on the mat. Ünd, x{i % 7}! " + " ".join(f"w{j}" for j in range(i % 40)),) for i in range(300)]
    learnt = lbl.train(keyed(spark.createDataFrame(rows, "text string")))
    m = learnt.model
    assert m.sizes.max() > 1 and len(m.kind) == m.symbols
    tokens = np.arange(m.symbols)
    for before, last in ((m.symbols, m.symbols), (3, 70), (70, 64)):
        logs = m.log_probabilities(tokens, np.full(m.symbols, before), np.full(m.symbols, last))
        assert math.isclose(np.exp(logs).sum(), 1, abs_tol=1e-4)
    # The vocabulary holds all words from the least count; the others and one unknown share their look.
    counts = {r["h"]: r["n"] for r in learnt.counts.collect()}
    least = max(2, math.ceil(math.sqrt(learnt.tokens) / lbl.WORDS_PER_ROOT))
    w = words_of(texts_of(pa.array([r[0] for r in rows])))
    kind = dict(zip(lbl.word_hashes(w).tolist(), m.symbols_of(lbl.word_hashes(w), lbl.rare_classes(w)).tolist()))
    mass = np.ones(lbl.RARE)
    for h, k in kind.items():
        n = counts[int(np.uint64(h).view(np.int64))]
        assert (k > lbl.RARE) == (n >= least)
        if k < lbl.RARE:
            mass[k] += n + 1
    assert np.allclose(mass, m.mass)


def test_vocabulary_grows_with_the_corpus(spark):
    rng = np.random.default_rng(2)
    sizes = []
    for n in (100, 1_600):
        rows = [(" ".join(f"w{k}" for k in (1 / rng.random(60)).astype(int)),) for _ in range(n)]
        learnt = lbl.train(keyed(spark.createDataFrame(rows, "text string")))
        sizes.append(len(learnt.model.hashes))
        assert sizes[-1] <= lbl.WORDS_PER_ROOT * math.sqrt(learnt.tokens)
    assert sizes[1] > 2 * sizes[0]


def test_scores_do_not_follow_the_partitions(spark, data_dir, monkeypatch):
    monkeypatch.setattr(lbl, "TRAIN_BYTES", 300_000)
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    held_out = F.col("doc_id") % 5 == 0
    few, many = ({r["doc_id"]: r["score"] for r in lbl.score_texts(docs.repartition(n), held_out).collect()} for n in (2, 13))
    assert all(math.isclose(few[i], many[i], rel_tol=1e-4) for i in few)


def test_the_words_before_count(spark):
    rng = np.random.default_rng(8)
    follow = {f"w{k}": f"v{k}" for k in range(60)}  # each w is always followed by its own v
    texts = [" ".join(f"{w} {follow[w]}" for w in rng.choice(list(follow), 40)) for _ in range(2_000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = lbl.score_texts(df, F.col("doc_id") < 200).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > 0.75 * got[1]


def test_language_model_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(lbl, "CHUNK_BYTES", 50_000)
    monkeypatch.setattr(lbl, "SHARD_WORDS", 4)
    rows = [(1, None, "x", 1), (2, "", "x", 1), (None, "A b", "x", 1), (3, "word " * 50_000, "x", 1), (3, "a B", "x", 1), (4, "é \x0b É", "x", 1)]
    df = spark.createDataFrame(rows, DOCS).withColumn("n_tokens", F.lit("old"))
    got = lbl.score_texts(df, F.col("doc_id") == 4).collect()
    assert sorted((r["n_tokens"], r["n_known"]) for r in got) == [(1, 1), (1, 1), (3, 1), (3, 3), (3, 3), (50_001, 50_001)]
    assert {r["train_tokens"] for r in got} == {1 + 1 + 3 + 50_001 + 3}
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    nothing = lbl.score_texts(df, F.lit(True)).collect()
    assert {(r["n_known"], r["train_tokens"]) for r in nothing} == {(0, 0)}
    assert lbl.score_texts(df.limit(0), F.lit(False)).count() == 0


def test_label_samples_keep_their_bound(spark):
    rows = [(None if i % 2 else 7, f"word {i % 900} text", "en" if i % 3 else "fr") for i in range(3_000)] + [(1, "same", "de")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    sample = langid.labelled_sample(docs, F.lit(True), "text", "lang", "doc_id", 100)
    assert {r["lang"]: r["count"] for r in sample.groupBy("lang").count().collect()} == {"en": 100, "fr": 100, "de": 1}
    chosen = spark.createDataFrame([(7, 1, 1), (8, 2, 0)], "doc_id long, h long, label int")
    got = quality.sample_texts(docs, chosen, "doc_id", "text").collect()
    assert [(r["h"], r["label"]) for r in got] == [(1, 1)]


def test_slopes_of_a_row_are_added_up_without_a_table_of_them():
    rng = np.random.default_rng(0)
    model = lbl.start_model(np.arange(1, 9, dtype=np.uint64), np.arange(8, 0, -1), np.ones(lbl.RARE), 3, np.ones(lbl.RARE) + 1)
    plain, trainer = lbl.Trainer(model, 1), lbl.Trainer(model, 1)
    rows, of = rng.integers(0, 8, 50), rng.integers(0, 20, 50)
    values, weights = rng.normal(size=(20, lbl.DIM)).astype(np.float32), rng.normal(size=50).astype(np.float32)
    plain._move("words", rows, values[of] * weights[:, None], None, None, 0.1, 10)
    trainer._move("words", rows, values, of, weights, 0.1, 10)
    assert (plain.model.words == trainer.model.words).all() and (trainer.model.words != model.words).any()
    for r in range(8):
        slope = (values[of] * weights[:, None])[rows == r].sum(axis=0) / 10
        moved = 0.1 * slope / np.sqrt(1e-8 + slope**2)
        assert np.allclose(trainer.model.words[r], model.words[r] + moved, atol=1e-4)


def test_log_probabilities_do_not_depend_on_the_block(monkeypatch):
    rng = np.random.default_rng(0)
    model = lbl.start_model(np.arange(1, 40, dtype=np.uint64), np.arange(39, 0, -1), np.ones(lbl.RARE), 3, np.ones(lbl.RARE) + 1)
    tokens, before, last = (rng.integers(0, model.symbols, 500) for _ in range(3))
    whole = model.log_probabilities(tokens, before, last)
    monkeypatch.setattr(lbl, "_CONTEXTS", 7)
    assert np.allclose(model.log_probabilities(tokens, before, last), whole, atol=1e-5)
    wanted = []
    for t, b, c in zip(tokens.tolist(), before.tolist(), last.tolist()):
        guess, kind = model.context[b] + model.context[model.symbols + 1 + c], model.kind[t]
        logits = model.tops @ guess + model.top_bias
        p = logits[kind] - np.log(np.exp(logits).sum())
        if model.sizes[kind] > 1:
            own = slice(model.lows[kind], model.lows[kind] + model.sizes[kind])
            logits = model.words[own] @ guess + model.word_bias[own]
            p += logits[t - lbl.RARE - 1 - model.lows[kind]] - np.log(np.exp(logits).sum())
        wanted.append(p)
    assert np.allclose(whole, wanted, atol=1e-4)
    empty = np.zeros(0, np.int64)
    assert len(model.log_probabilities(empty, empty, empty)) == 0


@pytest.mark.parametrize("weighted", [True, False])
def test_slopes_of_short_and_long_runs(weighted):
    rng = np.random.default_rng(6)
    sizes = np.array([1, 3, 100, 1, lbl._LONG_RUN, lbl._LONG_RUN + 1, 2, 5])
    values = rng.normal(size=(50, 4)).astype(np.float32)
    of = rng.integers(0, 50, sizes.sum())
    weights = rng.normal(size=len(of)).astype(np.float32) if weighted else None
    first = np.cumsum(sizes) - sizes
    runs, sums = lbl._run_sums(values, of, weights, first)
    assert sorted(runs.tolist()) == list(range(len(sizes)))
    rows = values[of] * (weights[:, None] if weighted else 1)
    np.testing.assert_allclose(sums, np.add.reduceat(rows, first, axis=0)[runs], rtol=1e-4, atol=1e-4)

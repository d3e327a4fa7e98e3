"""The pipeline against plain versions of its stages, on a small table."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from brute import ASCII_LOWER, components
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from churnlens.llm import queries
from churnlens.llm.tokens import public_vocabulary

LANGUAGES = {
    "en": "the of and that with this from they have which would there their about other into".split(),
    "fr": "le la les des une dans pour que qui avec être sont cette mais nous vous très".split(),
}


def prose(rng, lang, n):
    return " ".join(rng.choice(LANGUAGES[lang]) + rng.choice(["", "s", "ing", "tion"]) for _ in range(n))


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    rng, folder = random.Random(4), str(tmp_path_factory.mktemp("corpus"))
    item = "the river of the north runs with that stone from which they would have built about twelve houses there"
    rows = []
    for i in range(60):
        lang = "fr" if i % 3 == 0 else "en"
        body = prose(rng, lang, 80)
        rows.append((i, f"Common head of all\n{body}" if i < 15 else body, lang, f"s{i % 4}"))
    words = rows[20][1].split()
    words[3] = "changed"
    rows += [(100, rows[20][1], "en", "s0"), (101, " ".join(words), "en", "s0"), (102, rows[20][1] + "\n", None, "s1")]
    rows += [(103, prose(rng, "en", 30) + " " + item + " " + prose(rng, "en", 30), "en", "s2")]
    rows += [(104, None, "en", "s2"), (105, "", None, "s2"), (106, "12 34 !!", "en", "s2"), (None, prose(rng, "en", 50), None, None)]
    rows += [(107, "Common head of all", "en", "s3")]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows


def cleaned_by_group(rows, min_groups):
    """[(lines, dropped, text)] for (text, group), a line counting once a group."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(ASCII_LOWER)
    groups = {}
    for text, group in rows:
        for line in text.split("\n"):
            groups.setdefault(key(line), set()).add(group)
    out = []
    for text, _ in rows:
        kept = [x for x in text.split("\n") if not key(x) or len(groups[key(x)]) < min_groups]
        out.append((text.count("\n") + 1, text.count("\n") + 1 - len(kept), "\n".join(kept)))
    return out


def test_stages_take_effect(spark, small):
    folder, rows = small
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        docs = spark.createDataFrame(out.collect(), out.schema)
        kept[name] = {r["doc_id"]: r for r in docs.collect()}
    everything = {r[0]: r for r in rows}
    lettered = {i for i in everything if i not in (104, 105, 106)}
    assert set(kept["language_id"]) == lettered
    assert all(everything[i][2] in (None, r["lang"]) for i, r in kept["language_id"].items())
    order = [i for i in everything if i in lettered]
    before = components({i: everything[i][1] for i in order if i is not None}, 5)
    lines = cleaned_by_group([(everything[i][1], before.get(i, ("none", everything[i][1]))) for i in order], 10)
    alive = {i: w[2] for i, w in zip(order, lines) if not (w[1] and not w[2].strip())}
    assert {i: r["text"] for i, r in kept["line_dedup"].items()} == alive
    assert all(r["n_chars"] == len(r["text"]) for r in kept["line_dedup"].values())
    groups = components({i: t for i, t in alive.items() if i is not None}, 5)
    assert set(kept["near_dedup"]) == {i for i in alive if i is None or groups[i] == i}
    assert {100, 102} & set(kept["near_dedup"]) == set()
    assert set(kept["near_dedup"]) - set(kept["decontamination"]) == {103}

    pieces = corpus_pipeline.run(spark, folder).collect()
    tokenizer = Tokenizer.from_file(public_vocabulary("word_bpe_49k.json"))
    assert {p["doc_id"] for p in pieces} == set(kept["decontamination"])
    for i, r in kept["decontamination"].items():
        ids = np.array([*tokenizer.encode(r["text"], add_special_tokens=False).ids, 1], "<u4").tobytes()
        own = sorted((p for p in pieces if p["doc_id"] == i), key=lambda p: p["start"])
        assert zlib.crc32(b"".join(bytes(p["ids"]) for p in own)) == zlib.crc32(ids)


def test_one_of_many_copies_stays(spark):
    rng = random.Random(8)
    text = "\n".join(prose(rng, "en", 20) for _ in range(6))
    rows = [(i, text) for i in range(12)] + [(12 + i, text.replace("\n", " \n\n").upper()) for i in range(12)]
    rows += [(30 + i, f"Common head of all\n{prose(rng, 'en', 40)}") for i in range(10)] + [(50, "Common head of all")] * 12
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    lined = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, docs, "").collect()}
    assert lined == {**dict(rows[:24]), **{i: t.split("\n")[1] for i, t in rows[24:34]}}
    kept = corpus_pipeline.near_dedup(spark, corpus_pipeline.line_dedup(spark, docs, ""), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, *range(30, 40)]


def documents(spark, rows):
    return spark.createDataFrame(
        [(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long"
    )


def two_stages(spark, docs):
    lined = corpus_pipeline.line_dedup(spark, docs, "").cache()
    return lined, corpus_pipeline.near_dedup(spark, lined, "").collect()


def test_one_whole_document_of_many_near_copies_stays(spark):
    rng = random.Random(9)
    shared = [prose(rng, "en", 25) for _ in range(8)]
    near = [(100 + i, "\n".join([*shared, prose(rng, "en", 6)])) for i in range(12)]
    other = [(i, f"Common head of all\n{prose(rng, 'en', 40)}") for i in range(12)]
    lined, kept = two_stages(spark, documents(spark, near + other))
    assert {r["doc_id"]: r["text"] for r in lined.collect()} == dict(near) | {i: t.split("\n")[1] for i, t in other}
    assert {r["doc_id"]: r["text"] for r in kept if r["doc_id"] >= 100} == dict(near[:1])
    assert len(kept) == 13


def test_rows_repeated_in_full_leave_one(spark):
    rng = random.Random(10)
    text, nameless, short = prose(rng, "en", 60), "\n".join(prose(rng, "en", 20) for _ in range(3)), "two words"
    rows = [(1, text)] * 15 + [(2, prose(rng, "en", 50))] + [(None, nameless)] * 14 + [(3, None)] * 3 + [(4, short)] * 12 + [(1, "another text")]
    lined, kept = two_stages(spark, documents(spark, rows))
    assert lined.count() == len(rows)
    got = sorted(((r["doc_id"], r["text"]) for r in kept), key=str)
    assert got == sorted({*rows}, key=str)


def test_registration():
    names = contract.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "packing"]
    assert set(queries.ORACLE) <= set(contract.oracle_sql())


def test_empty_table(spark, small, tmp_path):
    folder, _ = small
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_send_batches_of_bounded_bytes(spark, small, monkeypatch):
    folder, _ = small
    setting, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []
    before = spark.conf.get(setting)

    def bytes_of(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"bytes": [batch.nbytes]})

    def stage(spark, docs, sf_dir):
        wide = spark.range(0, 4_000, 1, 1).select("id", F.repeat(F.lit("x"), 2_500).alias("text"))
        seen.extend(r[0] for r in wide.mapInArrow(bytes_of, "bytes long").collect())
        return docs

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", stage), ("last", lambda spark, docs, sf_dir: docs)])
    assert corpus_pipeline.run(spark, folder).count() > 0
    assert len(seen) > 4 and max(seen) < 1.1 * corpus_pipeline.BATCH_BYTES
    assert spark.conf.get(setting) == before

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor

from churnlens.llm import queries, sentpieces
from churnlens.llm.sentpieces import PieceModel
from churnlens.llm.tokens import public_vocabulary

PATH = public_vocabulary("piece_bpe_32k.model")
ODD = [
    "", " ", "  a", "a\x00b", "▁a", "é\n\t", "<s> </s> <unk> <0x41>", "x  y ", "​", "\U0001f600", "�", " " * 50,
    "a" * 1000, "ab" * 500, "the" * 300, " the" * 200, "中文字符测试" * 30, "ᄒ́͸", "\r\n\x0b\x0c\x1f\x85　",
]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return PieceModel(PATH)


def split(ids, counts):
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


def same(model, library, texts):
    ids, counts = model.encode(pa.array(texts, pa.large_string()))
    want = library.encode(texts)
    assert split(ids, counts) == want
    assert [t.decode() for t in model.decode(ids, counts)] == library.decode(want)


def test_encodes_like_the_library(model, library):
    rng = random.Random(1)
    names = [library.id_to_piece(i) for i in range(259, 32_000)]
    few = ["t", "h", "e", "he", "the", "th", " ", "▁", "in", "ing", "g", "n", "i", "a"]
    same(model, library, ODD)
    for pool, count, longest in ((names, 4_000, 12), (few, 4_000, 40), (list(" ▁\n"), 300, 60)):
        same(model, library, ["".join(rng.choices(pool, k=rng.randint(0, longest))) for _ in range(count)])
    anything = [*range(1, 0xD800), *range(0xE000, 0x110000)]
    same(model, library, ["".join(map(chr, rng.choices(anything, k=20) + rng.choices(range(32, 127), k=20))) for _ in range(500)])
    same(model, library, ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=30_000))])
    assert model.encode(pa.array([], pa.large_string()))[1].tolist() == []


def test_a_pair_that_ranks_sooner_goes_first():
    """A merge that brings up a better pair: later occurrences of the merged pair wait."""
    model = object.__new__(PieceModel)
    model.size = 10
    # a=0 b=1; ab=2 of rank 5, aba=3 of rank 1 from ab + a.
    model.keys = np.array([0 * (10 + sentpieces._POINTS) + 1, 2 * (10 + sentpieces._POINTS) + 0])
    model.made, model.ranks = np.array([2, 3]), np.array([5, 1], np.int32)
    symbols, counts = model.merge(np.array([0, 1, 0, 1, 0, 0, 1]), np.array([0, 5]))
    assert symbols.tolist() == [3, 1, 0, 2] and counts.tolist() == [3, 1]


def test_decodes_any_ids_like_the_library(model, library):
    rng = random.Random(2)
    rows = [[rng.randint(0, top) for _ in range(rng.randint(0, 10))] for top in (31_999, 300, 300) for _ in range(1_000)]
    got = model.decode(np.array([i for r in rows for i in r], np.int64), np.array([len(r) for r in rows]))
    assert [t.decode() for t in got] == [library.decode(r) for r in rows]


def check(rows, library):
    for r in rows:
        ids = library.encode(r["text"] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_query(spark, data_dir, library, tmp_path):
    name = "op11_sentencepiece"
    texts = spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text")
    rows = queries.QUERIES[name](spark, data_dir).join(texts, "doc_id").collect()
    assert len(rows) == texts.count()
    check(rows, library)
    odd = [*enumerate(ODD), (100, None), (101, "long " * 200_000)]
    df = spark.createDataFrame([(*r, [1]) for r in [*odd, (None, "no id"), (None, "no id")]], "doc_id long, text string, ids array<int>")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES[name](spark, str(tmp_path))
    check(got.join(df.drop("ids"), "doc_id").collect(), library)
    assert got.where("doc_id is null").count() == 2
    both = sentpieces.decode(sentpieces.encode(df, PATH, decoded=True), PATH)
    assert both.where("text is distinct from decoded").count() == 0 and both.count() == len(ODD) + 4
    empty = sentpieces.encode(df.limit(0), PATH)
    assert sentpieces.decode(empty, PATH).count() == 0
    with pytest.raises(Exception, match="outside the vocabulary"):
        sentpieces.decode(spark.createDataFrame([([32_000],)], "ids array<int>"), PATH).collect()
    nothing = spark.createDataFrame([(None, "x"), ([], "x")], "ids array<int>, text string")
    assert [r["text"] for r in sentpieces.decode(nothing, PATH).collect()] == ["", ""]

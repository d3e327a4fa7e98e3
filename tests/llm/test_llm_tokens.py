import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from churnlens.llm import packing, queries, tokenfiles, tokens
from churnlens.llm.packing import Limits, Piece, pack_pieces
from churnlens.llm.text import texts_of
from churnlens.llm.tokens import PieceEncoder, public_vocabulary

#: 1,024 letters and their mirror: alike for any polynomial hash modulo a power of two.
THUE_MORSE = ["".join("ab"[(i.bit_count() + k) % 2] for i in range(1024)) for k in (0, 1)]
ODD = [
    "", "a  b\n\n c   d \t e", "  lead", "trail  ", "x\x1cy z    w", "don't I'm\nwe're", "<|endoftext|> a <|startoftext|>",
    "é é ́x", "a　b c", "a\n  b", "\n  x", "a\x1f\x1f b", " ", "\n", "a\n", "a \n b", "ÀÉ ß İ THE The", "1234 5,6", "\r\n \r\n x",
    "a text <|endoftext|> more", "x<|ENDOFTEXT|>y", "z<|startoftext|><|endoftext|>", "\x00a \x00a\n\x00a", *THUE_MORSE, " ".join(THUE_MORSE),
]
FILES = [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)]


def reference(name):
    t = Tokenizer.from_file(public_vocabulary(name))
    return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("name,spaced", FILES)
@pytest.mark.parametrize("keep", [1_000_000, 3])
def test_pieces_encode_like_whole_texts(spark, data_dir, monkeypatch, name, spaced, keep):
    monkeypatch.setattr(tokens, "KEEP_PIECES", keep)
    texts = ODD + [r["text"] for r in spark.read.parquet(f"{data_dir}/documents.parquet").limit(60).collect()]
    own = PieceEncoder(public_vocabulary(name), spaced)
    want = reference(name)(texts)
    for _ in range(2):
        for i in range(0, len(texts), 20):
            ids, counts = own.encode(texts_of(pa.array(texts[i : i + 20])))
            assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want[i : i + 20]
    assert own.encode(texts_of(pa.array([], pa.string())))[1].tolist() == []


@pytest.mark.parametrize("name,spaced", FILES)
def test_words_that_share_a_hash_keep_their_own_ids(monkeypatch, name, spaced):
    def few(texts, fold=True, words_of=tokens.words_of):
        words = words_of(texts, fold)
        words.hashes %= np.uint64(7)
        return words

    monkeypatch.setattr(tokens, "words_of", few)
    texts = ODD + ["one two three four five", "six seven", "", "eight nine ten eleven"]
    own = PieceEncoder(public_vocabulary(name), spaced)
    for _ in range(2):
        ids, counts = own.encode(texts_of(pa.array(texts)))
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == reference(name)(texts)


def test_ranks_round_trip():
    rng = np.random.default_rng(1)
    counts = np.array([0, 1, 4, 5, 0, 1_000, 3])
    ranks = rng.integers(0, 1 << rng.integers(1, 33, counts.sum()), dtype=np.int64).astype(np.uint32)
    control, data = tokenfiles.encode_ranks(ranks, counts)
    assert (tokenfiles.decode_ranks(control, data, counts) == ranks).all()
    small, _ = tokenfiles.encode_ranks(np.arange(256, dtype=np.uint32), np.array([256]))
    assert len(small[0]) == 64
    assert len(tokenfiles.decode_ranks([], [], np.zeros(0, np.int64))) == 0


def check_files(rows, got):
    want = reference("byte_bpe_50k.json")([t or "" for _, t in rows])
    ids = {i: np.array([*w, 2], "<u4") for (i, _), w in zip(rows, want)}
    begin = 0
    for i in sorted(ids, key=lambda x: (x is not None, x)):
        r = got[i]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (begin, len(ids[i]), zlib.crc32(ids[i].tobytes()))
        begin += len(ids[i])


def test_token_files(spark, data_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfiles, "PART_TOKENS", 20_000)  # several part files
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{data_dir}/documents.parquet").collect()]
    check_files(rows, {r["doc_id"]: r for r in queries.QUERIES["op8_token_ids"](spark, data_dir).collect()})
    odd = [*enumerate(ODD), (None, "no id"), (100, None), (101, "long " * 200_000)]
    df = spark.createDataFrame([(*r, 7) for r in odd], "doc_id long, text string, part int")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    check_files(odd, {r["doc_id"]: r for r in queries.QUERIES["op8_token_ids"](spark, str(tmp_path)).collect()})
    assert tokenfiles.token_ids(df.limit(0), public_vocabulary("byte_bpe_50k.json"), 2).count() == 0


# -- packing ------------------------------------------------------------------------------


def check_packed(rows, ids, limits):
    """Every id in one piece, sequences without gaps and within limits; returns the padding."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(ids)
    for i, pieces in by_doc.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids[i])
            at += p["length"]
            assert p["ids_crc32"] == zlib.crc32(ids[i][p["start"] : at].tobytes())
        assert at == len(ids[i])
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= limits.tokens and len(pieces) <= limits.segments
        padding += 0 if at & (at - 1) == 0 else limits.tokens - at
    return padding


def test_packing(spark, data_dir, tmp_path):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{data_dir}/documents.parquet").collect()]
    encode = reference("word_bpe_49k.json")
    ids = lambda rows: {i: np.array([*w, 1], "<u4") for (i, _), w in zip(rows, encode([t or "" for _, t in rows]))}
    assert check_packed(queries.QUERIES["op2_packing"](spark, data_dir).collect(), ids(rows), Limits()) == 0
    odd = [*enumerate(ODD), (None, None), (101, "long " * 100_000)]
    df = spark.createDataFrame([(*r, "x") for r in odd], "doc_id long, text string, start string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    assert check_packed(queries.QUERIES["op2_packing"](spark, str(tmp_path)).collect(), ids(odd), Limits()) == 0
    assert packing.pack(df.limit(0), public_vocabulary("word_bpe_49k.json"), 1).count() == 0


@pytest.mark.parametrize("limits", [Limits(), Limits(64, 3, 64), Limits(64, 100, 20), Limits(64, 2, 9)])
@pytest.mark.parametrize("last", [True, False])
def test_three_limits_at_once(limits, last):
    rng = np.random.default_rng(2)
    pieces = [Piece(i, 0, int(n), int(rng.integers(0, n + 1))) for i, n in enumerate(rng.integers(1, 200, 150))]
    done, opened = pack_pieces(list(pieces), limits, last)
    assert not (last and opened)
    placed = [p for s in done for p in s] + opened
    for p in pieces:
        at = 0
        for q in sorted((q for q in placed if q.doc == p.doc), key=lambda q: q.start):
            assert q.start == at and q.free == p.free
            at += q.length
        assert at == p.length
    for s in done:
        assert sum(p.length for p in s) <= limits.tokens
        assert len(s) <= limits.segments and sum(p.loss for p in s) <= limits.loss
    if limits == Limits(64, 100, 20):
        full = sum(sum(p.length for p in s) == 64 or sum(p.loss for p in s) == 20 for s in done)
        assert full >= len(done) - 8


def test_many_tiny_pieces_take_time_in_proportion():
    pieces = [Piece(i, 0, 1 + i % 2, 0) for i in range(200_000)]
    start = time.process_time()
    done, _ = pack_pieces(pieces, Limits(), True)
    assert time.process_time() - start < 60
    assert sum(len(s) for s in done) == len({p.doc for s in done for p in s}) == 200_000
    assert max(len(s) for s in done) == 512


def test_prompts_without_loss(spark, data_dir):
    """Conversations whose first turn bears no loss, under limits of which each binds."""
    turns = spark.read.parquet(f"{data_dir}/conversations.parquet")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda t: t["text"]), " ")
    docs = turns.groupBy(F.col("conv_id").alias("doc_id")).agg(
        text.alias("text"), F.max(F.when(F.col("turn") == 0, F.size(F.split("text", " ")))).alias("prompt")
    )
    docs = docs.union(spark.createDataFrame([(10_000 + i, "a", 0) for i in range(40)], "doc_id long, text string, prompt int"))
    limits = Limits(2048, 12, 500)
    rows = docs.collect()
    encode = reference("word_bpe_49k.json")
    ids = {r["doc_id"]: np.array([*w, 1], "<u4") for r, w in zip(rows, encode([r["text"] for r in rows]))}
    free = {r["doc_id"]: r["prompt"] for r in rows}
    packed = packing.pack(docs.coalesce(1), public_vocabulary("word_bpe_49k.json"), 1, limits, silent_col="prompt")
    pieces = packed.withColumn("ids_crc32", F.crc32("ids")).collect()
    check_packed(pieces, ids, limits)
    loss = {}
    for p in pieces:
        own = p["start"] + p["length"] - max(p["start"], min(free[p["doc_id"]], p["start"] + p["length"]))
        loss.setdefault(p["sequence_id"], []).append(own)
    assert max(map(sum, loss.values())) == 500 and max(map(len, loss.values())) == 12


def test_limits_must_be_positive(spark):
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, "a")], "doc_id long, text string"), "x", 1, Limits(tokens=0))


def test_new_pieces_are_encoded_in_runs_with_the_ids_of_whole_texts():
    path = tokens.public_vocabulary("byte_bpe_50k.json")
    encoder = tokens.PieceEncoder(path, spaced=True)
    single, plain = [], encoder._encoded
    encoder._encoded = lambda pieces: single.extend(pieces) or plain(pieces)
    texts = [" ".join(f"w{i * j}é-{j}日" for j in range(1, 90)) + "\nnew don't 12'3" for i in range(20)] + ["", "a", "b\nc"]
    ids, counts = encoder.encode(texts_of(pa.array(texts)))
    wanted = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == [len(w) for w in wanted] and ids.tolist() == sum(wanted, [])
    assert len(single) < 30 < encoder.table.count  # the first word of a text, and no other


def test_a_run_whose_ids_do_not_end_with_its_pieces_is_encoded_piece_by_piece():
    encoder = tokens.PieceEncoder(tokens.public_vocabulary("byte_bpe_50k.json"), spaced=True)
    pieces = [b" one", b"\0two", b" three"]
    wanted = [r.tolist() for r in encoder._encoded([" one", "two", " three"])]
    assert [r.tolist() for r in encoder._encoded_in_runs(pieces)] == wanted
    encoder.bytes_of = encoder.bytes_of + 1
    assert [r.tolist() for r in encoder._encoded_in_runs(pieces)] == wanted


def test_frequent_pieces_stay_and_few_are_remembered():
    """A task that has met more pieces than it keeps still knows the most frequent ones."""
    own = PieceEncoder(public_vocabulary("word_bpe_49k.json"), False, keep=100)
    often = " ".join(["alpha beta gamma"] * 50)
    for i in range(40):
        ids, _ = own.encode(texts_of(pa.array([often + " " + " ".join(f"w{i}x{j} w{i}x{j}" for j in range(30))])))
        assert own.table.count <= 100 + 33
    assert ids.tolist() == reference("word_bpe_49k.json")([often + " " + " ".join(f"w39x{j} w39x{j}" for j in range(30))])[0]
    kept = {own.raw.get(np.array([i])).tobytes() for i in range(own.table.count)}
    assert {b"alpha", b"beta", b"gamma"} <= kept


def test_packing_remembers_few_pieces():
    from churnlens.llm import packing

    assert packing.KEEP_PIECES <= 400_000 < tokens.KEEP_PIECES
    assert tokens.encoder(public_vocabulary("word_bpe_49k.json"), False, packing.KEEP_PIECES)._most() >= 1

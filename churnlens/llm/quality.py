"""Quality scores: random-indexing word vectors pooled per document, then a two-layer network.

Words fall into a fixed number of buckets, each with a sparse ternary index vector. A word's
vector is the sum of the index vectors of its neighbours over the whole corpus, gathered in the
tasks as one small matrix of integers. A document is the mean and the spread of its words'
vectors. The network is trained in numpy on a bounded sample of labelled documents; a
temperature fitted on documents set aside calibrates its probabilities.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .text import joined, mix64, slices, texts_of

BUCKETS = 1 << 14
DIM = 64
NONZERO = 4
REACH = 2  # neighbours on either side
HIDDEN = 32
SAMPLE_ROWS = 8_000
_SLICE = 1 << 19
_ROWS_PER_BLOCK = 1 << 10
_U64 = np.uint64

_rng = np.random.default_rng(1_234)
_PLACE = np.argsort(_rng.random((BUCKETS, DIM)), axis=1)[:, :NONZERO]
_SIGN = _rng.choice([-1.0, 1.0], (BUCKETS, NONZERO))

_KIND = np.full(256, 3, np.uint8)  # 0 white space, 1 letters, 2 digits, 3 the rest
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[48:58] = 2
_BYTE = mix64(np.arange(7, 263, dtype=_U64))
_POWERS = np.full(1 << 21, 0x9E3779B97F4A7C15, _U64)
_POWERS[0] = 1
np.multiply.accumulate(_POWERS, out=_POWERS)


def word_buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words of all texts (runs of letters, of digits, or of other signs; case
    counts), and where each text's begin (and the end)."""
    data, offsets = joined(texts)
    kind = np.concatenate([[0], _KIND[data], [0]])
    change = np.flatnonzero(kind[1:] != kind[:-1])
    starts, ends = change[:-1], change[1:]
    some = kind[starts + 1] > 0
    starts, ends = starts[some], ends[some]
    # The sum of byte values weighted by their place from the word's start; long words wrap.
    place = np.arange(len(data)) - np.repeat(np.concatenate([[0], change]), np.diff(np.concatenate([[0], change, [len(data)]])))
    sums = np.zeros(len(data) + 1, _U64)
    np.cumsum(_BYTE[data] * _POWERS[place % len(_POWERS)], out=sums[1:])
    hashes = np.where(kind[starts + 1] == 2, _U64(2), sums[ends] - sums[starts])
    return (mix64(hashes) % _U64(BUCKETS)).astype(np.int64), np.searchsorted(starts, offsets)


# -- word vectors -------------------------------------------------------------------------


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of neighbours' index vectors over the documents of a task."""
    total = np.zeros(BUCKETS * DIM)
    for batch in batches:
        for part in slices(batch, "text", _SLICE):
            words, first = word_buckets(texts_of(part.column("text")))
            doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
            for step in range(1, REACH + 1):
                same = doc[step:] == doc[:-step]
                a, b = words[:-step][same], words[step:][same]
                for x, y in ((a, b), (b, a)):
                    at = (x * DIM)[:, None] + _PLACE[y]
                    total += np.bincount(at.ravel(), _SIGN[y].ravel(), BUCKETS * DIM)
    yield from _blocks(total)


def _blocks(total: np.ndarray) -> Iterator[pa.RecordBatch]:
    rows = total.astype(np.int64).reshape(-1, _ROWS_PER_BLOCK * DIM)
    some = [i for i, block in enumerate(rows) if block.any()]
    pack = zstandard.ZstdCompressor(level=1).compress
    sums = [pack((r if abs(r).max() >> 31 else r.astype(np.int32)).tobytes()) for r in rows[some]]
    yield pa.RecordBatch.from_pydict({"block": pa.array(some, pa.int32()), "sums": pa.array(sums, pa.binary())})


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((BUCKETS // _ROWS_PER_BLOCK, _ROWS_PER_BLOCK * DIM))
    size = total.shape[1]
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for block, sums in zip(*(c.to_pylist() for c in batch.columns)):
            raw = unpack(sums)
            total[block] += np.frombuffer(raw, np.int32 if len(raw) == 4 * size else np.int64)
    yield from _blocks(total.ravel())


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """(BUCKETS, DIM) unit vectors, less their mean, from all texts of ``docs``. Each task sends one
    compressed matrix of fixed size; a bucket that no word falls into is zero."""
    parts = docs.select(F.col(text).alias("text")).mapInArrow(_gather, "block int, sums binary")
    blocks = BUCKETS // _ROWS_PER_BLOCK
    got = parts.repartition(blocks, "block").mapInArrow(_add_up, "block int, sums binary").toArrow()
    total = np.zeros((blocks, _ROWS_PER_BLOCK * DIM))
    unpack = zstandard.ZstdDecompressor().decompress
    for block, sums in zip(got.column("block").to_pylist(), got.column("sums").to_pylist()):
        raw = unpack(sums)
        total[block] += np.frombuffer(raw, np.int32 if len(raw) == 4 * total.shape[1] else np.int64)
    vectors = total.reshape(BUCKETS, DIM)
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors = vectors / np.maximum(length, 1)
    used = length[:, 0] > 0
    if used.any():
        vectors[used] -= vectors[used].mean(axis=0)
        vectors[used] /= np.maximum(np.linalg.norm(vectors[used], axis=1, keepdims=True), 1e-9)
    return vectors.astype(np.float32)


def pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """(n, 2 DIM + 1): mean and standard deviation of the words' vectors, and the logarithm of
    the number of words. A text without words is all zero."""
    words, first = word_buckets(texts)
    counts = np.diff(first)
    out = np.zeros((len(counts), 2 * DIM + 1), np.float32)
    some = counts > 0
    if some.any():
        rows = vectors[words]
        n = counts[some, None]
        mean = np.add.reduceat(rows, first[:-1][some], axis=0) / n
        rows *= rows
        square = np.add.reduceat(rows, first[:-1][some], axis=0) / n
        out[some, :DIM] = mean
        out[some, DIM:-1] = np.sqrt(np.maximum(square - mean * mean, 0))
        out[some, -1] = np.log1p(counts[some]) / 10
    return out


# -- the network --------------------------------------------------------------------------


@dataclass
class Network:
    """tanh layer and logistic output over standardised inputs, with a temperature."""

    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -8, 8)
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def fit_network(x: np.ndarray, y: np.ndarray, epochs: int = 60) -> Network:
    """Adam on the cross entropy of four fifths of the rows; the temperature is fitted on the
    rest. Without rows of both labels the score is the share of label 1 (one half without rows)."""
    width = x.shape[1]
    rng = np.random.default_rng(5)
    rate = (y.sum() + 1) / (len(y) + 2)
    net = Network(np.zeros(width), np.ones(width), np.zeros((width, HIDDEN)), np.zeros(HIDDEN),
                  np.zeros(HIDDEN), float(np.log(rate / (1 - rate))), 1.0)
    if len(np.unique(y)) < 2:
        return net
    aside = np.arange(len(x)) % 5 == 4
    if len(np.unique(y[~aside])) < 2:
        aside[:] = False
    xt, yt = x[~aside].astype(np.float64), y[~aside].astype(np.float64)
    net.centre, net.scale = xt.mean(axis=0), xt.std(axis=0) + 1e-3
    z = np.clip((xt - net.centre) / net.scale, -8, 8)
    p = {"w1": rng.normal(0, 1 / np.sqrt(width), (width, HIDDEN)), "b1": np.zeros(HIDDEN),
         "w2": rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), "b2": np.array(net.b2)}
    m, v, step = {k: 0.0 for k in p}, {k: 0.0 for k in p}, 0
    for _ in range(epochs):
        order = rng.permutation(len(z))
        for i in range(0, len(z), 128):
            rows = order[i : i + 128]
            h = np.tanh(z[rows] @ p["w1"] + p["b1"])
            d = 1 / (1 + np.exp(-np.clip(h @ p["w2"] + p["b2"], -40, 40))) - yt[rows]
            d /= len(rows)
            back = np.outer(d, p["w2"]) * (1 - h * h)
            slope = {"w1": z[rows].T @ back + 1e-4 * p["w1"], "b1": back.sum(axis=0), "w2": h.T @ d + 1e-4 * p["w2"], "b2": d.sum()}
            step += 1
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * slope[k]
                v[k] = 0.999 * v[k] + 0.001 * slope[k] ** 2
                p[k] = p[k] - 2e-3 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = p["w1"], p["b1"], p["w2"], float(p["b2"])
    if aside.any():
        logit, truth = net.logits(x[aside]), y[aside]
        tried = np.geomspace(0.25, 8, 61)
        loss = [np.logaddexp(0, np.where(truth == 1, -logit, logit) / t).mean() for t in tried]
        net.temperature = float(tried[int(np.argmin(loss))])
    return net


# -- training and scoring -----------------------------------------------------------------


@dataclass
class QualityModel:
    vectors: np.ndarray
    network: Network


def _pooler(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = model.value
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                x = pooled(texts_of(part.column("text")), vectors)
                rows = pa.array([r.tobytes() for r in x], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("h"), part.column("label"), rows], ["h", "label", "x"])

    return run


def sample_texts(docs: DataFrame, sample: DataFrame, key: str, text: str) -> DataFrame:
    """(h, label, text) of the keys of ``sample`` (key, h, label), one text for each key, chosen in the tasks
    before anything is shuffled."""
    rows = docs.select(key, F.col(text).alias("text")).join(F.broadcast(sample), key)
    one = rows.groupBy(key, "h", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    return one.select("h", "label", "text")


def train(docs: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", text: str = "text",
          label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    """Word vectors from all of ``docs``; the network from at most ``sample_rows`` labelled rows
    for which ``learn`` (over the key) holds, those with the least hash of their key. Null labels
    and keys are left out; a key with several labels takes the least, one with several documents
    the text with the least hash; texts count whole."""
    spark: SparkSession = docs.sparkSession
    vectors = word_vectors(docs, text)
    sample = (
        labels.where(learn & F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(key)
        .agg((F.min(label) >= 1).cast("int").alias("label"))
        .withColumn("h", F.xxhash64(key))
        .orderBy("h")
        .limit(sample_rows)
    )
    rows = sample_texts(docs, sample, key, text)
    got = rows.mapInArrow(_pooler(spark.sparkContext.broadcast(vectors)), "h long, label int, x binary").toArrow()
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), np.float32).reshape(-1, 2 * DIM + 1)
    y = got.column("label").to_numpy()
    order = np.lexsort((x[:, 0], got.column("h").to_numpy()))
    return QualityModel(vectors, fit_network(x[order], y[order]))


def _scorer(model, text: str, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: QualityModel = pickle.loads(model.value)
        for batch in batches:
            for part in slices(batch, text, _SLICE):
                p = known.network.probabilities(pooled(texts_of(part.column(text)), known.vectors))
                made = {"score": pa.array(p, pa.float64()), "predicted": pa.array((p >= 0.5).astype(np.int32))}
                yield pa.RecordBatch.from_pydict({c: made[c] if c in made else part.column(c) for c in columns})

    return run


def score(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``score`` (0 to 1, higher: better) and ``predicted`` (1 if the
    score is at least one half). Columns of these names in the input are replaced. Only the text
    decides: equal texts score alike up to rounding, null and empty texts like a text without words."""
    docs = docs.drop("score", "predicted")
    schema = docs.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)}).schema
    for field in schema.fields:
        field.nullable = True
    blob = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    return docs.mapInArrow(_scorer(blob, text, schema.fieldNames()), schema)

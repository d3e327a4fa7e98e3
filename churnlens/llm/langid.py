"""Language identification by error-correcting output codes.

Each language has a codeword. One binary classifier per bit, over hashed character n-grams of
the whole text, predicts that bit; decoding adds up each classifier's logistic loss, weighted by
how well it did on documents set aside, and takes the nearest codeword. Documents whose two
nearest codewords are about equally far, as measured by documents set aside that were thinned out
to the same length, are flagged as ambiguous.
"""

from __future__ import annotations

import math
import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F

from .text import joined, slices, texts_of

FEATURES = 1 << 12
DOCS_PER_LANGUAGE = 500
_SAMPLE_PARTS = 64
UNKNOWN = "und"
#: A document is ambiguous if its two least losses differ by less than this share of the
#: difference that is usual at its length.
CLEAR_SHARE = 0.25
_LETTER = regex.compile(r"\p{L}")
_U32 = np.uint32
_ROWS = 256  # a row of counts each


def ngram_counts(texts: pa.Array) -> np.ndarray:
    """Hashed counts of the 1- to 3-byte grams of each text in lower case, (n, FEATURES)."""
    lowered = pa.array([t.lower() for t in texts.to_pylist()], pa.large_string())
    data, offsets = joined(lowered)
    n = len(texts)
    doc = np.repeat(np.arange(n, dtype=np.int64) * FEATURES, np.diff(offsets))
    code = data.astype(_U32)
    out = np.zeros(n * FEATURES)
    for _ in range(3):
        slot = ((code * _U32(0x9E3779B1)) >> _U32(20)).astype(np.int64)
        out += np.bincount(doc[: len(slot)] + slot, minlength=n * FEATURES)
        code = code[:-1] * _U32(0x01000193) + data[len(data) - len(code) + 1 :] if len(code) > 1 else code[:0]
    return out.reshape(n, FEATURES)


def features(counts: np.ndarray) -> np.ndarray:
    """Square roots of relative frequencies: unit length, whatever the length of the text."""
    share = counts.astype(np.float32)
    share /= np.maximum(counts.sum(axis=1, keepdims=True), 1).astype(np.float32)
    return np.sqrt(share, out=share)


def codewords(languages: int) -> np.ndarray:
    """One row of +1 / -1 per language, no two alike and no column constant.

    Up to 5 languages take all distinct splits in two; more take the best of several random
    codes by least distance between rows.
    """
    if languages <= 5:
        splits = [s for s in range(1, 1 << (languages - 1))] or [0]
        return np.array([[1 if s >> k & 1 else -1 for s in splits] for k in range(languages)])
    rng, bits = np.random.default_rng(7), max(15, 6 * math.ceil(math.log2(languages)))
    best, apart = None, -1
    for _ in range(200):
        code = rng.choice([-1, 1], (languages, bits))
        far = (bits - code @ code.T) // 2
        far[np.diag_indices(languages)] = bits
        if far.min() > apart and (np.abs(code.sum(axis=0)) < languages).all():
            best, apart = code, far.min()
    return best


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray  # (languages, bits)
    weights: np.ndarray  # (FEATURES + 1, bits)
    trust: np.ndarray  # (bits,), sums to 1
    usual: np.ndarray  # usual difference of the two least losses at 1, 2, 4, ... n-grams

    def losses(self, counts: np.ndarray) -> np.ndarray:
        """(n, languages)"""
        margins = features(counts) @ self.weights[:-1] + self.weights[-1]
        return np.logaddexp(0, -margins[:, None, :] * self.code) @ self.trust

    def gaps(self, counts: np.ndarray) -> np.ndarray:
        """(n,) differences of the two least losses; infinite where there are no two languages."""
        if len(self.languages) < 2:
            return np.full(len(counts), np.inf)
        least = np.partition(self.losses(counts), 1, axis=1)
        return least[:, 1] - least[:, 0]

    def torn(self, counts: np.ndarray) -> np.ndarray:
        """Whether each document is between two languages."""
        length = np.log2(np.maximum(counts.sum(axis=1), 1))
        return self.gaps(counts) < CLEAR_SHARE * np.interp(length, np.arange(len(self.usual)), self.usual)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """(n, languages), rows sum to 1."""
        if not self.languages:
            return np.zeros((len(counts), 0))
        loss = self.losses(counts)
        near = np.exp((loss.min(axis=1, keepdims=True) - loss) * self.code.shape[1])
        return near / near.sum(axis=1, keepdims=True)


def fit(counts: np.ndarray, labels: list[str], rounds: int = 300) -> LanguageModel:
    """One logistic classifier per bit (all bits at once), then its trust from documents that
    were set aside. No labelled row gives a model that knows no language."""
    languages = sorted(set(labels))
    if not languages:
        return LanguageModel([], np.zeros((0, 1)), np.zeros((FEATURES + 1, 1)), np.ones(1), np.zeros(1))
    code = codewords(len(languages))
    x = features(counts)
    y = code[np.searchsorted(languages, labels)]
    aside = np.arange(len(x)) % 5 == 4
    if len(languages) == 1 or (~aside).sum() == 0:
        aside[:] = False
    class_size = np.bincount(np.searchsorted(languages, labels), minlength=len(languages))
    weight = (1 / class_size)[np.searchsorted(languages, labels)]
    weight = (weight[~aside, None] / weight[~aside].sum()).astype(np.float32)
    xt, yt = x[~aside], y[~aside].astype(np.float32)
    w, b = np.zeros((FEATURES, y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    mw, mb, step = np.zeros_like(w), np.zeros_like(b), 20.0
    for _ in range(rounds):
        pull = weight * yt / (1 + np.exp(np.clip(yt * (xt @ (w + 0.9 * mw) + b + 0.9 * mb), -60, 60)))
        mw = 0.9 * mw + step * (xt.T @ pull - 1e-5 * w)
        mb = 0.9 * mb + step * 0.1 * pull.sum(axis=0)
        w, b = w + mw, b + mb
    trust = np.ones(y.shape[1])
    if aside.any():
        right = ((x[aside] @ w + b) * y[aside] > 0).mean(axis=0)
        trust = np.maximum(right - 0.5, 0.01)
    model = LanguageModel(languages, code, np.vstack([w, b]).astype(np.float32), trust / trust.sum(), np.zeros(1))
    model.usual = usual_gaps(model, counts[aside] if aside.any() else counts)
    return model


def usual_gaps(model: LanguageModel, counts: np.ndarray) -> np.ndarray:
    """The median gap of documents at 1, 2, 4, ... n-grams: each is thinned out at random to every
    one of these lengths that it reaches."""
    rng, total, usual = np.random.default_rng(11), counts.sum(axis=1), []
    while (long := total >= 1 << len(usual)).any() and len(model.languages) > 1:
        thinned = rng.binomial(counts[long].astype(np.int64), ((1 << len(usual)) / total[long])[:, None])
        usual.append(np.median(model.gaps(thinned)))
    return np.array(usual or [0.0])


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", max_rows=_ROWS):
            counts = ngram_counts(texts_of(part.column("text"))).astype(np.uint32)
            yield pa.RecordBatch.from_pydict(
                {"lang": part.column("lang"), "counts": pa.array([zlib.compress(c.tobytes(), 1) for c in counts], pa.binary())}
            )


def labelled_sample(docs: DataFrame, learn: Column, text: str, label: str, key: str, per_language: int) -> DataFrame:
    """(lang, text) of at most ``per_language`` rows of each language: those with the least hashes
    of key and text, rows that are alike in all three counting once."""
    rows = docs.where(learn & F.col(label).isNotNull() & F.col(text).rlike(r"\p{L}")).select(
        F.col(label).cast("string").alias("lang"),
        F.struct(F.xxhash64(key).alias("key"), F.xxhash64(text).alias("text")).alias("h"),
        F.col(text).alias("text"),
    )
    # Hashes first, so that no text is shuffled to find the sample; first the least of each of some parts,
    # so that what meets in one task does not grow with the table.
    least = rows.select("lang", "h").distinct().withColumn("part", F.pmod("h.key", F.lit(_SAMPLE_PARTS)))
    for groups in (["lang", "part"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*groups).orderBy("h"))
        least = least.withColumn("rank", rank).where(F.col("rank") <= per_language)
    last = least.groupBy("lang").agg(F.max("h").alias("last"))
    chosen = rows.join(F.broadcast(last), "lang").where("h <= last")
    return chosen.groupBy("lang", "h").agg(F.first("text").alias("text")).select("lang", "text")


def train(docs: DataFrame, learn: Column, text: str = "text", label: str = "lang", key: str = "doc_id",
          per_language: int = DOCS_PER_LANGUAGE) -> LanguageModel:
    """Fits the classifiers on at most ``per_language`` labelled rows of each language, those
    with the least hashes of key and text among the rows where ``learn`` holds, also where keys are
    null or repeated; rows with a null label or a text without letters are left out. Texts count
    whole. A label is any string."""
    sample = labelled_sample(docs, learn, text, label, key, per_language)
    # Most counts are zero, so they travel compressed.
    got = [(zlib.decompress(r["counts"]), r["lang"]) for r in sample.mapInArrow(_counter, "lang string, counts binary").collect()]
    got.sort()
    counts, labels = np.empty((len(got), FEATURES), np.uint32), [label for _, label in got]
    for i in range(len(got)):
        counts[i] = np.frombuffer(got[i][0], np.uint32)
        got[i] = None
    return fit(counts, labels)


def _labeller(model, text: str, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: LanguageModel = pickle.loads(model.value)
        for batch in batches:
            for part in slices(batch, text, max_rows=_ROWS):
                texts = texts_of(part.column(text))
                counts = ngram_counts(texts)
                scores = known.scores(counts)
                lettered = np.array([_LETTER.search(t) is not None for t in texts.to_pylist()])
                if scores.shape[1] == 0:
                    best, top = [UNKNOWN] * len(texts), np.zeros(len(texts))
                else:
                    best = [known.languages[i] for i in scores.argmax(axis=1)]
                    top = scores.max(axis=1)
                made = {
                    "lang_pred": pa.array([b if ok else UNKNOWN for b, ok in zip(best, lettered)], pa.string()),
                    "score": pa.array(np.where(lettered, top, 0.0), pa.float64()),
                    "ambiguous": pa.array(~lettered | known.torn(counts), pa.bool_()),
                }
                yield pa.RecordBatch.from_pydict({c: made[c] if c in made else part.column(c) for c in columns})

    return run


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``lang_pred`` (a learned language; ``und`` for a null text, one
    without letters, or a model without languages), ``score`` (0 to 1, 0 for ``und`` by lack of
    letters) and ``ambiguous`` (torn between two languages, or without letters). Columns of these names in the input are replaced; ties go to the
    first language in alphabetical order. Only the text decides."""
    docs = docs.drop("lang_pred", "score", "ambiguous")
    schema = docs.withColumns(
        {"lang_pred": F.lit(""), "score": F.lit(0.0), "ambiguous": F.lit(False)}
    ).schema
    for field in schema.fields:
        field.nullable = True
    blob = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    return docs.mapInArrow(_labeller(blob, text, schema.fieldNames()), schema)

"""Language-model scores: a log-bilinear model trained by noise-contrastive estimation.

Words are counted exactly over the training documents. Every word met at least as often as the
root of the number of tokens, divided by ``WORDS_PER_ROOT``, has vectors of its own; so the vocabulary
grows with the corpus, but never beyond ``WORDS_PER_ROOT`` times that root. Words are put in classes
of about equal mass by falling frequency; the end of a text is a class, and all words below the
least count fall into a fixed number of classes by the look of their bytes, where a word has its share
of the class's count. The vectors of the two words before predict a vector. Its products with the class
vectors give the next class, those with the word vectors of that class the next word, each
normalised over all that compete. Texts are dealt to chunks by a hash, so training doesn't follow the
partitions: each chunk trains from one start, in an order fixed by the hash, and the parameters
are averaged by tokens.

The counts of words reach the documents by hash: a chunk of documents asks the shard of each of
its distinct words once, so a frequent word costs one entry a chunk and no text is shuffled per
word.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .stages import staged
from .text import Words, slices, texts_of, words_of

WORDS_PER_ROOT = 8
RARE = 64
DIM = 32
NOISE = 32
INNER_NOISE = 4
BATCH = 4096
TRAIN_BYTES = 32 << 20
CHUNK_BYTES = 8 << 20
SHARD_WORDS = 1 << 18
_FLUSH_WORDS = 1 << 20
_SEGMENT = 1 << 18
_CONTEXTS = 1_024  # a block of logits stays in the cache
_LONG_RUN = 24  # slopes of a row that are added up apart
_U64 = np.uint64
#: The hash that stands for the end of a text; a word's own hash is never even.
END = _U64(0)

_CLASS_OF_BYTE = np.full(256, 0, np.int64)
_CLASS_OF_BYTE[[ord("."), ord("!"), ord("?")]] = 1
_CLASS_OF_BYTE[[ord(","), ord(";"), ord(":")]] = 2
_CLASS_OF_BYTE[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".!?,;:"]] = 3


def word_hashes(words: Words) -> np.ndarray:
    return words.hashes | _U64(1)


def rare_classes(words: Words) -> np.ndarray:
    """A number below RARE for each word: how it ends, whether it holds bytes beyond ASCII, and
    one of eight groups by its first two bytes. A-Z count as a-z."""
    data, a, b = words.data, words.starts, words.ends
    beyond = np.concatenate([[0], np.cumsum(data >= 128)])
    foreign = beyond[b] > beyond[a]
    lower = np.arange(256, dtype=np.int64)
    lower[65:91] += 32
    second = np.where(b - a > 1, lower[data[np.minimum(a + 1, len(data) - 1)]], 0) if len(a) else a
    group = (lower[data[a]] * 31 + second) * 2_654_435_761 >> 7 & 7
    return foreign * 32 + _CLASS_OF_BYTE[data[b - 1]] * 8 + group


# -- counting -----------------------------------------------------------------------------


def _merge(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    h, kind, n = (np.concatenate(x) for x in zip(*parts))
    words, first, where = np.unique(h, return_index=True, return_inverse=True)
    return words, kind[first], np.bincount(where, n, len(words)).astype(np.int64)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(found) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"h": found[0].view(np.int64), "kind": found[1].astype(np.int32), "n": found[2]})

    parts, size = [], 0
    for batch in batches:
        for part in slices(batch, "text"):
            words = words_of(texts_of(part.column("text")))
            h = np.append(word_hashes(words), END)
            n = np.ones(len(h), np.int64)
            n[-1] = part.num_rows
            parts.append(_merge([(h, np.append(rare_classes(words), -1), n)]))
            size += len(parts[-1][0])
            if size > _FLUSH_WORDS:
                parts = [_merge(parts)]
                size = len(parts[0][0])
                if size > _FLUSH_WORDS // 2:
                    yield rows(parts[0])
                    parts, size = [], 0
    if parts:
        yield rows(_merge(parts))


# -- the model ----------------------------------------------------------------------------


@dataclass
class Model:
    """Symbols 0 .. RARE-1 are the looks of rare words, RARE is the end, then come the words of the
    vocabulary by falling count, and one for the place before a text. The looks and the end are
    classes of their own; the classes behind them are runs of words."""

    hashes: np.ndarray  # of the vocabulary, sorted
    rank: np.ndarray  # of each of these hashes: its place by falling count
    cuts: np.ndarray  # first word of each class of words, and the end
    mass: np.ndarray  # of each look: sum of count + 1 over its words, and 1 for all unknown ones
    context: np.ndarray  # (2 * (symbols + 1), DIM): for the word two places before, then one before
    tops: np.ndarray  # (classes, DIM)
    top_bias: np.ndarray
    words: np.ndarray  # (vocabulary, DIM)
    word_bias: np.ndarray

    def __post_init__(self):
        sizes = np.diff(self.cuts)
        self.symbols = RARE + 1 + len(self.hashes)
        self.classes = RARE + 1 + len(sizes)
        self.kind = np.concatenate([np.arange(RARE + 1), RARE + 1 + np.repeat(np.arange(len(sizes)), sizes)])
        self.lows = np.concatenate([np.zeros(RARE + 1, np.int64), self.cuts[:-1]])
        self.sizes = np.concatenate([np.ones(RARE + 1, np.int64), sizes])

    def values(self) -> np.ndarray:
        """All parameters in one row."""
        return np.concatenate([x.ravel() for x in (self.context, self.tops, self.top_bias, self.words, self.word_bias)])

    def moved(self, by: np.ndarray) -> Model:
        old = (self.context, self.tops, self.top_bias, self.words, self.word_bias)
        parts = np.split(self.values() + by, np.cumsum([x.size for x in old])[:-1])
        new = (x.reshape(o.shape).astype(np.float32) for x, o in zip(parts, old))
        return Model(self.hashes, self.rank, self.cuts, self.mass, *new)

    def symbols_of(self, hashes: np.ndarray, looks: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return looks
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, RARE + 1 + self.rank[at], looks)

    def guess(self, before: np.ndarray, last: np.ndarray) -> np.ndarray:
        return self.context[before] + self.context[self.symbols + 1 + last]

    def log_probabilities(self, tokens: np.ndarray, before: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Natural log-probability of each symbol after the two before it, normalised over classes
        and over the words of its class. Distinct contexts are normalised once."""
        out, kinds = np.empty(len(tokens)), self.kind[tokens]
        pairs = before * (self.symbols + 1) + last
        sort = np.argsort(pairs, kind="stable")
        pairs = pairs[sort]
        new = np.concatenate([np.ones(min(1, len(pairs)), bool), pairs[1:] != pairs[:-1]])
        context, where = pairs[new], np.cumsum(new) - 1
        bounds = np.searchsorted(where, np.arange(0, len(context) + _CONTEXTS, _CONTEXTS))
        for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
            own, at = context[i * _CONTEXTS : (i + 1) * _CONTEXTS], sort[a:b]
            guess = self.guess(own // (self.symbols + 1), own % (self.symbols + 1))
            logits = guess @ self.tops.T
            logits += self.top_bias
            row = where[a:b] - i * _CONTEXTS
            out[at] = logits[row, kinds[at]] - _log_sums(logits)[row]
        inner = np.flatnonzero(self.sizes[kinds] > 1)
        inner = inner[np.argsort(_short(kinds[inner], self.classes), kind="stable")]
        edges = np.flatnonzero(np.diff(kinds[inner], prepend=-1, append=-1))
        for a, b in zip(edges[:-1], edges[1:]):
            low = self.lows[kinds[inner[a]]]
            high = low + self.sizes[kinds[inner[a]]]
            for i in range(a, b, _CONTEXTS):
                at = inner[i : min(i + _CONTEXTS, b)]
                logits = self.guess(before[at], last[at]) @ self.words[low:high].T
                logits += self.word_bias[low:high]
                out[at] += logits[np.arange(len(at)), tokens[at] - RARE - 1 - low] - _log_sums(logits)
        return out


def _short(numbers: np.ndarray, below: int) -> np.ndarray:
    """The shorter ones sort faster."""
    return numbers.astype(np.uint16 if below <= 1 << 16 else np.int64)


def _log_sums(logits: np.ndarray) -> np.ndarray:
    most = logits.max(axis=1)
    powers = logits - most[:, None]
    return np.log(np.exp(powers, out=powers).sum(axis=1)) + most


def sequences(words: Words, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbol of each token (each document's words, then its end), the symbols two and one places
    before it, and where each document begins (and the end)."""
    n = words.counts
    ends = np.cumsum(n + 1)
    first = np.concatenate([[0], ends])
    tokens = np.full(int(first[-1]), RARE, np.int64)
    place = np.arange(len(words.hashes)) + words.docs
    tokens[place] = model.symbols_of(word_hashes(words), rare_classes(words))
    start = model.symbols
    last = np.concatenate([[start], tokens[:-1]])[: len(tokens)]
    before = np.concatenate([[start, start], tokens[:-2]])[: len(tokens)]
    last[first[:-1]] = start
    before[first[:-1]] = start
    second = first[:-1] + 1
    before[second[second < first[1:]]] = start
    return tokens, before, last, first


def start_model(hashes: np.ndarray, counts: np.ndarray, looks: np.ndarray, ends: int, mass: np.ndarray) -> Model:
    """Unigram probabilities as biases, small random vectors. ``hashes`` and ``counts`` are those of
    the vocabulary, ``looks`` the counts of the classes of rare words."""
    order = np.lexsort((hashes, -counts))
    n = counts[order].astype(float)
    share = (np.cumsum(n) - n) / max(1.0, n.sum())
    _, cuts = np.unique((share * math.ceil(2 * math.sqrt(len(n)))).astype(np.int64), return_index=True)
    cuts = np.append(cuts, len(n)).astype(np.int64)
    sums = np.add.reduceat(n, cuts[:-1]) if len(n) else n
    classes = np.concatenate([looks, [ends], sums]) + 1
    rank = np.empty(len(n), np.int64)
    rank[order] = np.arange(len(n))
    by_hash = np.argsort(hashes)
    rng = np.random.default_rng(3)
    return Model(
        hashes[by_hash],
        rank[by_hash],
        cuts,
        mass,
        rng.normal(0, 0.1, (2 * (RARE + 2 + len(n)), DIM)).astype(np.float32),
        rng.normal(0, 0.1, (len(classes), DIM)).astype(np.float32),
        np.log(classes / classes.sum()).astype(np.float32),
        rng.normal(0, 0.1, (len(n), DIM)).astype(np.float32),
        np.log(n / np.repeat(sums, np.diff(cuts))).astype(np.float32),
    )


def _pulls(good: np.ndarray, bad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far to raise the scores of tokens and to lower those of noise."""
    up, down = np.minimum(good, 30), np.minimum(-bad, 30)
    for x in (up, down):
        np.exp(x, out=x)
        x += 1
    return np.divide(1, up, out=up), np.divide(-1, down, out=down)


class Trainer:
    """Noise-contrastive estimation over batches of tokens: against one set of noise classes a batch,
    drawn by their frequency, and against a few words of a token's own class, drawn evenly. Step sizes
    shrink with the squared gradients met so far."""

    def __init__(self, model: Model, seed: int):
        self.start, self.model = model, model.moved(np.float32(0))
        self.rng = np.random.default_rng(seed)
        p = np.exp(model.top_bias.astype(np.float64))
        self.cumulative, self.log_noise = np.cumsum(p / p.sum()), np.log(NOISE * p / p.sum()).astype(np.float32)
        self.inner_noise = np.log(INNER_NOISE / model.sizes).astype(np.float32)
        self.squares = {k: np.full_like(getattr(model, k), 1e-8) for k in ("context", "tops", "top_bias", "words", "word_bias")}
        self.tokens = 0

    def step(self, tokens: np.ndarray, before: np.ndarray, last: np.ndarray) -> None:
        m, n = self.model, len(tokens)
        kinds, guess = m.kind[tokens], m.guess(before, last)
        noise = np.minimum(np.searchsorted(self.cumulative, self.rng.random(NOISE)), m.classes - 1)
        own = m.tops[kinds]
        good = np.einsum("nd,nd->n", guess, own) + m.top_bias[kinds] - self.log_noise[kinds]
        bad = guess @ m.tops[noise].T + m.top_bias[noise] - self.log_noise[noise]
        up, down = _pulls(good, bad)
        own *= up[:, None]
        d_guess = own + down @ m.tops[noise]
        drawn = np.concatenate([kinds, noise])
        values, weights = np.concatenate([guess, down.T @ guess]), np.concatenate([up, np.ones(NOISE, np.float32)])
        self._move("tops", drawn, values, np.arange(len(drawn)), weights, 0.1, n)
        self._move("top_bias", drawn, np.concatenate([up, down.sum(axis=0)]), None, None, 0.01, n)
        at = np.flatnonzero(m.sizes[kinds] > 1)
        if len(at):
            k, g, word = kinds[at], guess[at], tokens[at] - RARE - 1
            other = m.lows[k][:, None] + (self.rng.random((len(at), INNER_NOISE)) * m.sizes[k][:, None]).astype(np.int64)
            own, others, level = m.words[word], m.words[other], self.inner_noise[k]
            good = np.einsum("nd,nd->n", g, own) + m.word_bias[word] - level
            bad = np.einsum("nkd,nd->nk", others, g) + m.word_bias[other] - level[:, None]
            up, down = _pulls(good, bad)
            d_guess[at] += up[:, None] * own + np.einsum("nk,nkd->nd", down, others)
            drawn = np.concatenate([word, other.ravel()])
            of = np.concatenate([np.arange(len(at)), np.repeat(np.arange(len(at)), INNER_NOISE)])
            weights = np.concatenate([up, down.ravel()])
            self._move("words", drawn, g, of, weights, 0.1, n)
            self._move("word_bias", drawn, weights, None, None, 0.01, n)
        rows = np.concatenate([before, m.symbols + 1 + last])
        self._move("context", rows, d_guess, np.tile(np.arange(n), 2), None, 0.1, n)
        self.tokens += n

    def _move(self, name: str, rows: np.ndarray, values: np.ndarray, of, weights, rate: float, n: int) -> None:
        """Adds up the slopes of each row and moves the rows that have any. A slope is the value at its
        place in ``of``, times its weight, where these are given."""
        squares, table = self.squares[name], getattr(self.model, name)
        order = np.argsort(_short(rows, len(squares)), kind="stable")
        keys = rows[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        if values.ndim == 1:
            slope = np.add.reduceat(values[order], first)
        else:
            runs, slope = _run_sums(values, order if of is None else of[order], None if weights is None else weights[order], first)
            first = first[runs]
        slope /= np.float32(n)
        at = keys[first]
        total = slope * slope
        total += squares[at]
        squares[at] = total
        slope *= np.float32(rate)
        slope /= np.sqrt(total, out=total)
        table[at] += slope


def _run_sums(values: np.ndarray, of: np.ndarray, weights, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs that begin at ``first``, longest first, and of each the sum of its ``values[of] * weights``.
    Runs are mostly short: all take their first row at once, then their second, and so on."""
    sizes = np.diff(first, append=len(of))
    runs = np.argsort(-np.minimum(sizes, _LONG_RUN + 1).astype(np.int8), kind="stable")
    begins, sizes = first[runs], sizes[runs]
    long = int(np.count_nonzero(sizes > _LONG_RUN))
    out = np.empty((len(runs), values.shape[1]), values.dtype)
    for i, (a, size) in enumerate(zip(begins[:long].tolist(), sizes[:long].tolist())):
        rows = values[of[a : a + size]]
        out[i] = rows.sum(axis=0) if weights is None else weights[a : a + size] @ rows
    for turn in range(int(sizes[long]) if long < len(sizes) else 0):
        at = begins[long : len(sizes) if not turn else long + int(np.count_nonzero(sizes[long:] > turn))] + turn
        rows = values[of[at]]
        if weights is not None:
            rows *= weights[at][:, None]
        if turn:
            out[long : long + len(at)] += rows
        else:
            out[long:] = rows
    return runs, out


def _trainer(start):
    """Trains on one chunk; the result is how far it moved the parameters, times its tokens."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        trainer = Trainer(pickle.loads(start.value), key[0].as_py())
        rows = rows.sort_by("h")
        for batch in rows.select(["text"]).to_batches():
            for part in slices(batch, "text"):
                tokens, before, last, _ = sequences(words_of(texts_of(part.column("text"))), trainer.model)
                order = trainer.rng.permutation(len(tokens))
                for i in range(0, len(order), BATCH):
                    at = order[i : i + BATCH]
                    trainer.step(tokens[at], before[at], last[at])
        moved = np.float32(trainer.tokens) * (trainer.model.values() - trainer.start.values())
        parts = [moved[i : i + _SEGMENT].tobytes() for i in range(0, len(moved), _SEGMENT)]
        return pa.table(
            {"segment": pa.array(range(len(parts)), pa.int32()), "tokens": [trainer.tokens] * len(parts), "sums": pa.array(parts, pa.binary())}
        )

    return run


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of each segment of the parameters."""
    tokens: dict[int, int] = {}
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, n, blob in zip(*(batch.column(c).to_pylist() for c in ("segment", "tokens", "sums"))):
            values = np.frombuffer(blob, np.float32)
            tokens[k], sums[k] = tokens.get(k, 0) + n, sums[k] + values if k in sums else values
    for k in sorted(sums):
        yield pa.RecordBatch.from_pydict(
            {"segment": pa.array([k], pa.int32()), "tokens": [tokens[k]], "sums": pa.array([sums[k].tobytes()], pa.binary())}
        )


@dataclass
class Trained:
    model: Model
    counts: DataFrame  # h, n
    tokens: int
    words: int


def train(texts: DataFrame) -> Trained:
    """Counts and model from all rows of ``texts`` (``text``, and ``key``, a hash that deals them to
    chunks and orders them); a null text is an empty one. Without rows every word is unknown and
    all classes are alike.

    A chunk holds about TRAIN_BYTES. A task trains one chunk after the other and sends on one sum; the
    number of tasks grows with the root of that of chunks once there are many, so that what is sent
    stays small beside the texts. The driver gets the vocabulary and one set of parameters."""
    counted = texts.select("text").mapInArrow(_count_words, "h long, kind int, n long").groupBy("h")
    counts = staged(counted.agg(F.min("kind").alias("kind"), F.sum("n").alias("n")), "lbl-counts")
    totals = counts.agg(F.count("*").alias("words"), F.sum("n").alias("tokens")).first()
    least = max(2, math.ceil(math.sqrt(totals["tokens"] or 0) / WORDS_PER_ROOT))
    own = (F.col("kind") >= 0) & (F.col("n") >= least)
    found = counts.where(own).select("h", "n").toArrow()
    by_kind = {
        r["kind"]: r for r in counts.where(~own).groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()
    }
    looks = np.array([by_kind[k]["n"] if k in by_kind else 0 for k in range(RARE)], float)
    mass = looks + np.array([by_kind[k]["words"] if k in by_kind else 0 for k in range(RARE)], float) + 1
    ends = by_kind[-1]["n"] if -1 in by_kind else 0
    start = start_model(found.column("h").to_numpy().view(_U64), found.column("n").to_numpy(), looks, ends, mass)
    spark = texts.sparkSession
    size = texts.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    chunks = max(1, math.ceil(size / TRAIN_BYTES))
    tasks = min(chunks, 64 + math.ceil(8 * math.sqrt(chunks)))
    blob = spark.sparkContext.broadcast(pickle.dumps(start))
    kind = "segment int, tokens long, sums binary"
    dealt = texts.select(F.pmod("key", F.lit(chunks)).alias("chunk"), F.col("key").alias("h"), "text").repartition(tasks, "chunk")
    moved = dealt.groupBy("chunk").applyInArrow(_trainer(blob), kind).mapInArrow(_add_up, kind)
    segments = math.ceil(len(start.values()) / _SEGMENT)
    got = moved.repartition(segments, "segment").mapInArrow(_add_up, kind).toArrow().sort_by("segment")
    if got.num_rows:
        total = np.concatenate([np.frombuffer(s, np.float32) for s in got.column("sums").to_pylist()])
        start = start.moved(total / max(1, got.column("tokens")[0].as_py()))
    return Trained(start, counts.select("h", "n"), totals["tokens"] or 0, totals["words"])


# -- scoring ------------------------------------------------------------------------------


def _shard_rows(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.assign(h=rows["h"].to_numpy().view(_U64)).sort_values("h")
    blob = pickle.dumps((rows["h"].to_numpy(), rows["n"].to_numpy()), protocol=5)
    return pd.DataFrame({"shard": [key[0]], "kind": [0], "chunk": [None], "blob": [blob]})


def _asked(bits: int):
    """Each chunk's distinct word hashes in ascending order, a row per shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                words = words_of(texts_of(part.column("text")))
                chunk = part.column("chunk").to_numpy()
                of = chunk[words.docs]
                for c in np.unique(chunk).tolist():
                    found.setdefault(c, [np.array([END])]).append(np.unique(word_hashes(words)[of == c]))
                    if len(found[c]) > 16:
                        found[c] = [np.unique(np.concatenate(found[c]))]
        for c, parts in found.items():
            h = np.unique(np.concatenate(parts))
            shard = (h >> _U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)
            cuts = np.flatnonzero(np.diff(shard, prepend=-1, append=-1)).tolist()
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([int(shard[a]) for a in cuts[:-1]], pa.int64()),
                    "kind": pa.array([1] * (len(cuts) - 1), pa.int32()),
                    "chunk": pa.array([c] * (len(cuts) - 1), pa.int64()),
                    "blob": pa.array([h[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                }
            )

    return run


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of the hashes asked for, 0 for a word that is not in the shard."""
    own, hashes, counts = None, None, None
    for batch in batches:
        chunks, shards, blobs = [], [], []
        for shard, kind, chunk, blob in zip(*(c.to_pylist() for c in batch.columns)):
            if kind == 0:
                own, (hashes, counts) = shard, pickle.loads(blob)
                continue
            asked = np.frombuffer(blob, _U64)
            out = np.zeros(len(asked), np.int64)
            if own == shard and len(hashes):
                at = np.minimum(np.searchsorted(hashes, asked), len(hashes) - 1)
                out = np.where(hashes[at] == asked, counts[at], 0)
            narrow = np.min_scalar_type(int(out.max(initial=0)))
            chunks.append(chunk)
            shards.append(shard)
            blobs.append(bytes([narrow.itemsize]) + out.astype(narrow).tobytes())
        yield pa.RecordBatch.from_pydict(
            {"chunk": pa.array(chunks, pa.int64()), "shard": pa.array(shards, pa.int64()), "blob": pa.array(blobs, pa.binary())}
        )


def _scorer(model, tokens: int, vocabulary: int):
    log_total = math.log10(tokens + vocabulary + 1)

    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        known: Model = pickle.loads(model.value)
        order = np.argsort(told.column("shard").to_numpy(), kind="stable")
        blobs = told.column("blob").to_pylist()
        counts = [np.frombuffer(blobs[i], np.dtype(f"u{blobs[i][0]}"), offset=1).astype(np.float64) for i in order]
        counts = np.concatenate(counts) if counts else np.zeros(0)
        parts = [p for b in docs.select(["id", "text", "held_out"]).to_batches() for p in slices(b, "text")]
        words = [words_of(texts_of(p.column("text"))) for p in parts]
        distinct = np.unique(np.concatenate([np.array([END]), *[word_hashes(w) for w in words]]))
        assert len(distinct) == len(counts), "the counts do not belong to this chunk"
        return pa.Table.from_batches([score(p, w, distinct, counts, known) for p, w in zip(parts, words)], _RESULT)

    def score(part: pa.RecordBatch, words: Words, distinct: np.ndarray, counts: np.ndarray, known: Model) -> pa.RecordBatch:
        kinds, before, last, first = sequences(words, known)
        n = np.full(len(kinds), counts[0])  # of the end, the least hash
        n[np.arange(len(words.hashes)) + words.docs] = counts[np.searchsorted(distinct, word_hashes(words))]
        logs = known.log_probabilities(kinds, before, last) / math.log(10)
        rare = kinds < RARE
        logs[rare] += np.log10((n[rare] + 1) / known.mass[kinds[rare]])
        begins = first[:-1]
        return pa.RecordBatch.from_arrays(
            [
                part.column("id"),
                part.column("held_out"),
                pa.array(np.diff(first)),
                pa.array(np.add.reduceat((n > 0).astype(np.int64), begins)),
                pa.array([tokens] * len(begins), pa.int64()),
                pa.array(np.add.reduceat(np.log10(n + 1) - log_total, begins)),
                pa.array(np.add.reduceat(logs, begins)),
            ],
            schema=_RESULT,
        )

    return run


_RESULT = pa.schema(
    [
        ("id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
    ]
)


def score_texts(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores every row of ``docs`` with a model learnt from those where ``held_out`` is false.

    Columns: the id, ``held_out``, ``n_tokens`` (words and the end), ``n_known`` (tokens met in
    training), ``train_tokens``, ``base_score`` (unigram with one added to each count, decimal
    logarithm) and ``score`` (the model's decimal log-probability, the same for any partitioning of
    the table up to rounding). Words are runs of bytes other
    than white space, A-Z in lower case, told apart by 64-bit hashes. A null or empty text is its
    end alone; repeated rows are scored, and learnt from, one by one; other columns are ignored;
    an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    learnt = train(rows.where("not held_out").select(F.xxhash64("id", "text").alias("key"), "text"))
    bits = max(0, math.ceil(math.log2(max(1, learnt.words) / SHARD_WORDS)))
    shard = F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0).cast("long")
    kind = "shard long, kind int, chunk long, blob binary"
    index = learnt.counts.withColumn("shard", shard).groupBy("shard").applyInPandas(_shard_rows, kind)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, math.ceil(size / CHUNK_BYTES))
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("id", "text"), F.lit(chunks))).repartition(chunks, "chunk")
    told = (
        index.union(dealt.mapInArrow(_asked(bits), kind))
        .repartition(max(1, 1 << bits), "shard")
        .sortWithinPartitions("shard", "kind")
        .mapInArrow(_told, "chunk long, shard long, blob binary")
    )
    model = spark.sparkContext.broadcast(pickle.dumps(learnt.model))
    scored = dealt.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
        _scorer(model, learnt.tokens, learnt.words),
        "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
    return scored.withColumnRenamed("id", "doc_id")

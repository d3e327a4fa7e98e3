"""Encoding and decoding with a sentencepiece model of the BPE kind, in vectorised merge rounds.

A text is cut wherever no entry of the vocabulary reaches across, so that a cut changes no merge;
what lies between two cuts is a word, and each distinct word of a slice is merged once. All words
of a slice lie in one flat array of symbols. A round finds the least pair rank of each word,
merges every occurrence of it from left to right, and closes the gaps; words without a pair leave
the array. Where a merge brings up a pair that ranks no lower than the one merged, the word's later
occurrences wait for the next round, so the order of merges is that of one merge at a time.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .text import joined, slices, texts_of

ENCODE_BYTES = 1 << 20
SPACE = "▁"
_NONE = np.iinfo(np.int32).max
_POINTS = 0x110000
_BAD_BYTE = "churnlens-each-byte"
codecs.register_error(_BAD_BYTE, lambda e: ("�", e.start + 1))


def _spread(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions begin, begin + 1, ... of each run, one run after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(begins - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


class PieceModel:
    """The vocabulary of a model file as arrays.

    Symbols are piece ids; a character that is no piece is ``size`` plus its code point. Models
    other than BPE with byte fallback, an identity normaliser and a leading space are refused.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        library = SentencePieceProcessor(model_file=path)
        self.size = size = library.get_piece_size()
        every = list(range(size))
        names, scores = library.id_to_piece(every), np.array(library.get_score(every))
        control, is_byte = np.array(library.is_control(every)), np.array(library.is_byte(every))
        of_byte = {int(names[i][3:5], 16): i for i in np.flatnonzero(is_byte).tolist()}
        kinds = control | is_byte | np.array(library.is_unknown(every))
        if len(of_byte) != 256 or any(library.is_unused(every)):
            raise ValueError("the model needs byte fallback and no unused pieces")
        self.byte_ids = np.array([of_byte[b] for b in range(256)], np.int64)
        ranks = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        numbers = {name: i for i, name in enumerate(names) if not kinds[i]}

        self.symbol = size + np.arange(_POINTS, dtype=np.int64)
        letters = sorted({c for name in numbers for c in name})
        self.letter = np.zeros(_POINTS, np.int16 if len(letters) < 1 << 15 else np.int32)
        for k, c in enumerate(letters, 1):
            self.letter[ord(c)] = k
            self.symbol[ord(c)] = numbers.get(c, size + ord(c))
        #: Whether two letters follow each other inside any piece.
        self.inner = np.zeros((len(letters) + 1,) * 2, bool)
        pairs = {}
        for name, number in numbers.items():
            for a, b in zip(name, name[1:]):
                self.inner[self.letter[ord(a)], self.letter[ord(b)]] = True
            for i in range(1, len(name)):
                parts = [numbers.get(x, size + ord(x) if len(x) == 1 else None) for x in (name[:i], name[i:])]
                if None not in parts:
                    pairs[parts[0] * (size + _POINTS) + parts[1]] = number
        self.keys = np.array(sorted(pairs), np.int64)
        self.made = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        self.ranks = ranks[self.made] if len(self.made) else np.zeros(0, np.int32)

        surface = [name.replace(SPACE, " ").encode() for name in names]
        for i in np.flatnonzero(kinds).tolist():
            surface[i] = b"" if control[i] else library.decode([i]).encode()
        for byte, i in of_byte.items():
            surface[i] = bytes([byte])
        self.lengths = np.array([len(s) for s in surface], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.silent = control
        self.spaced = np.array([name.startswith(SPACE) and not k for name, k in zip(names, kinds)])
        probes = ["a  b", " x", "ﬁ Å é 　\t\n", "1 22 333", "", "\U0001f600\u0000 ▁ ͸"]
        ids, counts = self.encode(pa.array(probes, pa.large_string()))
        if [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] != library.encode(probes):
            raise ValueError("the model normalises texts or is not of the BPE kind")

    def pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair of symbols (``_NONE`` if they make no piece), and the piece."""
        wanted = left * (self.size + _POINTS) + right
        at = np.minimum(np.searchsorted(self.keys, wanted), max(len(self.keys) - 1, 0))
        if not len(self.keys):
            return np.full(len(left), _NONE, np.int32), np.zeros(len(left), np.int64)
        found = self.keys[at] == wanted
        return np.where(found, self.ranks[at], _NONE), self.made[at]

    def merge(self, symbols: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all words when no pair is left, word by word, and how many each has."""
        words = len(begins)
        word = np.repeat(np.arange(words), np.diff(np.append(begins, len(symbols))))
        rank, made = np.full(len(symbols), _NONE, np.int32), np.zeros(len(symbols), np.int64)
        inside = np.flatnonzero(word[1:] == word[:-1])
        rank[inside], made[inside] = self.pair(symbols[inside], symbols[inside + 1])
        out_words, out_symbols = [], []
        while len(symbols):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            sizes = np.diff(np.append(first, len(word)))
            least = np.minimum.reduceat(rank, first)
            if (least == _NONE).any():
                ready = np.repeat(least == _NONE, sizes)
                out_words.append(word[ready])
                out_symbols.append(symbols[ready])
                symbols, word, rank, made = symbols[~ready], word[~ready], rank[~ready], made[~ready]
                sizes, least = sizes[least < _NONE], least[least < _NONE]
                if not len(symbols):
                    break
            level = np.repeat(least, sizes)
            # Leftmost first: of occurrences that overlap, every other one.
            at = np.flatnonzero(rank == level)
            fresh = np.concatenate([[True], at[1:] != at[:-1] + 1])
            stretch = at[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
            at = at[(at - stretch) % 2 == 0]
            at = at[self._in_turn(symbols, word, level, made, at)]
            symbols[at] = made[at]
            stays = np.ones(len(symbols), bool)
            stays[at + 1] = False
            symbols, word, rank, made = symbols[stays], word[stays], rank[stays], made[stays]
            at = at - np.arange(len(at))
            changed = np.concatenate([at[at > 0] - 1, at])
            rank[changed] = _NONE
            changed = changed[changed + 1 < len(word)]
            changed = changed[word[changed] == word[changed + 1]]
            rank[changed], made[changed] = self.pair(symbols[changed], symbols[changed + 1])
        if not out_words:
            return np.zeros(0, np.int64), np.zeros(words, np.int64)
        order = np.argsort(np.concatenate(out_words), kind="stable")
        return np.concatenate(out_symbols)[order], np.bincount(np.concatenate(out_words), minlength=words)

    def _in_turn(self, symbols, word, level, made, at) -> np.ndarray:
        """Which of the merges can be done at once: those of a word up to the first one that
        brings up a pair that would be next in turn."""
        new, own = made[at], word[at]
        last = len(symbols) - 1
        before = np.maximum(at - 1, 0)
        left = symbols[before]
        if len(at) > 1:
            beside = np.flatnonzero(at[1:] == at[:-1] + 2) + 1
            left[beside] = new[beside - 1]
        after = np.minimum(at + 2, last)
        sooner = (word[before] == own) & (at > 0) & (self.pair(left, new)[0] <= level[at])
        sooner |= (word[after] == own) & (at + 2 <= last) & (self.pair(new, symbols[after])[0] <= level[at])
        if not sooner.any():
            return np.ones(len(at), bool)
        seen = np.cumsum(sooner) - sooner
        fresh = np.concatenate([[True], own[1:] != own[:-1]])
        return seen == seen[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]

    def _with_bytes(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols as ids, a character that is no piece as its bytes; ids and how many each gives."""
        counts = np.ones(len(symbols), np.int64)
        odd = np.flatnonzero(symbols >= self.size)
        if not len(odd):
            return symbols, counts
        points, which = np.unique(symbols[odd] - self.size, return_inverse=True)
        raw = [chr(p).encode() for p in points.tolist()]
        sizes = np.array([len(b) for b in raw])
        counts[odd] = sizes[which]
        ids = np.repeat(symbols, counts)
        places = _spread((np.cumsum(counts) - counts)[odd], sizes[which])
        table = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        ids[places] = table[_spread((np.cumsum(sizes) - sizes)[which], sizes[which])]
        return ids, counts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (see ``text.texts_of``) in a row, and how many each has."""
        if not len(texts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        points = np.frombuffer(joined(texts)[0].tobytes().decode().encode("utf-32-le"), np.uint32)
        # The line end behind a text is the place of the next text's leading space.
        points = np.concatenate([points[-1:], points[:-1]])
        points[points == 32] = ord(SPACE)
        begins = np.cumsum(sizes + 1) - sizes - 1
        points[begins] = ord(SPACE)
        points = np.delete(points, begins[sizes == 0])
        sizes = np.where(sizes > 0, sizes + 1, 0)
        begins = np.cumsum(sizes) - sizes
        if not len(points):
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        letter = self.letter[points]
        cut = np.concatenate([[True], ~self.inner[letter[:-1], letter[1:]], [True]])
        cut[begins] = True
        cuts = np.flatnonzero(cut)
        words = pa.Array.from_buffers(
            pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(4 * cuts.astype(np.int64)), pa.py_buffer(points)]
        ).dictionary_encode()
        distinct, which = words.dictionary, words.indices.to_numpy()
        offsets = np.frombuffer(distinct.buffers()[1], np.int64, len(distinct) + 1, 8 * distinct.offset) // 4
        letters = np.frombuffer(distinct.buffers()[2], np.uint32)[offsets[0] : offsets[-1]]
        symbols, held = self.merge(self.symbol[letters], offsets[:-1] - offsets[0])
        ids, spent = self._with_bytes(symbols)
        bounds = np.concatenate([[0], np.cumsum(spent)])[np.concatenate([[0], np.cumsum(held)])]
        lengths = np.diff(bounds)[which]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        of_text = np.searchsorted(cuts, np.append(begins, len(points)))
        return ids[_spread(bounds[:-1][which], lengths)], np.diff(ends[of_text])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """Texts in UTF-8 of the ids of each text: the first space goes, control ids are silent,
        and a byte that belongs to no character becomes U+FFFD."""
        lengths = self.lengths[ids]
        begins = self.begins[ids].copy()
        # The first id of a text that is not silent loses its leading space.
        heard = np.flatnonzero(~self.silent[ids])
        ends = np.cumsum(counts)
        lead = np.searchsorted(heard, ends - counts)
        some = lead < np.searchsorted(heard, ends)
        lead = heard[lead[some]]
        lead = lead[self.spaced[ids[lead]]]
        lengths[lead] -= 1
        begins[lead] += 1
        raw = self.surface[_spread(begins, lengths)].tobytes()
        places = np.concatenate([[0], np.cumsum(lengths)])
        bounds = places[np.concatenate([[0], ends])].tolist()
        stops = np.flatnonzero(self.silent[ids])
        if not len(stops):
            try:
                raw.decode()
            except UnicodeDecodeError:
                pass
            else:
                return [raw[a:b] for a, b in zip(bounds, bounds[1:])]
        # Bytes on both sides of a silent id make no character together.
        texts, of_text = [], np.searchsorted(stops, np.concatenate([[0], ends]))
        for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
            cuts = [a, *places[stops[of_text[i] : of_text[i + 1]]].tolist(), b]
            texts.append("".join(raw[x:y].decode(errors=_BAD_BYTE) for x, y in zip(cuts, cuts[1:])).encode())
        return texts


_models: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    """The model of this process for a file."""
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def _id_lists(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))


def _texts(model: PieceModel, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.array(model.decode(ids, counts), pa.large_binary()).cast(pa.large_string()).cast(pa.string())


def encode(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False
) -> DataFrame:
    """(id, n_tokens, ids): the ids of each whole text, as the library gives them without begin
    or end ids; with ``decoded`` also the text that :func:`decode` makes of them, in the same pass.

    One row per row: a null text is an empty one, without ids; a null id stays null; repeated rows
    are encoded one by one; other columns are ignored. No shuffle."""
    kinds = {"id": "long", "n_tokens": "long", "ids": "array<int>"} | ({"decoded": "string"} if decoded else {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            for part in slices(batch, "text", ENCODE_BYTES):
                ids, counts = model.encode(texts_of(part.column("text")))
                made = [part.column("id"), pa.array(counts, pa.int64()), _id_lists(ids, counts)]
                if decoded:
                    made.append(_texts(model, ids, counts))
                yield pa.RecordBatch.from_arrays(made, list(kinds))

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, ", ".join(map(" ".join, kinds.items()))).withColumnRenamed("id", id_col)


def decode(coded: DataFrame, path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``coded`` with the decoded text as a further column (in place of one of that name).

    A null list, or an empty one, gives an empty text; ids outside the vocabulary, or null, are an
    error, as they are for the library. Works on any ids, not only on encoded texts."""
    kept = [c for c in coded.columns if c != text_col]
    schema = coded.select(kept).schema.add(text_col, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            lists = batch.column(kept.index(ids_col))
            counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            values = lists.flatten()
            if values.null_count:
                raise ValueError("an id is null")
            ids = values.to_numpy(zero_copy_only=False).astype(np.int64)
            if len(ids) and not 0 <= ids.min() <= ids.max() < model.size:
                raise ValueError("an id lies outside the vocabulary")
            yield pa.RecordBatch.from_arrays([*batch.columns, _texts(model, ids, counts)], [*kept, text_col])

    return coded.select(kept).mapInArrow(run, schema)

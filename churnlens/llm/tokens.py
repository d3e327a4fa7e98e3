"""Token ids of whole texts, at a price per distinct word.

A text is cut at places where the tokenizer cuts in any case, and each distinct piece is encoded
once per task and remembered. Pieces are found by a hash in numpy tables, so the words of a slice
are looked up together, and then compared with the bytes remembered.
"""

from __future__ import annotations

import itertools
import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .text import joined, mix64, words_of

KEEP_PIECES = 1_000_000
#: New pieces that are encoded as one text.
RUN_PIECES = 64
_U64 = np.uint64
#: What stands before a piece that keeps its white space; a zero byte stands for nothing.
_LEAD = {0: "", 32: " ", 10: "\n"}
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_PLAIN_WHITE = np.zeros(256, bool)
_PLAIN_WHITE[[10, 32]] = True
_OTHER_WHITE = np.zeros(256, bool)
_OTHER_WHITE[[9, 11, 12, 13, 28, 29, 30, 31]] = True
#: White space beyond ASCII.
_WIDE_WHITE = r"[\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _runs(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions begin, begin + 1, ... of each run, one run after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(begins - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


class PieceTable:
    """Numbers of pieces by a hash: open addressing, whole arrays at a time."""

    def __init__(self, size: int = 1 << 17):
        self.mask = _U64(size - 1)
        self.keys, self.numbers = np.zeros(size, _U64), np.full(size, -1, np.int32)
        self.count = 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """-1 for a piece that is not here."""
        out = np.full(len(keys), -1, np.int64)
        todo, slot = np.arange(len(keys)), (keys & self.mask).astype(np.int64)
        while len(todo):
            number = self.numbers[slot]
            have = number >= 0
            todo, slot, number = todo[have], slot[have], number[have]
            same = self.keys[slot] == keys[todo]
            out[todo[same]] = number[same]
            todo, slot = todo[~same], (slot[~same] + 1) & int(self.mask)
        return out

    def add(self, keys: np.ndarray) -> None:
        """Numbers new pieces in turn; none may be here already, or twice."""
        if 2 * (self.count + len(keys)) > len(self.keys):
            used = np.flatnonzero(self.numbers >= 0)
            old = self.keys[used[np.argsort(self.numbers[used])]]
            size = len(self.keys)
            while 2 * (self.count + len(keys)) > size:
                size *= 2
            self.__init__(size)
            if len(old):
                self.add(old)
        number = np.arange(self.count, self.count + len(keys))
        self.count += len(keys)
        todo, slot = np.arange(len(keys)), (keys & self.mask).astype(np.int64)
        while len(todo):
            free = self.numbers[slot] < 0
            self.numbers[slot[free]] = number[todo[free]]  # of several, the last stays
            won = self.numbers[slot] == number[todo]
            self.keys[slot[won]] = keys[todo[won]]
            todo, slot = todo[~won], (slot[~won] + 1) & int(self.mask)


class _Lists:
    """Lists of numbers, one after the other in one array."""

    def __init__(self, kind):
        self.begins, self.lengths = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)
        self.items, self.count, self.used = np.zeros(1 << 18, kind), 0, 0

    def add(self, items: np.ndarray, lengths: np.ndarray) -> None:
        while self.count + len(lengths) > len(self.lengths):
            self.begins, self.lengths = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begins, self.lengths))
        while self.used + len(items) > len(self.items):
            self.items = np.concatenate([self.items, np.zeros_like(self.items)])
        new = slice(self.count, self.count + len(lengths))
        self.lengths[new] = lengths
        self.begins[new] = self.used + np.cumsum(lengths) - lengths
        self.items[self.used : self.used + len(items)] = items
        self.count, self.used = self.count + len(lengths), self.used + len(items)

    def get(self, numbers: np.ndarray) -> np.ndarray:
        return self.items[_runs(self.begins[numbers], self.lengths[numbers])]


def _bytes_of(tokenizer) -> np.ndarray | None:
    """How many bytes each id of a byte-level vocabulary stands for, whose entries write a byte as a
    character; None for another vocabulary, or one that puts or changes characters first."""
    plan = json.loads(tokenizer.to_str())
    before = plan["pre_tokenizer"] or {}
    if plan["normalizer"] or before.get("type") != "ByteLevel" or before.get("add_prefix_space"):
        return None
    out = np.zeros(max(tokenizer.get_vocab().values(), default=0) + 1, np.int64)
    for entry, number in tokenizer.get_vocab().items():
        out[number] = len(entry)
    return out


class PieceEncoder:
    """Ids of texts by one tokenizer file, as the library gives them with ``add_special_tokens``
    off: none is added, but the name of a special token in a text is that token.

    ``spaced``: whether a piece keeps the white space before it (byte-level vocabularies, whose
    words start with their space), or white space and the case of A-Z are dropped (vocabularies
    that drop them themselves). Texts that hold the name of a special token, and texts of the
    first kind whose white space is anything but single spaces and line ends between words, are
    encoded as they are. About ``keep`` pieces (``KEEP_PIECES`` if left out) are remembered; beyond,
    those met once are forgotten, and of the others the more frequent stay.
    """

    def __init__(self, path: str, spaced: bool, keep: int | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = sorted({t.content for t in self.tokenizer.get_added_tokens_decoder().values()})
        self.spaced, self.keep = spaced, keep
        self.bytes_of = _bytes_of(self.tokenizer) if spaced else None
        self._forget_all()

    def _forget_all(self) -> None:
        self.table, self.hits = PieceTable(), np.zeros(0, np.int64)
        self.ids, self.raw = _Lists(np.uint32), _Lists(np.uint8)

    def _most(self) -> int:
        return KEEP_PIECES if self.keep is None else self.keep

    def _forget_rare(self) -> None:
        used = np.flatnonzero(self.table.numbers >= 0)
        hits = self.hits[self.table.numbers[used]]
        kept, hits = used[hits > 1], hits[hits > 1]
        if len(kept) > self._most() // 2:
            kept = kept[np.argsort(-hits, kind="stable")[: self._most() // 2]]
        keys, numbers, ids, raw = self.table.keys[kept], self.table.numbers[kept], self.ids, self.raw
        self._forget_all()
        self._keep(keys, ids.get(numbers), ids.lengths[numbers], raw.get(numbers), raw.lengths[numbers])

    def _keep(self, keys, ids, id_counts, raw, raw_counts) -> None:
        self.table.add(keys)
        self.ids.add(ids, id_counts)
        self.raw.add(raw, raw_counts)
        self.hits = np.concatenate([self.hits, np.zeros(len(keys), np.int64)])

    def _encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        rows = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        return np.fromiter(itertools.chain.from_iterable(rows), np.uint32, int(lengths.sum())), lengths

    def _encoded_in_runs(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same for pieces that keep the white space before them, a run of them as one text; what the
        ids of a run stand for tells which piece each belongs to. Pieces that begin a text, and runs
        with an id across two pieces, are encoded one by one."""
        runs, alone = [], []
        inner = [i for i, piece in enumerate(pieces) if piece[0]]
        for at in (inner[i : i + RUN_PIECES] for i in range(0, len(inner), RUN_PIECES)):
            runs.append((at, b"".join([pieces[i] for i in at]).decode()))
        found = self.tokenizer.encode_batch_fast([text for _, text in runs], add_special_tokens=False)
        parts, of = [], []
        for (at, _), got in zip(runs, found):
            ids = np.array(got.ids, np.uint32)
            ends = np.cumsum(self.bytes_of[ids])
            bounds = np.cumsum([len(pieces[i]) for i in at])
            last = np.searchsorted(ends, bounds)
            if not len(ends) or ends[-1] != bounds[-1] or (ends[last] != bounds).any():
                alone.extend(at)
                continue
            parts.append(ids)
            of.append(np.repeat(np.array(at), np.diff(last, prepend=-1)))
        alone += [i for i, piece in enumerate(pieces) if not piece[0]]
        ids, lengths = self._encoded([_LEAD[pieces[i][0]] + pieces[i][1:].decode() for i in alone])
        of = np.concatenate([*of, np.repeat(np.array(alone, np.int64), lengths)])
        return np.concatenate([*parts, ids])[np.argsort(of, kind="stable")], np.bincount(of, minlength=len(pieces))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (see ``text.texts_of``) in a row (uint32), and how many each has."""
        odd = self._odd(texts) if self.spaced else np.zeros(len(texts), bool)
        for name in self.special:
            odd |= pc.match_substring(texts, name, ignore_case=True).to_numpy(zero_copy_only=False)
        plain, counts, doubtful = self._encode_plain(texts.filter(pa.array(~odd)) if odd.any() else texts)
        if not odd.any() and not doubtful.any():
            return plain, counts
        plain_counts = counts[~doubtful]
        plain = plain[np.repeat(~doubtful, counts)]
        whole = odd.copy()
        whole[~odd] = doubtful
        own, own_counts = self._encoded(texts.filter(pa.array(whole)).to_pylist())
        counts = np.zeros(len(texts), np.int64)
        counts[whole], counts[~whole] = own_counts, plain_counts
        ids = np.empty(int(counts.sum()), np.uint32)
        of_whole = np.repeat(whole, counts)
        ids[of_whole], ids[~of_whole] = own, plain
        return ids, counts

    def _odd(self, texts: pa.Array) -> np.ndarray:
        data, _ = joined(texts)
        sizes = pc.binary_length(texts).to_numpy() + 1
        begins = np.cumsum(sizes) - sizes
        white = _PLAIN_WHITE[data] | _OTHER_WHITE[data]
        bad = _OTHER_WHITE[data].astype(np.int64)
        bad[1:] += white[1:] & white[:-1]
        some = sizes > 1
        bad[begins[some]] = white[begins[some]]
        bad[begins[~some]] = 0
        out = np.add.reduceat(bad, begins) > 0 if len(begins) else np.zeros(0, bool)
        return out | pc.match_substring_regex(texts, _WIDE_WHITE).to_numpy(zero_copy_only=False)

    def _encode_plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, how many each text has, and which texts hold a word whose hash is another's."""
        if self.table.count > self._most():
            self._forget_rare()
        words = words_of(texts, fold=not self.spaced)
        begins, lengths = words.starts, words.ends - words.starts
        keys, data = words.hashes, words.data
        if self.spaced:
            # Each word with the byte before it, which is zero where a text begins.
            data = np.concatenate([[np.uint8(0)], data])
            data[begins[words.first[:-1][words.counts > 0]]] = 0
            keys, lengths = mix64(keys + data[begins] + _U64(1)), lengths + 1
        else:
            data = _FOLD[data]
        numbers = self.table.find(keys)
        missing = np.flatnonzero(numbers < 0)
        if len(missing):
            new_keys, once = np.unique(keys[missing], return_index=True)
            new = missing[once]
            raw = data[_runs(begins[new], lengths[new])]
            text, ends = raw.tobytes(), np.cumsum(lengths[new]).tolist()
            pieces = [text[a:b] for a, b in zip([0, *ends], ends)]
            if self.bytes_of is not None:
                ids, id_counts = self._encoded_in_runs(pieces)
            else:
                ids, id_counts = self._encoded([_LEAD[p[0]] + p[1:].decode() if self.spaced else p.decode() for p in pieces])
            self._keep(new_keys, ids, id_counts, raw, lengths[new])
            numbers[missing] = self.table.find(keys[missing])
        np.add.at(self.hits, numbers, 1)
        # The bytes decide: a text with a word that only shares its hash is encoded as it is.
        alike = self.raw.lengths[numbers] == lengths
        sure = np.flatnonzero(alike)
        if len(sure):
            equal = self.raw.get(numbers[sure]) == data[_runs(begins[sure], lengths[sure])]
            alike[sure] = np.logical_and.reduceat(equal, np.cumsum(lengths[sure]) - lengths[sure])
        doubtful = np.zeros(len(texts), bool)
        doubtful[words.docs[~alike]] = True
        ends = np.concatenate([[0], np.cumsum(self.ids.lengths[numbers])])
        return self.ids.get(numbers), np.diff(ends[words.first]), doubtful


_encoders: dict[tuple[str, bool], PieceEncoder] = {}


def encoder(path: str, spaced: bool, keep: int | None = None) -> PieceEncoder:
    """The encoder of this process for a tokenizer file."""
    if (path, spaced) not in _encoders:
        _encoders[path, spaced] = PieceEncoder(path, spaced, keep)
    return _encoders[path, spaced]


def public_vocabulary(name: str) -> str:
    """Place of a public tokenizer file; it is part of the environment, not of this library."""
    import public_tokenizers

    return public_tokenizers.path(name)

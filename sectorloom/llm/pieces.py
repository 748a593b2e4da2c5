"""Encoding of whole texts through a bounded cache of pieces.

A single space or line feed between two characters that are no white space always starts a new match of the byte-pair
pattern, and so does what follows such a line feed. A text may be cut there and each piece encoded on its own. Most
pieces of a corpus repeat: all pieces of a batch are hashed and looked up at once, and only new ones are split by the
pattern; only new words of those reach the encoder.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import regex

from .common import ranges
from .words import mixed, utf8

_MARKS = frozenset(".,;:!?")
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
# Longer runs of bytes get a hash without structure.
_SHORT = 64
_RUN_BYTES = 1 << 19
_SLOTS = 1 << 22
MAX_PIECES = 1_200_000
MAX_IDS = 10_000_000


@cache
def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of ``base`` and of its inverse modulo 2**64."""
    out = []
    for step in (base, pow(base, -1, 2**64)):
        grown = np.full(_RUN_BYTES + 1, np.uint64(step), np.uint64)
        grown[0] = 1
        out.append(np.multiply.accumulate(grown))
    return out[0], out[1]


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """128 bits of hash, as two columns, for each of several ascending runs of bytes.

    Those of up to ``_SHORT`` bytes get two polynomials modulo 2**64. Longer ones get BLAKE2b, since words of some thousand
    letters can be so regular that all such polynomials agree.
    """
    out = np.empty((len(starts), 2), np.uint64)
    i = 0
    while i < len(starts):
        low = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, low + _RUN_BYTES, "right")))
        high = int(ends[j - 1])
        if high - low > _RUN_BYTES:
            out[i] = _digest(data[low:high])
        else:
            begin, end = starts[i:j] - low, ends[i:j] - low
            values = data[low:high].astype(np.uint64) + np.uint64(1)
            sums = np.zeros(high - low + 1, np.uint64)
            for k, base in enumerate(_BASES):
                up, down = _powers(base)
                np.cumsum(values * up[: high - low], out=sums[1:])
                out[i:j, k] = mixed((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))
            for k in np.flatnonzero(end - begin > _SHORT).tolist():
                out[i + k] = _digest(data[starts[i + k] : ends[i + k]])
        i = j
    return out


def _digest(run: np.ndarray) -> np.ndarray:
    return np.frombuffer(hashlib.blake2b(run.tobytes(), digest_size=16).digest(), np.uint64)


@cache
def _bytes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes that begin a character that is surely no white space; ASCII ones; first bytes of two-byte ones.

    White space beyond ASCII begins with the bytes C2, E1, E2 or E3.
    """
    ascii_ = np.zeros(256, bool)
    ascii_[:128] = True
    ascii_[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = False
    two = np.zeros(256, bool)
    two[0xC3:0xE0] = True
    begin = ascii_ | two
    begin[0xE0] = True
    begin[0xE4:0xF5] = True
    return begin, ascii_, two


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of all texts begin and end."""
    begin, ascii_, two = _bytes()
    mark = np.zeros(len(data) + 1, bool)
    if len(data) > 2:
        ended = ascii_[data]
        ended[1:] |= two[data[:-1]]
        lone = np.zeros(len(data), bool)
        lone[1:-1] = ended[:-2] & begin[data[2:]] & ((data[1:-1] == 32) | (data[1:-1] == 10))
        whole = offsets[1:] > offsets[:-1]
        lone[offsets[:-1][whole]] = False
        lone[offsets[1:][whole] - 1] = False
        mark[:-1] = lone
        mark[1:] |= lone & (data == 10)
    mark[offsets] = True
    mark[len(data)] = False
    starts = np.flatnonzero(mark)
    return starts, np.append(starts[1:], len(data))[: len(starts)]


def flat(lists: Sequence[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all lists one after the other, and how many each has."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(itertools.chain.from_iterable(lists), np.int32, int(sizes.sum())), sizes


def _distinct(keys: np.ndarray) -> np.ndarray:
    """Where each different key is first."""
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    ordered = keys[order]
    return order[np.append(True, (ordered[1:] != ordered[:-1]).any(1))]


class PieceEncoder:
    """Ids of texts; ``encode_words`` gives the ids of several matches of ``pattern`` as :func:`flat` does.

    Pieces are known by 128 bits of hash. When the cache holds ``MAX_PIECES`` pieces or ``MAX_IDS`` ids, those that
    were used once go, and more of the rare ones if that leaves too many, so memory does not follow the corpus.
    """

    def __init__(self, encode_words: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], pattern: str):
        self.encode_words = encode_words
        self.pattern = regex.compile(pattern)
        self._keep(np.empty((0, 2), np.uint64), np.empty(0, np.int64), np.empty(0, np.int32))

    def _keep(self, keys: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        self.keys, self.ids = keys, ids
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.used = np.zeros(len(keys), np.int64)
        self.table = np.full(_SLOTS, -1, np.int32)
        self._place(0)

    def _place(self, first: int) -> None:
        """Put the codes from ``first`` on into the table, each at its first free slot."""
        codes = np.arange(first, len(self.keys), dtype=np.int32)
        slots = (self.keys[first:, 0] & np.uint64(_SLOTS - 1)).astype(np.int64)
        while len(codes):
            free = self.table[slots] < 0
            self.table[slots[free]] = codes[free]
            left = self.table[slots] != codes
            codes, slots = codes[left], (slots[left] + 1) & (_SLOTS - 1)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The code of each key, -1 if it is not known."""
        out = np.full(len(keys), -1, np.int64)
        at = np.arange(len(keys))
        slots = (keys[:, 0] & np.uint64(_SLOTS - 1)).astype(np.int64)
        while len(at):
            code = self.table[slots]
            taken = code >= 0
            at, slots, code = at[taken], slots[taken], code[taken]
            same = (self.keys[code, 0] == keys[at, 0]) & (self.keys[code, 1] == keys[at, 1])
            out[at[same]] = code[same]
            at, slots = at[~same], (slots[~same] + 1) & (_SLOTS - 1)
        return out

    def _add(self, keys: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        first = len(self.keys)
        self.keys = np.concatenate([self.keys, keys])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes, dtype=np.int64)])
        self.ids = np.concatenate([self.ids, ids])
        self.used = np.concatenate([self.used, np.zeros(len(keys), np.int64)])
        self._place(first)

    def _trim(self) -> None:
        least = 2
        while np.count_nonzero(self.used >= least) > MAX_PIECES // 2:
            least += 1
        kept = np.flatnonzero(self.used >= least)
        sizes = np.diff(self.starts)[kept]
        if sizes.sum() > MAX_IDS // 2:
            kept, sizes = kept[:0], sizes[:0]
        self._keep(self.keys[kept], sizes, self.ids[ranges(self.starts[kept], sizes)])

    def encode(self, texts: Sequence[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each text has. A null text has none."""
        if len(self.keys) > MAX_PIECES or len(self.ids) > MAX_IDS:
            self._trim()
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        data, offsets = utf8(column)
        starts, ends = cut(data, offsets)
        keys = hash_runs(data, starts, ends)
        code = self._find(keys)
        new = np.flatnonzero(code < 0)
        if len(new):
            self._learn(data, starts[new], ends[new], keys[new])
            code[new] = self._find(keys[new])
        self.used += np.bincount(code, minlength=len(self.keys))
        size = self.starts[code + 1] - self.starts[code]
        ids = self.ids[ranges(self.starts[code], size)]
        before = np.concatenate([[0], np.cumsum(size)])
        return ids, np.diff(before[np.searchsorted(starts, offsets)])

    def _words(self, piece: str) -> list[str]:
        """The matches of the pattern in a piece; those of letters, with or without a mark, need no search."""
        body = piece[1:] if piece[0] == " " else piece
        if body.isalpha():
            return [piece]
        if len(body) > 1 and body[-1] in _MARKS and body[:-1].isalpha():
            return [piece[:-1], body[-1]]
        return self.pattern.findall(piece)

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> None:
        first, text = _distinct(keys), data.tobytes()
        pieces = [text[s:e].decode() for s, e in zip(starts[first].tolist(), ends[first].tolist())]
        found = [self._words(piece) for piece in pieces]
        words = list(dict.fromkeys(itertools.chain.from_iterable(found)))
        raw = [word.encode() for word in words]
        stops = np.cumsum([len(word) for word in raw])
        joined = np.frombuffer(b"".join(raw), np.uint8)
        word_keys = hash_runs(joined, np.concatenate([[0], stops[:-1]]), stops)
        unknown = np.flatnonzero(self._find(word_keys) < 0)
        if len(unknown):
            self._add(word_keys[unknown], *self.encode_words([words[i] for i in unknown.tolist()]))
        made = [i for i, own in enumerate(found) if len(own) > 1]
        if made:
            code = dict(zip(words, self._find(word_keys).tolist()))
            parts = np.array([code[word] for i in made for word in found[i]], np.int64)
            number = np.array([len(found[i]) for i in made])
            size = self.starts[parts + 1] - self.starts[parts]
            ids = self.ids[ranges(self.starts[parts], size)]
            self._add(keys[first[made]], ids, np.add.reduceat(size, np.cumsum(number) - number))

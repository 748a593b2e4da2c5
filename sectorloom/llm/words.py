"""Words and word shingles of whole batches of texts as 64-bit hashes, without a Python step per word."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SHINGLE = 5

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


@dataclass
class Words:
    """Hashes of all words, the number of the text each is in, where the words of each text begin, and their bytes."""

    hashes: np.ndarray
    text: np.ndarray
    offsets: np.ndarray
    prefixes: dict[int, np.ndarray] | None = None
    lengths: np.ndarray | None = None


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offset of each text, nulls as empty."""
    filled = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = filled.buffers()
    places = np.frombuffer(offsets, np.int64)[filled.offset : filled.offset + len(filled) + 1]
    raw = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return raw[places[0] : places[-1]], places - places[0]


@cache
def word_bytes() -> np.ndarray:
    """ASCII letters and digits, and every byte of a longer code point."""
    table = np.zeros(256, bool)
    for low, high in ((48, 58), (65, 91), (97, 123), (128, 256)):
        table[low:high] = True
    return table


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(way: str, n: int) -> np.ndarray:
    """The first ``n`` powers of the base, or of its inverse, modulo 2**64."""
    if len(_powers[way]) < n:
        step = int(_BASE) if way == "up" else pow(int(_BASE), -1, 2**64)
        grown = np.full(max(n, 1 << 20), np.uint64(step), np.uint64)
        grown[0] = 1
        _powers[way] = np.multiply.accumulate(grown)
    return _powers[way][:n]


def words(column: pa.Array, prefixes: tuple[int, ...] = ()) -> Words:
    """Runs of word bytes of the lower-cased texts, and hashes of their first bytes. Nulls have none."""
    data, offsets = utf8(pc.utf8_lower(column))
    n = len(data)
    inside = word_bytes()[data]
    before = np.concatenate([[False], inside[:-1]]) if n else inside
    after = np.concatenate([inside[1:], [False]]) if n else inside
    before[offsets[:-1][offsets[:-1] < n]] = False
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("up", n), out=sums[1:])
    back = _power("down", n + 1)[starts]
    hashes = mixed((sums[ends] - sums[starts]) * back)
    first = {
        size: mixed((sums[np.minimum(starts + size, ends)] - sums[starts]) * back + np.uint64(size))
        for size in prefixes
    }
    places = np.searchsorted(starts, offsets)
    text = np.repeat(np.arange(len(column)), np.diff(places))
    return Words(hashes, text, places, first, ends - starts)


def shingles(found: Words, size: int = SHINGLE) -> Words:
    """Runs of ``size`` words. A text with fewer words, but at least one, has one shingle of all of them."""
    counts = np.diff(found.offsets)
    lengths = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    text = np.repeat(np.arange(len(counts)), lengths)
    at = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - found.offsets[:-1], lengths)
    last = found.offsets[1:][text]
    hashes = np.zeros(len(at), np.uint64)
    padded = np.concatenate([found.hashes, np.zeros(size, np.uint64)])
    for k in range(size):
        word = padded[at + k]
        if (counts < size).any():
            word = np.where(at + k < last, word, np.uint64(0))
        hashes = hashes * _STEP + word
    return Words(mixed(hashes), text, offsets)


def counted(found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, hash) pairs in order, and how often each occurs: text, 48 bits of the hash, count.

    Both fit one integer, which sorts much faster than pairs; so at most 2**16 texts at a time.
    """
    keys = np.sort((found.text.astype(np.uint64) << np.uint64(48)) | (found.hashes >> np.uint64(16)))
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else keys.astype(np.int64)
    kept = keys[at]
    return (
        (kept >> np.uint64(48)).astype(np.int64),
        kept & np.uint64((1 << 48) - 1),
        np.diff(np.concatenate([at, [len(keys)]])),
    )

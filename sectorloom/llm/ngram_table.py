"""Interning of byte strings in an open-addressed NumPy table, keyed by XXH64 and checked by bytes; CRC-32 of joined strings."""

from __future__ import annotations

import zlib
from functools import cache

import numpy as np
import xxhash

# Beyond so many bytes a string is hashed and compared on its own instead of in step with the others.
LONG = 256

# The primes of XXH64.
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (
        11400714785074694791,
        14029467366897019727,
        1609587929392839161,
        9650029242287828579,
        2870177450012600261,
    )
)
_SEEDS = [np.uint64((int(_P1) + int(_P2)) % 2**64), _P2, np.uint64(0), np.uint64(-int(_P1) % 2**64)]


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _round(lane: np.ndarray) -> np.ndarray:
    return _rotated(lane * _P2, 31) * _P1


def _lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place of ``data`` on as one integer; ``data`` ends in eight bytes of padding."""
    return np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))


def xxh64(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """XXH64, with seed 0, of every ``data[start : start + length]``; ``data`` ends in eight bytes of padding."""
    lanes = _lanes(data)
    out = lengths.astype(np.uint64) + _P5
    at = starts.astype(np.int64)
    left = lengths.astype(np.int64)
    long = np.flatnonzero(left > LONG)
    striped = np.flatnonzero((left >= 32) & (left <= LONG))
    if len(striped):
        state = [np.full(len(striped), seed, np.uint64) for seed in _SEEDS]
        going = np.arange(len(striped))
        while len(going):
            places = at[striped[going]]
            for k in range(4):
                lane = lanes[places + 8 * k]
                state[k][going] = _rotated(state[k][going] + lane * _P2, 31) * _P1
            at[striped[going]] += 32
            left[striped[going]] -= 32
            going = going[left[striped[going]] >= 32]
        merged = sum(_rotated(s, by) for s, by in zip(state, (1, 7, 12, 18)))
        for s in state:
            merged = (merged ^ _round(s)) * _P1 + _P4
        out[striped] = merged + lengths[striped].astype(np.uint64)
    if len(long):
        left[long] = 0
    going = np.flatnonzero(left >= 8)
    while len(going):
        out[going] = _rotated(out[going] ^ _round(lanes[at[going]]), 27) * _P1 + _P4
        at[going] += 8
        left[going] -= 8
        going = going[left[going] >= 8]
    four = np.flatnonzero(left >= 4)
    word = lanes[at[four]] & np.uint64(0xFFFFFFFF)
    out[four] = _rotated(out[four] ^ (word * _P1), 23) * _P2 + _P3
    at[four] += 4
    left[four] -= 4
    for _ in range(3):
        one = np.flatnonzero(left > 0)
        out[one] = _rotated(out[one] ^ (data[at[one]].astype(np.uint64) * _P5), 11) * _P1
        at[one] += 1
        left[one] -= 1
    out = (out ^ (out >> np.uint64(33))) * _P2
    out = (out ^ (out >> np.uint64(29))) * _P3
    out ^= out >> np.uint64(32)
    for i in long.tolist():
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : starts[i] + lengths[i]])
    return out


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the strings of equal length that begin at ``a`` and at ``b`` are equal."""
    lanes = _lanes(data)
    same = np.ones(len(a), bool)
    going = np.flatnonzero(lengths <= LONG)
    done = 0
    while len(going):
        rest = lengths[going] - done
        differ = lanes[a[going] + done] ^ lanes[b[going] + done]
        short = rest < 8
        differ[short] &= (np.uint64(1) << (8 * rest[short]).astype(np.uint64)) - np.uint64(1)
        same[going] = differ == 0
        going = going[(differ == 0) & (rest > 8)]
        done += 8
    for i in np.flatnonzero(lengths > LONG).tolist():
        n = lengths[i]
        same[i] = np.array_equal(data[a[i] : a[i] + n], data[b[i] : b[i] + n])
    return same


class Interned:
    """The distinct strings among ``data[start : start + length]``, each in a slot of an open-addressed table.

    ``slots`` has the slot of every occurrence. ``used`` lists the taken slots, ``owner`` an occurrence of the string of
    a slot, ``count`` how often it occurs. Two strings share a slot only if their lengths and bytes are equal,
    whatever their keys; colliding ones go to the next free slot.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, keys: np.ndarray | None = None):
        n = len(starts)
        size = 1 << max(4, (2 * n).bit_length())
        keys = xxh64(data, starts, lengths) if keys is None else keys
        self.owner = np.full(size, -1, np.int32)
        self.slots = (keys & np.uint64(size - 1)).astype(np.int32)
        pending = np.arange(n, dtype=np.int32)
        while len(pending):
            slot = self.slots[pending]
            free = self.owner[slot] < 0
            # Of several that claim a slot one gets it; the others compare themselves with it like latecomers.
            self.owner[slot[free]] = pending[free]
            holder = self.owner[slot]
            same = (keys[holder] == keys[pending]) & (lengths[holder] == lengths[pending])
            check = np.flatnonzero(same & (holder != pending))
            same[check] = same_bytes(data, starts[holder[check]], starts[pending[check]], lengths[pending[check]])
            pending = pending[~same]
            self.slots[pending] = (self.slots[pending] + 1) & (size - 1)
        self.used = np.flatnonzero(self.owner >= 0)
        self.count = np.bincount(self.slots, minlength=size)


@cache
def _crc_shifts() -> np.ndarray:
    """Per power of two n: what n zero bytes after a string make of each of the four bytes of its CRC-32."""
    single = np.array([zlib.crc32(bytes([v])) ^ zlib.crc32(b"\0") for v in range(256)], np.uint32)
    values = np.arange(256, dtype=np.uint32)
    one = np.stack([single] + [values << np.uint32(8 * (k - 1)) for k in (1, 2, 3)])
    shifts = [one]
    for _ in range(30):
        shifts.append(_apply(shifts[-1], shifts[-1]))
    return np.stack(shifts)


def _apply(shift: np.ndarray, crc: np.ndarray) -> np.ndarray:
    byte = np.uint32(255)
    return (
        shift[0][crc & byte]
        ^ shift[1][(crc >> np.uint32(8)) & byte]
        ^ shift[2][(crc >> np.uint32(16)) & byte]
        ^ shift[3][crc >> np.uint32(24)]
    )


def crc_joined(first: np.ndarray, second: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The CRC-32 of strings put together, from those of their parts and the ``lengths`` of the second parts."""
    out = first.copy()
    for bit in range(int(lengths.max(initial=0)).bit_length()):
        shift = _crc_shifts()[bit]
        some = np.flatnonzero((lengths >> bit) & 1)
        if len(some):
            out[some] = _apply(shift, out[some])
    return out ^ second

"""Words of whole batches of texts as bytes: runs of ASCII letters, digits and all code points from U+0080 on.

Only A-Z are lower-cased. Bytes are kept, not hashes, so words can be told apart exactly.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

from .words import utf8, word_bytes


@cache
def _lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


@dataclass
class Terms:
    """The bytes of all words without what lies between, the length of each, and where the words of each text begin."""

    data: np.ndarray
    lengths: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.lengths)

    def array(self) -> pa.Array:
        """One binary value per word."""
        ends = np.zeros(len(self) + 1, np.int64)
        np.cumsum(self.lengths, out=ends[1:])
        buffers = [None, pa.py_buffer(ends), pa.py_buffer(self.data)]
        return pa.Array.from_buffers(pa.large_binary(), len(self), buffers)

    def joined(self, padding: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words with a space after each, and the start and end of each word in that."""
        n = len(self)
        ends = np.cumsum(self.lengths + 1) - 1
        out = np.full(len(self.data) + n + padding, 32, np.uint8)
        out[np.arange(len(self.data)) + np.repeat(np.arange(n), self.lengths)] = self.data
        return out, ends - self.lengths, ends


def terms(column: pa.Array) -> Terms:
    """The words of every text in order. Nulls have none; a word never goes on into the next text."""
    data, offsets = utf8(column)
    n = len(data)
    inside = word_bytes()[data]
    before = np.concatenate([[False], inside[:-1]]) if n else inside
    after = np.concatenate([inside[1:], [False]]) if n else inside
    before[offsets[:-1][offsets[:-1] < n]] = False
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return Terms(_lower()[data[inside]], ends - starts, np.searchsorted(starts, offsets))

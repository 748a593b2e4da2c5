"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact verification.

A window is a run of as many shingles of five words as a benchmark item has, at every position of a text. A shingle
weighs the bytes of its words. Windows and items have 64-bit SimHash fingerprints of their weighted shingles. A
multi-index finds every item of the window's size within ``RADIUS`` bits: of ``BLOCKS`` blocks of a fingerprint, at
least one differs in no more than RADIUS // BLOCKS bits, and a table per block lists the items for every value of
it. Candidates are verified by exact weighted Jaccard similarity of window and item.

A window whose shingles of any item weigh less than ``threshold`` of the window can't reach that similarity with any
item, so it is not fingerprinted. This bound loses nothing, and leaves few windows of a clean text.

The index of a pass over the texts holds at most ``PASS_BYTES`` of item text; a larger benchmark takes more
passes over the same scan, not a larger index.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_slices, ranges
from .words import SHINGLE, Words, mixed, shingles, words

THRESHOLD = 0.8
RADIUS = 20
BLOCKS = 8
PASS_BYTES = 16 << 20
_SLOTS = 1 << 20
_LOW = np.uint64((1 << 48) - 1)

SPANS = "array<struct<item_id: bigint, first_word: int, n_words: int, similarity: double>>"


@dataclass
class Index:
    """The items of one shingle width: their shingles one after the other, and per size the block tables."""

    width: int
    item_ids: np.ndarray
    hashes: np.ndarray
    weights: np.ndarray
    offsets: np.ndarray
    known: np.ndarray
    slots: np.ndarray
    sizes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


def _weighted(found: Words, width: int) -> tuple[Words, np.ndarray]:
    """Shingles of ``width`` words, as 48-bit hashes, and their weights; texts with fewer words have none."""
    made = shingles(found, width)
    enough = np.diff(found.offsets) >= width
    keep = enough[made.text]
    lengths = np.where(enough, np.diff(made.offsets), 0)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    text, hashes = made.text[keep], made.hashes[keep] >> np.uint64(16)
    at = np.arange(len(text)) - offsets[text] + found.offsets[text]
    sums = np.concatenate([[0], np.cumsum(found.lengths)])
    return Words(hashes, text, offsets), (sums[at + width] - sums[at]).astype(np.int64)


def _signs(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Per shingle its weight with the sign of each of the 64 bits of its hash."""
    bits = np.unpackbits(mixed(hashes).view(np.uint8)).reshape(-1, 64).astype(np.int32)
    return (2 * bits - 1) * weights[:, None].astype(np.int32)


def _fingerprints(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1)


def build(item_ids: list[int], texts: list[str]) -> list[Index]:
    """An index per shingle width; an item of fewer than five words has one shingle of all of them."""
    found = words(pa.array(texts, pa.string()))
    counts = np.diff(found.offsets)
    indexes = []
    for width in range(1, SHINGLE + 1):
        chosen = np.flatnonzero(counts == width if width < SHINGLE else counts >= width)
        if not len(chosen):
            continue
        made, weights = _weighted(found, width)
        lengths = np.diff(made.offsets)[chosen]
        places = ranges(made.offsets[:-1][chosen], lengths)
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        hashes, weights = made.hashes[places], weights[places]
        sums = np.add.reduceat(_signs(hashes, weights), offsets[:-1])
        prints = _fingerprints(sums)
        known = np.unique(hashes)
        slots = np.zeros(_SLOTS, bool)
        slots[known & np.uint64(_SLOTS - 1)] = True
        sizes = {}
        for size in np.unique(lengths).tolist():
            members = np.flatnonzero(lengths == size)
            sizes[size] = _block_tables(members, prints[members])
        indexes.append(
            Index(width, np.array(item_ids, np.int64)[chosen], hashes, weights, offsets, known, slots, sizes)
        )
    return indexes


def _block_tables(members: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints, and for every block and value the members within the block's share of the radius.

    The lists are one array; the list of a block and value ends where that of the next begins.
    """
    values = np.arange(256, dtype=np.uint8)
    near = np.bitwise_count(values[:, None, None] ^ prints[None, :, :]) <= RADIUS // BLOCKS
    lists = near.transpose(2, 0, 1).reshape(BLOCKS * 256, len(members))
    starts = np.concatenate([[0], np.cumsum(lists.sum(1))])
    return np.column_stack([members, prints.view(np.uint64).astype(np.int64)[:, 0]]), starts, np.nonzero(lists)[1]


def find(column: pa.Array, indexes: list[Index], threshold: float = THRESHOLD) -> pa.Array:
    """Per text the items found in it, each at its most similar window (the first of equal ones)."""
    found = words(column)
    parts = [_find(found, index, threshold) for index in indexes]
    parts = [part for part in parts if len(part[0])]
    if parts:
        text, item, first, n_words, value = (np.concatenate(x) for x in zip(*parts))
    else:
        text = item = first = n_words = np.empty(0, np.int64)
        value = np.empty(0)
    order = np.lexsort((first, item, text))
    counts = np.bincount(text, minlength=len(column))
    spans = pa.StructArray.from_arrays(
        [
            pa.array(item[order], pa.int64()),
            pa.array(first[order], pa.int32()),
            pa.array(n_words[order], pa.int32()),
            pa.array(value[order], pa.float64()),
        ],
        ["item_id", "first_word", "n_words", "similarity"],
    )
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), spans)


def _find(found: Words, index: Index, threshold: float) -> tuple[np.ndarray, ...]:
    made, weights = _weighted(found, index.width)
    hashes = made.hashes
    maybe = np.flatnonzero(index.slots[hashes & np.uint64(_SLOTS - 1)])
    at = np.minimum(np.searchsorted(index.known, hashes[maybe]), len(index.known) - 1)
    hits = maybe[index.known[at] == hashes[maybe]]
    nothing = tuple(np.empty(0, np.int64) for _ in range(4)) + (np.empty(0),)
    if not len(hits):
        return nothing
    flags = np.zeros(len(hashes), np.int64)
    flags[hits] = weights[hits]
    own, all_ = (np.concatenate([[0], np.cumsum(x)]) for x in (flags, weights))
    of_text = made.text[hits]
    gap = np.diff(hits, prepend=-1)
    gap[1:][of_text[1:] != of_text[:-1]] = len(hashes)
    gap[0] = len(hashes)
    results = []
    for size, tables in index.sizes.items():
        # Starts of windows that hold a hit, each once; a window that reaches over an end of its text is cut there.
        new = np.minimum(gap, size)
        starts = ranges(hits - new + 1, new)
        text = np.repeat(of_text, new)
        begin = np.maximum(starts, made.offsets[text])
        end = np.minimum(starts + size, made.offsets[text + 1])
        enough = own[end] - own[begin] >= threshold * (all_[end] - all_[begin])
        begin, end = begin[enough], end[enough]
        if len(begin):
            results.append(_search(begin, end, made, weights, index, tables, threshold))
    results = [r for r in results if len(r[0])]
    if not results:
        return nothing
    text, item, begin, end, value = (np.concatenate(x) for x in zip(*results))
    order = np.lexsort((begin, -value, item, text))
    first = np.ones(len(order), bool)
    first[1:] = (text[order][1:] != text[order][:-1]) | (item[order][1:] != item[order][:-1])
    best = order[first]
    text, item, begin, end, value = (x[best] for x in (text, item, begin, end, value))
    return text, index.item_ids[item], begin - made.offsets[text], end - begin + index.width - 1, value


def _search(begin, end, made, weights, index, tables, threshold):
    """Verified (text, item, begin, end, similarity) among windows of one size."""
    own, starts, lists = tables
    members, prints = own[:, 0], own[:, 1].view(np.uint64)
    # Sums of signs are taken over the few places that the windows cover.
    places = np.unique(ranges(begin, end - begin))
    sums = np.zeros((len(places) + 1, 64), np.int32)
    np.cumsum(_signs(made.hashes[places], weights[places]), axis=0, out=sums[1:])
    from_ = np.searchsorted(places, begin)
    window = _fingerprints(sums[from_ + end - begin] - sums[from_])
    pairs = []
    for block in range(BLOCKS):
        key = block * 256 + window[:, block].astype(np.int64)
        count = starts[key + 1] - starts[key]
        pairs.append(np.repeat(np.arange(len(window)), count) * len(members) + lists[ranges(starts[key], count)])
    pairs = np.unique(np.concatenate(pairs))
    which, member = pairs // len(members), pairs % len(members)
    distance = np.bitwise_count(window.view(np.uint64)[:, 0][which] ^ prints[member])
    near = distance <= RADIUS
    which, item = which[near], members[member[near]]
    value = _similarity(begin[which], end[which], item, made.hashes, weights, index)
    good = value >= threshold
    which, item = which[good], item[good]
    return made.text[begin[which]], item, begin[which], end[which], value[good]


def _similarity(begin, end, item, hashes, weights, index) -> np.ndarray:
    """Exact weighted Jaccard similarity of windows and items as multisets of shingles, in bounded steps."""
    out = np.zeros(len(begin))
    step = 1 << 14
    for low in range(0, len(begin), step):
        at = slice(low, low + step)
        n = len(begin[at])
        left = _multiset(begin[at], end[at] - begin[at], hashes, weights)
        right = _multiset(
            index.offsets[item[at]], np.diff(index.offsets)[item[at]], index.hashes, index.weights
        )
        _, i, j = np.intersect1d(left[0], right[0], assume_unique=True, return_indices=True)
        shared = np.bincount(
            (left[0][i] >> np.uint64(48)).astype(np.int64),
            weights=np.minimum(left[1][i], right[1][j]),
            minlength=n,
        )
        total = sum(
            np.bincount((key >> np.uint64(48)).astype(np.int64), weights=w, minlength=n) for key, w in (left, right)
        )
        out[at] = shared / np.maximum(total - shared, 1e-12)
    return out


def _multiset(starts, lengths, hashes, weights) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (number, shingle) keys of the runs, and the summed weight of each."""
    places = ranges(starts, lengths)
    keys = (np.repeat(np.arange(len(starts), dtype=np.uint64), lengths) << np.uint64(48)) | (hashes[places] & _LOW)
    unique, which = np.unique(keys, return_inverse=True)
    return unique, np.bincount(which, weights=weights[places], minlength=len(unique))


def spans(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> Column:
    """For the ``text`` column of ``docs``: the spans of benchmark items in it, by item."""
    items = benchmark.where("item_id is not null and text is not null").select("item_id", "text").distinct()
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    passes = max(1, -(-size // PASS_BYTES))
    found = []
    for number in range(passes):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == number)
        rows = sorted(own.collect())
        indexes = build([row[0] for row in rows], [row[1] for row in rows])
        found.append(_finder(docs.sparkSession.sparkContext.broadcast(indexes), threshold)("text"))
    return found[0] if passes == 1 else F.concat(*found)


def _finder(shared, threshold: float):
    return F.arrow_udf(
        lambda texts: by_slices(lambda part: find(part, shared.value, threshold), texts, 1 << 19), SPANS
    )


def contamination(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, contaminated, similarity, items, spans) of every row of ``docs``.

    ``spans`` has, for each item found, the window most similar to it; ``items`` are their ids and ``similarity`` the
    largest similarity, 0 if there is none. Null or empty texts hold nothing, nor do items that are null or have no
    words. Items of fewer than five words are found where all of their words follow each other. Repeated items
    or rows are found alike; no rows give none; other columns are ignored.
    """
    found = docs.select("doc_id", spans(docs, benchmark, threshold).alias("spans"))
    return found.select(
        "doc_id",
        (F.size("spans") > 0).alias("contaminated"),
        F.coalesce(F.array_max("spans.similarity"), F.lit(0.0)).alias("similarity"),
        F.array_sort(F.array_distinct("spans.item_id")).alias("items"),
        "spans",
    )


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    return docs.where(F.size(spans(docs, benchmark, threshold)) == 0)

"""Ranked lexical search: for each query item the documents of highest term score, by presence-mask grouping.

Index. One pass finds the words of every whole text and writes, per chunk of documents, the terms of the items that
each holds and how often, with the length of the document. Document frequencies, the number of documents and of
terms are sums over the written chunks.

Search. A chunk has a row of presence bits per term. For an item, the rows of its terms are packed into one mask per
document, and documents of equal masks form a group. The maximum of a group is the sum, over the terms in the mask, of the
term's highest contribution in the chunk. Groups are scored exactly in the order of their maxima, and the rest of a
chunk is left as soon as the next maximum is below the lowest score that the item still needs. A task keeps these
scores from chunk to chunk, so later chunks are left sooner. Each task sends its best documents per item, and a window
with a group limit takes the best of all.

Items come in passes of bounded bytes of text, each of which reads the documents once, so what is broadcast is bounded
whatever the number of items. An item's work is one mask per document: linear in items and documents, no pair of
them is ever a row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialised, ranges, slices
from .terms import terms

BEST = 50
# Bytes of item text of a pass.
PASS_BYTES = 4 << 20
# Bytes of text and of presence flags of a chunk.
CHUNK_BYTES = 8 << 20
FLAG_BYTES = 16 << 20
# Groups that are scored at a time.
GROUPS = 64

_INDEX = (
    "doc_ids array<bigint>, lengths binary, starts binary, terms binary, counts binary,"
    " documents long, words long, own_terms array<int>, own_documents array<bigint>"
)


@dataclass
class Items:
    """The items of a pass: their ids, the distinct terms of each as numbers, and the terms by number."""

    ids: list
    wanted: list[np.ndarray]
    vocabulary: pa.Array

    @classmethod
    def of(cls, ids: list, texts: list) -> Items:
        found = terms(pa.array(texts, pa.string()))
        encoded = found.array().dictionary_encode()
        numbers = encoded.indices.to_numpy()
        wanted = [np.unique(numbers[i:j]) for i, j in zip(found.offsets[:-1], found.offsets[1:])]
        return cls(ids, wanted, encoded.dictionary)


def search(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """(item_id, rank, doc_id, score): per row of ``items`` (item_id, text) its ``best`` documents of score above 0.

    Words are runs of ASCII letters, digits and code points from U+0080, with only A-Z lower-cased. Equal scores go by
    ascending doc_id, null last. Items that no document matches, as null, empty or wordless texts, have no row, and so have
    empty tables. Documents without words are found by no item and count nowhere. Repeated rows of either table
    are rows of their own: repeated items have a result each. Other columns are ignored.
    """
    keyed = items.select("item_id", "text").withColumn("__row", F.monotonically_increasing_id())
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = -(-size // PASS_BYTES) or 1
    if passes > 1:
        keyed = materialised(keyed, "lexical-items")
    parts = []
    for number in range(passes):
        dealt = F.pmod(F.xxhash64("__row"), F.lit(passes)) == F.lit(number)
        rows = (keyed.where(dealt) if passes > 1 else keyed).select("item_id", "text").collect()
        parts.append(_one_pass(docs, Items.of([r[0] for r in rows], [r[1] for r in rows]), best, number))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    order = W.partitionBy("pass", "item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    kind = items.schema["item_id"].dataType
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= best)
        .select(F.col("item_id").cast(kind), "rank", "doc_id", "score")
    )


def index(docs: DataFrame, items: Items) -> DataFrame:
    """One row per chunk of documents: its postings of the items' terms, and its counts."""
    vocabulary = items.vocabulary
    rows = max(1, FLAG_BYTES // max(1, len(vocabulary)))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", CHUNK_BYTES):
                for start in range(0, len(part), rows):
                    yield _chunk(part.slice(start, rows), vocabulary)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(build, _INDEX)


def _chunk(part: pa.RecordBatch, vocabulary: pa.Array) -> pa.RecordBatch:
    found = terms(part.column("text"))
    lengths = np.diff(found.offsets)
    number = pc.index_in(found.array(), value_set=vocabulary)
    known = pc.is_valid(number).to_numpy(zero_copy_only=False)
    number = pc.drop_null(number).to_numpy().astype(np.int64)
    document = np.repeat(np.arange(len(part)), lengths)[known]
    key, counts = np.unique(document * max(1, len(vocabulary)) + number, return_counts=True)
    document, number = np.divmod(key, max(1, len(vocabulary)))
    kept, per_document = np.unique(document, return_counts=True)
    own, frequency = np.unique(number, return_counts=True)

    def cell(values: np.ndarray) -> pa.Array:
        return pa.array([values.astype("<i4").tobytes()], pa.binary())

    def listed(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    return pa.RecordBatch.from_arrays(
        [
            listed(part.column("doc_id").take(pa.array(kept))),
            cell(lengths[kept]),
            cell(np.concatenate([[0], np.cumsum(per_document)])),
            cell(number),
            cell(counts),
            pa.array([int((lengths > 0).sum())], pa.int64()),
            pa.array([int(lengths.sum())], pa.int64()),
            listed(pa.array(own, pa.int32())),
            listed(pa.array(frequency, pa.int64())),
        ],
        ["doc_ids", "lengths", "starts", "terms", "counts", "documents", "words", "own_terms", "own_documents"],
    )


def term_weights(documents: int, frequencies: np.ndarray) -> np.ndarray:
    """floor(1000 ln((2 N + 2) / (2 df + 1))) per term."""
    return np.array(
        [math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in frequencies.tolist()], np.int64
    )


def contributions(counts: np.ndarray, lengths: np.ndarray, documents: int, words: int) -> np.ndarray:
    """What an occurrence count in a document of so many words adds to its score, per unit of the term's weight."""
    norm = 50 + (50 * lengths * documents) // words
    return (1_000_000_000 * counts) // (1000 * counts + 20 * norm)


def _one_pass(docs: DataFrame, items: Items, best: int, number: int) -> DataFrame:
    """(pass, item, item_id, doc_id, score): per task the best documents of each item."""
    chunks = materialised(index(docs, items), "lexical-index", compression="zstd")
    documents, words = chunks.agg(F.sum("documents"), F.sum("words")).first()
    pairs = F.inline(F.arrays_zip(F.col("own_terms").alias("term"), F.col("own_documents").alias("n")))
    counted = chunks.select(pairs).toDF("term", "n").groupBy("term").agg(F.sum("n").alias("n"))
    frequencies = np.zeros(len(items.vocabulary), np.int64)
    for term, n in counted.collect():
        frequencies[term] = n
    weights = term_weights(documents or 0, frequencies)
    wanted, ids = items.wanted, items.ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [Best(best) for _ in wanted]
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = Chunk(batch.slice(i, 1), len(weights), documents, words)
                for own, terms_of_item in zip(kept, wanted):
                    if len(terms_of_item):
                        chunk.search(terms_of_item, weights, own)
        sizes = [len(x.scores) for x in kept]
        if sum(sizes):
            item = np.repeat(np.arange(len(kept)), sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(item), number), pa.int32()),
                    pa.array(item, pa.int32()),
                    pa.array([None if ids[i] is None else str(ids[i]) for i in item.tolist()], pa.string()),
                    pa.array(np.concatenate([x.ids for x in kept]), mask=np.concatenate([x.missing for x in kept])),
                    pa.array(np.concatenate([x.scores for x in kept]), pa.int64()),
                ],
                ["pass", "item", "item_id", "doc_id", "score"],
            )

    columns = ["doc_ids", "lengths", "starts", "terms", "counts"]
    return chunks.select(*columns).mapInArrow(run, "pass int, item int, item_id string, doc_id long, score long")


class Best:
    """The best documents of one item so far, highest score first, equal ones by ascending id, null last."""

    def __init__(self, size: int):
        self.size = size
        self.scores = np.empty(0, np.int64)
        self.ids = np.empty(0, np.int64)
        self.missing = np.empty(0, bool)

    @property
    def needed(self) -> int:
        """The lowest score that may still enter."""
        return int(self.scores[-1]) if len(self.scores) == self.size else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        good = scores >= self.needed
        if not good.any():
            return
        scores = np.concatenate([self.scores, scores[good]])
        ids, missing = np.concatenate([self.ids, ids[good]]), np.concatenate([self.missing, missing[good]])
        order = np.lexsort((ids, missing, -scores))[: self.size]
        self.scores, self.ids, self.missing = scores[order], ids[order], missing[order]


class Chunk:
    """The postings of a chunk of documents, and which terms each document holds."""

    def __init__(self, row: pa.RecordBatch, vocabulary: int, documents: int, words: int):
        lengths, self.starts, self.terms, counts = (
            np.frombuffer(row.column(name)[0].as_buffer(), "<i4").astype(np.int64)
            for name in ("lengths", "starts", "terms", "counts")
        )
        ids = row.column("doc_ids")[0].values
        self.missing = pc.is_null(ids).to_numpy(zero_copy_only=False)
        self.ids = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
        document = np.repeat(np.arange(len(lengths)), np.diff(self.starts))
        self.adds = contributions(counts, lengths[document], documents, words)
        self.present = np.zeros((vocabulary, len(lengths)), bool)
        self.present[self.terms, document] = True
        self.highest = np.zeros(vocabulary, np.int64)
        np.maximum.at(self.highest, self.terms, self.adds)

    def search(self, wanted: np.ndarray, weights: np.ndarray, best: Best) -> None:
        """Add to ``best`` the documents that hold ``wanted`` terms, in the order of their groups' maxima."""
        if not self.present.shape[1]:
            return
        masks = np.packbits(self.present[wanted], axis=0)
        distinct, first, group = _distinct(masks)
        held = self.present[np.ix_(wanted, first)]
        maxima = ((weights[wanted] * self.highest[wanted])[:, None] * held).sum(0)
        order = np.argsort(-maxima, kind="stable")
        members = np.argsort(group, kind="stable")
        sizes = np.bincount(group, minlength=distinct)
        begins = np.cumsum(sizes) - sizes
        own = np.zeros(len(weights), np.int64)
        own[wanted] = weights[wanted]
        for start in range(0, distinct, GROUPS):
            some = order[start : start + GROUPS]
            some = some[maxima[some] >= best.needed]
            if not len(some):
                return
            found = members[ranges(begins[some], sizes[some])]
            counts = self.starts[found + 1] - self.starts[found]
            places = ranges(self.starts[found], counts)
            edges = np.concatenate([[0], np.cumsum(counts)[:-1]])
            scores = np.add.reduceat(own[self.terms[places]] * self.adds[places], edges)
            best.add(scores, self.ids[found], self.missing[found])


def _distinct(masks: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """How many columns differ, the first column of each kind, and the kind of every column."""
    wide = np.zeros((masks.shape[1], -(-masks.shape[0] // 8) * 8), np.uint8)
    wide[:, : masks.shape[0]] = masks.T
    keys = wide.view(np.uint64)
    if keys.shape[1] == 1:
        _, first, group = np.unique(keys[:, 0], return_index=True, return_inverse=True)
    else:
        _, first, group = np.unique(keys, axis=0, return_index=True, return_inverse=True)
    return len(first), first, group.ravel()

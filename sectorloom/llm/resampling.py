"""Target-distribution importance resampling: documents drawn by how much likelier their n-grams are in a target corpus.

Features are all runs of one to three consecutive words; a feature's bucket is the CRC-32 of its bytes modulo
``BUCKETS``. A task interns the features of a batch of whole texts in an open-addressed table (``ngram_table``), whose slots
hold bucket and count. The first pass adds up the counts per bucket, of the corpus and of the target; they give the
gain of a bucket. The second pass takes the gain of every occurrence by its slot and adds up the gains of a
document. Drawing by weight plus Gumbel noise is drawing without replacement in proportion to exp(weight); the noise
depends on the doc_id only.

Ranks are exact without one ordered task: scored rows, a few numbers each, are dealt by score into ranges, whose rows
are counted; only ranges that reach into the drawn part are ranked, each on its own, after the rows before it.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialised, slices
from .ngram_table import Interned, crc_joined
from .terms import Terms, terms

BUCKETS = 10_000
LONGEST = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = "42"
# Bytes of text whose features are interned at a time.
SLICE_BYTES = 1 << 20

_SCORED = "doc_id long, n_features long, weight long, score long, eligible boolean"


class Features:
    """The runs of one to ``LONGEST`` words of whole texts, interned: per occurrence its text and slot."""

    def __init__(self, column: pa.Array):
        found = terms(column)
        data, starts, ends = found.joined(padding=8)
        self.words = np.diff(found.offsets)
        owner = np.repeat(np.arange(len(column)), self.words)
        left = found.offsets[1:][owner] - np.arange(len(found))
        word = [np.flatnonzero(left >= size) for size in range(1, LONGEST + 1)]
        begin = np.concatenate([starts[at] for at in word])
        length = np.concatenate([ends[at + size] for size, at in enumerate(word)]) - begin
        self.text = np.concatenate([owner[at] for at in word])
        self.table = Interned(data, begin, length)
        self.bucket = np.zeros(len(self.table.owner), np.int16)
        self.bucket[self.table.used] = self._checksums(found, data, starts, np.concatenate(word)) % BUCKETS

    def _checksums(self, found: Terms, data: np.ndarray, starts: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The CRC-32 of the string of every used slot, put together from those of its words."""
        table, lengths = self.table, found.lengths
        first = table.owner[table.used]
        single = first[first < len(found)]
        raw = memoryview(data)
        ends = (starts[single] + lengths[single]).tolist()
        of_slot = np.zeros(len(table.owner), np.uint32)
        of_slot[table.slots[single]] = [zlib.crc32(raw[a:b]) for a, b in zip(starts[single].tolist(), ends)]
        plain = of_slot[table.slots[: len(found)]]
        space = np.full(len(found), zlib.crc32(b" "), np.uint32)
        spaced = crc_joined(space, plain, lengths)
        size = np.searchsorted(np.cumsum([len(found), *self._runs(found)]), first, side="right") + 1
        out = plain[word[first]]
        for more in range(1, LONGEST):
            some = np.flatnonzero(size > more)
            last = word[first[some]] + more
            out[some] = crc_joined(out[some], spaced[last], lengths[last] + 1)
        return out

    def _runs(self, found: Terms) -> list[int]:
        """How many runs of two and more words there are."""
        return [int(np.maximum(self.words - size + 1, 0).sum()) for size in range(2, LONGEST + 1)]

    def per_bucket(self) -> np.ndarray:
        """How often features of each bucket occur."""
        used = self.table.used
        return np.bincount(self.bucket[used], weights=self.table.count[used], minlength=BUCKETS).astype(np.int64)

    def per_text(self) -> np.ndarray:
        return np.bincount(self.text, minlength=len(self.words))

    def weights(self, gains: np.ndarray) -> np.ndarray:
        """The sum of the gains of each text's occurrences."""
        of_slot = gains[self.bucket]
        # Gains are integers, and sums of a text stay below 2**53, so doubles add them exactly.
        return np.bincount(
            self.text, weights=of_slot[self.table.slots], minlength=len(self.words)
        ).astype(np.int64)


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Occurrences of features per bucket over all rows of ``texts`` (text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                totals += Features(part.column("text")).per_bucket()
        held = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(totals[held])], ["bucket", "n"])

    rows = texts.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in rows.collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed share of a bucket in the target over that in the corpus)."""
    all_corpus, all_target = int(corpus.sum()) + BUCKETS, int(target.sum()) + BUCKETS
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * all_corpus / ((s + 1.0) * all_target)))
            for s, t in zip(corpus.tolist(), target.tolist())
        ],
        np.int64,
    )


def noise(doc_id: int | None) -> int:
    """Gumbel noise in thousandths, from the digest of the id alone; a null id counts as an empty one."""
    name = f"{SEED}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_features, weight, score, eligible) of every document."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                features = Features(part.column("text"))
                weight = features.weights(gain)
                drift = np.array([noise(x) for x in part.column("doc_id").to_pylist()], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(features.per_text(), pa.int64()),
                        pa.array(weight),
                        pa.array(weight + drift),
                        pa.array(features.words >= LEAST_WORDS),
                    ],
                    ["doc_id", "n_features", "weight", "score", "eligible"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(score, _SCORED)


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs`` (doc_id, text); ``target`` has texts.

    Of the N documents with at least 20 words the ``floor(percent * N / 100)`` of highest score are drawn and ranked, equal
    scores by ascending doc_id, null last; rows equal in both are interchangeable. The rank of all others is null. Only
    A-Z are lower-cased; null and empty texts have no features and weight 0, and so has every document if both tables
    are empty of words. Repeated rows are rows of their own; no rows give none; other columns are ignored.
    """
    gain = gains(bucket_counts(docs), bucket_counts(target))
    rows = materialised(scored(docs, gain), "resampling-scores")
    drawn = rows.where("eligible").count() * percent // 100
    return ranked(rows, drawn).select("doc_id", "n_features", "weight", "score", "rank")


def ranked(rows: DataFrame, drawn: int) -> DataFrame:
    """``rows``, which must be a written table, with the ``rank`` of the first ``drawn`` eligible ones."""
    nobody = F.lit(None).cast("long")
    undrawn = rows.where(~F.col("eligible")).withColumn("rank", nobody)
    # A row's number keeps apart what else is equal, so no range has to hold all copies.
    keyed = rows.where("eligible").withColumn("__row", F.monotonically_increasing_id())
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("__row")]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = keyed.repartitionByRange(parts, *order).withColumn("__range", F.spark_partition_id())
    dealt = materialised(dealt, "resampling-ranges")
    before = W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    # One row per range.
    ranges = (
        dealt.groupBy("__range")
        .agg(F.count("*").alias("__n"))
        .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .drop("__n")
    )
    placed = dealt.join(F.broadcast(ranges), "__range")
    within = F.row_number().over(W.partitionBy("__range").orderBy(*order)).cast("long")
    reached = (
        placed.where(F.col("__before") < drawn)
        .withColumn("rank", within + F.col("__before"))
        .withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    )
    rest = placed.where(F.col("__before") >= drawn).withColumn("rank", nobody)
    columns = [*rows.columns, "rank"]
    return undrawn.select(*columns).unionByName(reached.select(*columns)).unionByName(rest.select(*columns))

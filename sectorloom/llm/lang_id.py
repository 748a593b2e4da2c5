"""Language identification by bit-sliced Bloom filters of letter n-grams.

One table of language bitmasks holds a Bloom filter per language: bit l of a slot is the filter of language l. A
lookup of an n-gram is the AND of its slots and gives all languages that contain it at once. A text's count per
language is the population count of its bit over all n-grams, corrected for the false positives that the
filter of that language is expected to give. The largest count decides.

The filters are built from about ``sample`` documents per language, drawn by a hash of doc_id while the table is
scanned, so no text is shuffled. They hold at most ``max_grams`` n-grams each, which bounds what reaches the driver;
one number per language is sent back to the scan. Prediction reads whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import by_slices, slices
from .words import mixed, utf8, word_bytes

GRAM = 4
SAMPLE = 2000
MAX_GRAMS = 30_000
MIN_COUNT = 8
SHARE = 0.5
SLOTS = 1 << 20
PROBES = 3
PLANE = 8
UNKNOWN = "und"
SEED = 5


@dataclass
class Filters:
    """Languages by falling frequency, and per plane of eight of them the table of bitmasks."""

    languages: list[str]
    planes: list[np.ndarray]
    false_rate: np.ndarray


def grams(column: pa.Array, size: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(text, n-gram) for every run of ``size`` bytes; all but letters and longer code points read as a space.

    A run of spaces counts as one, and a text begins and ends with one. Digits read as spaces too.
    """
    data, offsets = utf8(pc.utf8_lower(column))
    letters = word_bytes()[data] & ~((data >= 48) & (data <= 57))
    plain = np.where(letters, data, 32).astype(np.uint8)
    # A space after every text.
    n = len(column)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    plain = np.insert(plain, offsets[1:], 32)
    owner = np.insert(owner, offsets[1:], np.arange(n))
    blank = plain == 32
    kept = ~(blank & np.concatenate([[True], blank[:-1]]))
    plain, owner = plain[kept].astype(np.uint32), owner[kept]
    if len(plain) < size:
        return owner[:0], plain[:0].astype(np.uint64)
    n_grams = len(plain) - size + 1
    codes = np.zeros(n_grams, np.uint64 if size > 4 else np.uint32)
    for k in range(size):
        codes = (codes << 8) | plain[k : k + n_grams]
    inside = owner[:n_grams] == owner[size - 1 :]
    return owner[:n_grams][inside], codes[inside].astype(np.uint64)


def held_out(doc_id="doc_id"):
    """Whether a document is kept from training."""
    name = F.encode(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "UTF-8")
    return F.crc32(name) % 4 == 2


def train(docs: DataFrame, sample: int = SAMPLE, max_grams: int = MAX_GRAMS) -> Filters:
    """Filters from documents that are not held out and have a language and a text.

    An n-gram belongs to a language if that has at least ``SHARE`` of the largest rate that any language has.
    Without such documents there are no languages.
    """
    known = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = dict(known.groupBy("lang").count().collect())
    shares = docs.sparkSession.createDataFrame(
        [(name, min(1.0, sample / n)) for name, n in sizes.items()], "lang string, __share double"
    )
    draw = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 30)) / (1 << 30)
    chosen = known.join(F.broadcast(shares), "lang").where(draw < F.col("__share"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                text, codes = grams(part.column("text"))
                names, kinds = np.unique(part.column("lang").to_numpy(False).astype(str), return_inverse=True)
                for kind, name in enumerate(names):
                    own, n = np.unique(codes[kinds[text] == kind], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(own), pa.string()), pa.array(own.view(np.int64)), pa.array(n)],
                        ["lang", "gram", "n"],
                    )

    counts = (
        chosen.select("lang", "text")
        .mapInArrow(count, "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    by_lang = W.partitionBy("lang")
    rates = counts.withColumn("rate", F.col("n") / F.sum("n").over(by_lang)).withColumn(
        "best", F.max("rate").over(W.partitionBy("gram"))
    )
    frequent = by_lang.orderBy(F.desc("n"), "gram")
    members = (
        rates.where((F.col("n") >= MIN_COUNT) & (F.col("rate") >= SHARE * F.col("best")))
        .withColumn("__nth", F.row_number().over(frequent))
        .where(F.col("__nth") <= max_grams)
        .groupBy("lang")
        .agg(F.collect_list("gram").alias("grams"))
        .collect()
    )
    grams_of = {row["lang"]: np.array(row["grams"], np.int64).view(np.uint64) for row in members}
    return build(grams_of, sorted(sizes, key=lambda name: (-sizes[name], name)))


def _probes(codes: np.ndarray) -> list[np.ndarray]:
    bits = mixed(codes + np.uint64(1))
    width = SLOTS.bit_length() - 1
    return [((bits >> np.uint64(width * k)) & np.uint64(SLOTS - 1)).astype(np.int32) for k in range(PROBES)]


def build(grams_of: dict[str, np.ndarray], languages: list[str]) -> Filters:
    planes = [np.zeros(SLOTS, np.uint8) for _ in range(0, len(languages), PLANE)]
    rates = np.zeros(len(languages))
    for number, name in enumerate(languages):
        plane, bit = planes[number // PLANE], np.uint8(1 << number % PLANE)
        for slots in _probes(grams_of.get(name, np.empty(0, np.uint64))):
            plane[slots] |= bit
        rates[number] = np.mean(plane & bit != 0) ** PROBES
    return Filters(languages, planes, rates)


def predict(column: pa.Array, filters: Filters) -> pa.Array:
    """lang_pred and score of every text."""
    n = len(column)
    text, codes = grams(column)
    ends = np.searchsorted(text, np.arange(n + 1))
    total = np.diff(ends)
    counts = np.zeros((n, len(filters.languages)))
    probes = _probes(codes)
    for number, plane in enumerate(filters.planes):
        mask = plane[probes[0]]
        for slots in probes[1:]:
            mask &= plane[slots]
        for bit in range(min(PLANE, len(filters.languages) - number * PLANE)):
            hits = np.concatenate([[0], np.cumsum((mask >> bit) & 1, dtype=np.int64)])
            counts[:, number * PLANE + bit] = np.diff(hits[ends])
    expected = total[:, None] * filters.false_rate
    counts = np.maximum(counts - expected, 0) / (1 - filters.false_rate)
    lettered = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(False)
    if not filters.languages:
        lettered = np.zeros(n, bool)
        counts = np.zeros((n, 1))
    best, sums = counts.argmax(1), counts.sum(1)
    score = np.where(lettered, counts.max(1) / np.maximum(sums, 1e-9), 0.0)
    names = np.array([*filters.languages, UNKNOWN], object)
    chosen = names[np.where(lettered, best, len(names) - 1)]
    return pa.StructArray.from_arrays(
        [pa.array(chosen, pa.string()), pa.array(np.clip(score, 0, 1))], ["lang_pred", "score"]
    )


def predictor(docs: DataFrame, filters: Filters):
    """A function of a text column: lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    return F.arrow_udf(
        lambda texts: by_slices(lambda part: predict(part, shared.value), texts),
        "lang_pred string, score double",
    )


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row; source and other columns are ignored.

    A text that is null or has no letters gets ``und`` and score 0. A text whose n-grams no filter holds gets the
    most frequent learned language and score 0, and equal counts go to the more frequent one. A null doc_id is not
    held out. Repeated rows are predicted alike; no rows give none.
    """
    language = predictor(docs, train(docs, sample))
    return docs.select("doc_id", held_out().alias("held_out"), language("text").alias("l")).select(
        "doc_id", "held_out", "l.lang_pred", "l.score"
    )


def select(docs: DataFrame, least: float = 0.0) -> DataFrame:
    """The documents whose text has a language with at least the score ``least``, with all their columns."""
    language = predictor(docs, train(docs))("text")
    return docs.withColumn("__language", language).where(
        (F.col("__language.lang_pred") != UNKNOWN) & (F.col("__language.score") >= least)
    ).drop("__language")

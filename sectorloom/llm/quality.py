"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades 0 (bad), 1 (well written but toxic) and 2 (good) share one weight per text feature; ordered thresholds turn
the sum of weights into P(grade <= j). A document is selected by the tail probability of the top grade.

Features are the hashes of a document's distinct words, of their first four, five, seven and eight bytes, and of a few bucketed traits: shares of symbols, capitals
and repeated words, and length. A word that was never seen has no weight.

The model is fitted on at most ``SAMPLE`` labelled documents, those of the smallest hashes of doc_id; that bounds what reaches the
driver. A feature counts if it marks lower grades: of the n documents that have it k are of a low grade, whose share in
all is p < k/n, and chance gives as much with a probability of at most exp(-n KL(k/n, p)), which must be below
``BY_CHANCE`` of the number of features. So a few documents are enough for a clear mark, however many labels there are.
Weights are evidence against a document and never above zero: else the many indifferent words of a long text would
outweigh the few that matter. The tail probability that selects is the one that keeps ``KEEP`` of the good documents of
the sample. Every document is scored in full.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_slices, discard, slices, written
from .words import Words, counted, mixed, utf8, word_bytes, words

SAMPLE = 10_000
BY_CHANCE = 50
KEEP = 0.985
PREFIXES = (4, 5, 7, 8)
STEPS = 300
RIDGE = 0.05
GRADES = 3
TOP = 2
# The tail probability that selects where no good document is labelled.
CUT = 0.5


@dataclass
class Model:
    """Feature hashes in order and their weights, the ordered thresholds, and the tail probability that selects."""

    keys: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray
    cut: float = CUT

    def eta(self, text: np.ndarray, hashes: np.ndarray, texts: int) -> np.ndarray:
        """The sum of the weights of each text's features."""
        if not len(self.keys):
            return np.zeros(texts)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        known = np.flatnonzero(self.keys[at] == hashes)
        return np.bincount(text[known], weights=self.weights[at[known]], minlength=texts)

    def probabilities(self, eta: np.ndarray) -> np.ndarray:
        """P(grade = j) per row."""
        return np.diff(_cumulative(eta, self.thresholds), axis=1)


def _cumulative(eta: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    inner = 1 / (1 + np.exp(-np.clip(thresholds[None, :] - eta[:, None], -35, 35)))
    return np.hstack([np.zeros((len(eta), 1)), inner, np.ones((len(eta), 1))])


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every feature of every text; a text without words has its traits only."""
    found = words(column, PREFIXES)
    parts = [counted(found), *(counted(replace(found, hashes=h)) for h in found.prefixes.values())]
    traits = _traits(column, found)
    kinds = np.arange(traits.shape[1], dtype=np.uint64) * np.uint64(1000)
    of_traits = mixed(traits.astype(np.uint64) + kinds[None, :] + np.uint64(1 << 40)) >> np.uint64(16)
    return (
        np.concatenate([*(x[0] for x in parts), np.repeat(np.arange(len(column)), traits.shape[1])]),
        np.concatenate([*(x[1] for x in parts), of_traits.ravel()]),
    )


def _traits(column: pa.Array, found: Words) -> np.ndarray:
    data, offsets = utf8(column)
    n_words = np.diff(found.offsets)
    upper = (data >= 65) & (data <= 90)
    letters = word_bytes()[data]
    usual = np.isin(data, np.frombuffer(b" \n\t\r.,;:'\"-()?", np.uint8))
    again = np.zeros(len(found.hashes), bool)
    again[1:] = (found.hashes[1:] == found.hashes[:-1]) & (found.text[1:] == found.text[:-1])

    def total(flags: np.ndarray, places: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[places])

    def tenths(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return np.ceil(10 * np.minimum(part / np.maximum(whole, 1), 1)).astype(np.int64)

    return np.stack(
        [
            tenths(total(~letters & ~usual, offsets), n_words),
            tenths(total(upper, offsets), total(letters, offsets)),
            tenths(total(again, found.offsets), n_words),
            np.log2(n_words + 1).astype(np.int64),
        ],
        axis=1,
    )


def grade(quality: str = "quality", toxic: str = "toxic"):
    """The grade of a label: 0 for bad quality, 1 for toxic text of good quality, else 2."""
    return (
        F.when(F.col(quality) == 0, 0).when(F.coalesce(F.col(toxic), F.lit(0)) != 0, 1).otherwise(TOP)
    )


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model fitted on a bounded sample of labelled documents.

    A label without quality, or without its document, does not count; of several labels of a document the worst
    does. Without labels every document gets the top grade.
    """
    rated = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.min(grade()).alias("grade"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                text, hashes = features(part.column("text"))
                order = np.argsort(text, kind="stable")
                counts = np.bincount(text, minlength=len(part))
                lists = pa.ListArray.from_arrays(
                    np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), hashes[order].view(np.int64)
                )
                yield pa.RecordBatch.from_arrays([part.column("grade"), lists], ["grade", "features"])

    examples, examples_at = written(
        docs.select("doc_id", "text")
        .join(F.broadcast(rated), "doc_id")
        .select("grade", "text")
        .mapInArrow(extract, "grade int, features array<bigint>"),
        "ratings",
    )
    kept, keys_at = _marks(examples)
    index = np.sort(kept)

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("features")
            flat = lists.flatten().to_numpy()
            owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            at = np.minimum(np.searchsorted(index, flat), max(len(index) - 1, 0))
            known = index[at] == flat if len(index) else np.zeros(len(flat), bool)
            sizes = np.bincount(owner[known], minlength=len(lists))
            short = pa.ListArray.from_arrays(
                np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), at[known].astype(np.int32)
            )
            yield pa.RecordBatch.from_arrays([batch.column("grade"), short], ["grade", "features"])

    rows = examples.mapInArrow(shorten, "grade int, features array<int>").toArrow().combine_chunks()
    discard(docs.sparkSession, examples_at, keys_at)
    if not rows.num_rows:
        return Model(np.empty(0, np.uint64), np.empty(0), np.array([-30.0, -20.0]))
    lists = rows.column("features").combine_chunks()
    lists = lists if isinstance(lists, pa.ListArray) else lists.chunk(0)
    flat, lengths = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
    grades = rows.column("grade").to_numpy()
    weights, thresholds = fit(flat, lengths, grades, len(index))
    order = np.argsort(index.view(np.uint64))
    model = Model(index.view(np.uint64)[order], weights[order], thresholds)
    good = grades == TOP
    if good.any():
        owner = np.repeat(np.arange(len(lengths)), lengths)
        eta = np.bincount(owner, weights=weights[flat], minlength=len(grades))
        # A hair lower, so that equal probabilities count as equal.
        model.cut = float(np.quantile(model.probabilities(eta[good])[:, TOP], 1 - KEEP, method="lower")) * (1 - 1e-9)
    return model


def _marks(examples: DataFrame) -> tuple[np.ndarray, str]:
    """The features that mark lower grades, and the folder of their counts."""
    shares = dict(examples.groupBy("grade").count().collect())
    counts, folder = written(
        examples.select("grade", F.explode("features").alias("feature"))
        .groupBy("feature")
        .agg(*[F.count_if(F.col("grade") == g).alias(f"n{g}") for g in range(GRADES)]),
        "features",
    )
    least = F.lit(float(np.log(max(counts.count(), 1) / BY_CHANCE)))
    marked = F.lit(False)
    for low, high in (((0,), (1, 2)), ((0, 1), (2,)), ((1,), (2,))):
        few, many = (sum(shares.get(g, 0) for g in side) for side in (low, high))
        if not few or not many:
            continue
        p = few / (few + many)
        k, n = (sum((F.col(f"n{g}") for g in side), F.lit(0)) for side in (low, low + high))
        q = k / F.nullif(n, F.lit(0))
        distance = F.when(q == 1, q * F.log(q / p)).otherwise(q * F.log(q / p) + (1 - q) * F.log((1 - q) / (1 - p)))
        marked = marked | F.coalesce((q > p) & (n * distance >= F.greatest(least, F.lit(1.0))), F.lit(False))
    found = counts.where(marked).select("feature").collect()
    return np.array([row[0] for row in found], np.int64), folder


def fit(
    flat: np.ndarray, lengths: np.ndarray, grades: np.ndarray, n_features: int
) -> tuple[np.ndarray, np.ndarray]:
    """Weights, none above zero, and ordered thresholds of least penalised log loss, by full-gradient steps of adaptive size.

    The first threshold and the logarithms of the gaps are free, so the thresholds keep their order.
    """
    owner = np.repeat(np.arange(len(lengths)), lengths)
    shares = np.bincount(grades, minlength=GRADES) / len(grades)
    below = np.clip(np.cumsum(shares)[:-1], 1e-3, 1 - 1e-3)
    start = np.log(below / (1 - below))
    free = np.concatenate([[start[0]], np.log(np.maximum(np.diff(start), 1e-2)), np.zeros(n_features)])
    m, v = np.zeros_like(free), np.zeros_like(free)
    cuts = GRADES - 1
    rows = np.arange(len(grades))
    for step in range(1, STEPS + 1):
        gaps = np.exp(free[1:cuts])
        thresholds = free[0] + np.concatenate([[0], np.cumsum(gaps)])
        weights = free[cuts:]
        eta = np.bincount(owner, weights=weights[flat], minlength=len(grades))
        cumulative = _cumulative(eta, thresholds)
        p = np.maximum(cumulative[rows, grades + 1] - cumulative[rows, grades], 1e-9)
        slope = cumulative * (1 - cumulative)
        high, low = slope[rows, grades + 1] / p, slope[rows, grades] / p
        by_eta = high - low
        by_threshold = np.zeros(cuts)
        for j in range(cuts):
            by_threshold[j] = -high[grades == j].sum() + low[grades == j + 1].sum()
        by_weight = np.bincount(flat, weights=by_eta[owner], minlength=n_features) + RIDGE * weights
        by_gap = [by_threshold[j:].sum() * gaps[j - 1] for j in range(1, cuts)]
        gradient = np.concatenate([[by_threshold.sum()], by_gap, by_weight])
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        rate = 0.2 * (1 - step / (STEPS + 1))
        free = free - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        free[cuts:] = np.minimum(free[cuts:], 0)
    gaps = np.exp(free[1:cuts])
    return free[cuts:], free[0] + np.concatenate([[0], np.cumsum(gaps)])


def scorer(docs: DataFrame, model: Model, cut: float | None = None):
    """A function of a text column: expected_grade, top_probability and selected. A null text counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    cut = model.cut if cut is None else cut

    def score(column: pa.Array) -> pa.Array:
        model = shared.value
        text, hashes = features(column)
        p = model.probabilities(model.eta(text, hashes, len(column)))
        expected, tail = p @ np.arange(GRADES), p[:, TOP]
        return pa.StructArray.from_arrays(
            [pa.array(expected), pa.array(tail), pa.array(tail >= cut)],
            ["expected_grade", "top_probability", "selected"],
        )

    return F.arrow_udf(
        lambda texts: by_slices(score, texts),
        "expected_grade double, top_probability double, selected boolean",
    )


def classify(docs: DataFrame, labels: DataFrame, cut: float | None = None) -> DataFrame:
    """(doc_id, expected_grade, top_probability, selected) of every row; other columns are ignored.

    Repeated rows are scored alike; no rows give none.
    """
    score = scorer(docs, train(docs, labels), cut)
    return docs.select("doc_id", score("text").alias("score")).select("doc_id", "score.*")


def select(docs: DataFrame, labels: DataFrame, cut: float | None = None) -> DataFrame:
    """The selected documents with all their columns."""
    score = scorer(docs, train(docs, labels), cut)
    return docs.where(score("text").getField("selected"))

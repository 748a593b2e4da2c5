"""Token ids in binary files by Simple-8b word-aligned coding.

A 64-bit word holds a four-bit selector and 60 bits of payload: as many ids of one width as fit. The selector names
the pair of count and width, from 60 ids of one bit to one id of 60 bits. Selector 15 is an escape: the next word
is a single raw 64-bit value. Ids are cut into blocks of ``BLOCK`` ids; a block begins a new word, its last word
may be partly filled, and the offset of every block is stored, so blocks are decoded independently, all words
of one selector at once.

The files are Parquet containers, so any shared store can hold them and a task that is run again replaces its own
output. A row is a segment of whole documents in ascending order: part, ids before it in its part, the doc_ids, the
number of ids of each, the words, and the block offsets.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import per_stage, slices
from .pieces import PieceEncoder, flat

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
BLOCK = 1024
SEGMENT_BYTES = 1 << 20
WORDS_AT_ONCE = 256

# Count and width of selectors 0 to 13.
SELECTORS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
ESCAPE = 15

SEGMENTS = "part int, part_start long, doc_ids array<bigint>, counts array<bigint>, words binary, blocks binary"


def pack(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """The words of ``ids`` (unsigned 64-bit), and the index of the first word of every block."""
    n = len(ids)
    if not n:
        return np.empty(0, "<u8"), np.empty(0, "<u4")
    place = np.arange(n, dtype=np.int32)
    end = np.minimum((place // block + 1) * block, n).astype(np.int32)
    selector = np.full(n, ESCAPE, np.uint8)
    widths = np.frexp(ids.astype(np.float64))[1] if n and ids.max() < 2**53 else _widths(ids)
    # From wide to narrow: a narrower selector holds at least as many ids, so the last that fits is the best.
    for number, most in _widest(widths.astype(np.uint8), block):
        selector[most <= SELECTORS[number][1]] = number
    held = np.array([count for count, _ in SELECTORS] + [0, 1], np.int32)
    reach = np.minimum(held[selector], end - place)
    step, heads, at = (place + reach).tolist(), [], 0
    while at < n:
        heads.append(at)
        at = step[at]
    head = np.array(heads, np.int64)
    kind = selector[head]
    size = 1 + (kind == ESCAPE)
    first = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    words[first] = kind.astype(np.uint64) << np.uint64(60)
    padded = np.concatenate([ids, np.zeros(60, ids.dtype)])
    for number, (count, width) in enumerate(SELECTORS):
        of_kind = np.flatnonzero(kind == number)
        if not len(of_kind):
            continue
        begin = head[of_kind]
        taken, payload = reach[begin], np.zeros(len(begin), np.uint64)
        for k in range(int(taken.max())):
            payload |= np.where(k < taken, padded[begin + k], np.uint64(0)) << np.uint64(k * width)
        words[first[of_kind]] |= payload
    escaped = kind == ESCAPE
    words[first[escaped] + 1] = ids[head[escaped]]
    return words.astype("<u8"), first[np.searchsorted(head, np.arange(0, n, block))].astype("<u4")


def _widest(widths: np.ndarray, block: int) -> Iterator[tuple[int, np.ndarray]]:
    """Per selector, the last first: the greatest width among as many ids from each on as it holds, within the block."""
    n, longest = len(widths), SELECTORS[0][0]
    # Nothing follows a block but zeros, which fit everywhere.
    rows = np.zeros((-(-n // block), block + longest), np.uint8)
    whole = np.zeros(len(rows) * block, np.uint8)
    whole[:n] = widths
    rows[:, :block] = whole.reshape(-1, block)

    def joined(level: np.ndarray, by: int) -> np.ndarray:
        out = level.copy()
        np.maximum(level[:-by], level[by:], out=out[:-by])
        return out

    level, reached = rows.ravel(), 1
    for number in range(len(SELECTORS) - 1, -1, -1):
        count = SELECTORS[number][0]
        while 2 * reached <= count:
            level, reached = joined(level, reached), 2 * reached
        most = joined(level, count - reached) if count > reached else level
        yield number, most.reshape(rows.shape)[:, :block].reshape(-1)[:n]


def _widths(ids: np.ndarray) -> np.ndarray:
    """Bits of each id, exact beyond the integers that doubles hold."""
    high = np.frexp((ids >> np.uint64(32)).astype(np.float64))[1]
    low = np.frexp((ids & np.uint64(2**32 - 1)).astype(np.float64))[1]
    return np.where(high > 0, high + 32, low)


def unpack(words: np.ndarray, blocks: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The ``n`` ids of :func:`pack`."""
    if not n:
        return np.empty(0, np.uint64)
    kind = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    # A raw value follows its escape and may itself look like one; within a block they are told apart in order.
    for at in np.flatnonzero(kind == ESCAPE).tolist():
        if not raw[at]:
            raw[at + 1] = True
    counts = np.array([count for count, _ in SELECTORS] + [0, 1])[kind]
    counts[raw] = 0
    # The last word of a block holds no more than the block has left.
    lengths = np.minimum(block, n - block * np.arange(len(blocks)))
    bounds = np.append(blocks.astype(np.int64), len(words))
    before = np.concatenate([[0], np.cumsum(counts)])
    of_block = np.repeat(np.arange(len(blocks)), np.diff(bounds))
    start = before[:-1] - before[bounds[:-1]][of_block]
    counts = np.minimum(counts, lengths[of_block] - start)
    first = np.cumsum(counts) - counts
    ids = np.zeros(n, np.uint64)
    for number, (count, width) in enumerate(SELECTORS):
        of_kind = np.flatnonzero((kind == number) & ~raw)
        mask = np.uint64((1 << width) - 1)
        for k in range(count if len(of_kind) else 0):
            live = of_kind[counts[of_kind] > k]
            ids[first[live] + k] = (words[live] >> np.uint64(k * width)) & mask
    escapes = np.flatnonzero((kind == ESCAPE) & ~raw)
    ids[first[escapes]] = words[escapes + 1]
    return ids


def _encoder(path: str) -> tuple[PieceEncoder, dict[str, int], re.Pattern]:
    """An encoder with the tokenizer's added tokens. Each match of its own pattern is encoded by it.

    Matches of letters, with or without a space before them, are given to it many at once, as lines: a line feed
    between two of them is a match of its own, and no token of letters holds its byte. The other matches go one by one.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    added = {}
    for number, token in tokenizer.get_added_tokens_decoder().items():
        if token.lstrip or token.rstrip or token.single_word or token.normalized:
            raise ValueError(f"added token {token.content!r} of {path} is not matched literally")
        added[token.content] = number
    longest_first = sorted(added, key=len, reverse=True)

    def each(texts: list[str]) -> list[list[int]]:
        return [found.ids for found in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    feed = each(["\n"])[0]

    def encode_words(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        letters = np.array([word[word[0] == " " :].isalpha() for word in words], bool)
        lined = np.flatnonzero(letters).tolist() if len(feed) == 1 else []
        lines = [
            "".join([words[i] + "\n" for i in lined[at : at + WORDS_AT_ONCE]])
            for at in range(0, len(lined), WORDS_AT_ONCE)
        ]
        ids, _ = flat(each(lines))
        ends = np.flatnonzero(ids == feed[0])
        if len(ends) != len(lined) or len(lined) == 0:
            return flat(each(words))
        sizes = np.diff(ends, prepend=-1) - 1
        alone, lengths = flat(each([words[i] for i in np.flatnonzero(~letters).tolist()]))
        # Both kinds back in the order of the words.
        counts = np.empty(len(words), np.int64)
        counts[letters], counts[~letters] = sizes, lengths
        of_letters = np.repeat(letters, counts)
        out = np.empty(len(of_letters), np.int32)
        out[of_letters], out[~of_letters] = np.delete(ids, ends), alone
        return out, counts

    pattern = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")")
    return PieceEncoder(encode_words, public_tokenizers.PATTERN), added, pattern


def encode(column: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the tokenizer's own ``encode`` of every whole text, one after the other, and how many each has.

    A text is cut at the added tokens in it, as the tokenizer does; these have an id of their own, and only the
    stretches between them go to the pieces.
    """
    pieces, added, pattern = per_stage(_encoder, path)
    if not any(pc.any(pc.match_substring(column, content)).as_py() for content in added):
        return pieces.encode(column)
    cut = [pattern.split(text or "") for text in column.to_pylist()]
    ids, counts = pieces.encode(pa.array([stretch for own in cut for stretch in own[::2]], pa.string()))
    ends = np.cumsum([len(own) // 2 + 1 for own in cut])
    followed = np.ones(len(counts), np.int64)
    followed[ends - 1] = 0
    found = np.array([added[token] for own in cut for token in own[1::2]], ids.dtype)
    ids = np.insert(ids, np.cumsum(counts)[followed > 0], found)
    return ids, np.add.reduceat(counts + followed, np.concatenate([[0], ends[:-1]]))


def write(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID) -> None:
    """Write the ids of ``docs`` (doc_id, text) as files below ``folder``, in ascending order of doc_id.

    A null or empty text has the end id alone. A null doc_id comes first; repeated doc_ids are documents of
    their own, ordered by text. No rows give no segments.
    """
    path = path or public_tokenizers.path(TOKENIZER)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for run in slices(batch, "text", SEGMENT_BYTES):
                ids, counts = encode(run.column("text"), path)
                ids = np.insert(ids, np.cumsum(counts), end_id).astype(np.uint64)
                counts = counts + 1
                words, blocks = pack(ids)
                whole = np.array([0, len(run)], np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int32()),
                        pa.array([before], pa.int64()),
                        pa.ListArray.from_arrays(whole, run.column("doc_id").cast(pa.int64())),
                        pa.ListArray.from_arrays(whole, pa.array(counts, pa.int64())),
                        pa.array([words.tobytes()], pa.binary()),
                        pa.array([blocks.tobytes()], pa.binary()),
                    ],
                    ["part", "part_start", "doc_ids", "counts", "words", "blocks"],
                )
                before += len(ids)

    (
        docs.select("doc_id", "text")
        .repartitionByRange("doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(segments, SEGMENTS)
        .write.parquet(folder)
    )


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files; ``start`` counts the ids of all before it.

    ``ids`` are little-endian unsigned 32-bit integers. Only the totals of the parts, one row for each
    task that wrote, are summed in one task and sent to all.
    """
    segments = spark.read.schema(SEGMENTS).parquet(folder)
    own = F.aggregate("counts", F.lit(0).cast("bigint"), lambda total, n: total + n)
    totals = segments.groupBy("part").agg(F.max(F.col("part_start") + own).alias("__ids"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = totals.select(
        F.col("part").alias("__part"), F.coalesce(F.sum("__ids").over(before), F.lit(0)).alias("base")
    )

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                counts = np.array(batch.column("counts")[i].values)
                words = np.frombuffer(batch.column("words")[i].as_buffer(), "<u8")
                blocks = np.frombuffer(batch.column("blocks")[i].as_buffer(), "<u4")
                ids = unpack(words, blocks, int(counts.sum())).astype("<u4")
                ends = np.cumsum(counts)
                start = batch.column("base")[i].as_py() + batch.column("part_start")[i].as_py()
                offsets = pa.py_buffer((np.concatenate([[0], ends]) * 4).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_ids")[i].values,
                        pa.array(start + ends - counts),
                        pa.array(counts),
                        pa.Array.from_buffers(
                            pa.binary(), len(counts), [None, offsets, pa.py_buffer(ids.tobytes())]
                        ),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return (
        segments.join(F.broadcast(bases), F.col("part") == F.col("__part"))
        .drop("part", "__part")
        .mapInArrow(documents, "doc_id long, start long, n_tokens long, ids binary")
    )



def listing(docs: DataFrame, folder: str, path: str | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the files that :func:`write` makes below ``folder``."""
    write(docs, folder, path)
    return read(docs.sparkSession, folder).withColumn("ids_crc32", F.crc32("ids")).drop("ids")

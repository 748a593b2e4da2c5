"""Exact top-k search by inner product over a vector-approximation file.

Every vector is kept twice, in chunks of bounded size: as cells of a coarse grid (one byte per component) and
exactly. Bounds of the inner product follow from the cells alone. A first scan of the cells gives, per query,
the k-th best lower bound over all chunks. A second scan reads exact vectors in the order of their best
possible score and stops when no unread cell can reach the k-th result.

Queries come in passes of bounded bytes, each of which scans the chunks twice. The queries of a pass are broadcast and
meet the chunks in blocks, and a task keeps the k best of what it has scanned for each of them. So no pair of a
chunk and a query is written, joined or sent anywhere, and neither the driver nor a task holds more than a pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialised, release, written

SCALE = 256
K = 5
QUERY_STEP = 50
CELLS = 32
CHUNK_ROWS = 4096
BLOCK_QUERIES = 512
# What a task holds for the queries of a pass: their components and their results.
PASS_BYTES = 16 << 20
# Chunks in a file of the approximation file.
FILE_CHUNKS = 4

_NEAREST = "query_id long, vec_id long, score long"
_PACKED = "dims int, ids binary, cells binary, exact binary"


def quantised(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, vec): components as floor(scale * x). Rows that hold a null, NaN or infinity are left out."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
        .where(finite)
        .select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("vec"),
        )
    )


def top_k(
    embeddings: DataFrame,
    k: int = K,
    query_step: int = QUERY_STEP,
    scale: int = SCALE,
    chunk_rows: int = CHUNK_ROWS,
    block_queries: int = BLOCK_QUERIES,
    pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for every row whose id ``query_step`` divides.

    Ties go to the smaller vec_id. A row never answers a query of its own id. Repeated rows are rows of their own among
    the results, of which a query needs no more than k of them, and one query; rows with
    a null id or with null or non-finite components take no part; vectors of different lengths are never
    compared; empty vectors score 0. Scores are 64-bit integers that wrap as Spark's do. Other columns are ignored.
    """
    counted = quantised(embeddings, scale).groupBy("vec_id", "vec").agg(F.count("*").alias("n"))
    # More than k equal rows can't all be among k results.
    copies = F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)).cast("int"))).alias("copy")
    vectors = materialised(counted.select("vec_id", "vec", copies), "vectors")
    asks = (F.col("vec_id") % query_step == 0) & (F.col("copy") == 1)
    total, low, high, asking, components = vectors.agg(
        F.count("*"),
        F.min(F.array_min("vec")),
        F.max(F.array_max("vec")),
        F.count_if(asks),
        F.sum(F.when(asks, F.size("vec"))),
    ).first()
    chunks = max(1, -(-total // chunk_rows))
    grid = _grid(low or 0, high or 0)
    dims = F.size("vec").alias("dims")
    place = F.xxhash64("vec_id", "vec", "copy")
    row = F.struct("vec_id", "vec")
    by_chunk = (
        vectors.groupBy(dims, F.pmod(place, F.lit(chunks)).alias("chunk"))
        .agg(F.collect_list(row).alias("rows"))
        .repartition(-(-chunks // FILE_CHUNKS), "dims", "chunk")
    )
    va_file = materialised(by_chunk.mapInArrow(_packer(grid), f"chunk long, {_PACKED}"), "va-file")
    passes = max(1, -(-((components or 0) * 8 + asking * k * 16) // pass_bytes))
    blocks = max(passes, -(-asking // block_queries))
    by_block = (
        vectors.where(asks)
        .groupBy(dims, F.pmod(place, F.lit(blocks)).alias("chunk"))
        .agg(F.collect_list(row).alias("rows"))
    )
    queries = materialised(
        by_block.mapInArrow(_packer(grid), f"chunk long, {_PACKED}").select(
            "dims", F.col("chunk").alias("block"), "ids", "exact"
        ),
        "queries",
    )
    folders = []
    for number in range(passes):
        own = queries.where(F.pmod("block", F.lit(passes)) == number).select("dims", "ids", "exact")
        folders.append(_one_pass(va_file, own, grid, k))
    nearest = embeddings.sparkSession.read.schema(_NEAREST).parquet(*folders)
    return _best(nearest, k).select("query_id", "rank", "vec_id", "score")


def _best(found: DataFrame, k: int) -> DataFrame:
    ranked = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def _one_pass(va_file: DataFrame, queries: DataFrame, grid: Grid, k: int) -> str:
    """The folder of (query_id, vec_id, score), the k best rows for each of some packed queries."""
    context = va_file.sparkSession.sparkContext
    blocks = [(dims, bytes(ids), bytes(exact)) for dims, ids, exact in queries.collect()]
    asked = context.broadcast(blocks)
    lower = va_file.select("dims", "ids", "cells").mapInArrow(
        _lower_bounds(asked, grid, k), "dims int, query_id long, bound long"
    )
    best_first = W.partitionBy("dims", "query_id").orderBy(F.desc("bound"))
    kth = (
        lower.withColumn("__nth", F.row_number().over(best_first))
        .where(F.col("__nth") == k)
        .select("dims", "query_id", "bound")
    )
    known = {(dims, query): bound for dims, query, bound in materialised(kth, "bounds").collect()}
    bounds = [
        np.array([known.get((dims, x), _NONE) for x in np.frombuffer(ids, "<i8").tolist()], np.int64)
        for dims, ids, _ in blocks
    ]
    needed = context.broadcast(bounds)
    found = va_file.select("dims", "ids", "cells", "exact").mapInArrow(
        _exact_scores(asked, needed, grid, k), _NEAREST
    )
    folder = written(_best(found, k).drop("rank"), "nearest")[1]
    asked.destroy()
    needed.destroy()
    return folder


class Grid(NamedTuple):
    """Cells of ``width`` values from ``low`` up; the narrowest type of a component; no corner is beyond ``most``."""

    low: int
    width: int
    kind: str
    most: int

    def bounded(self, dims: int) -> bool:
        """Whether bounds hold: no sum of so many products leaves 64 bits."""
        return dims * self.most**2 < 1 << 62


def _grid(low: int, high: int) -> Grid:
    width = max(1, -(-(high - low + 1) // CELLS))
    kinds = ("<i2", "<i4", "<i8")
    kind = next(x for x in kinds if np.iinfo(x).min <= low and high <= np.iinfo(x).max)
    return Grid(low, width, kind, max(abs(low), abs(high)) + width)


def _packer(grid: Grid):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dims, chunk, rows in zip(*(batch.column(c) for c in ("dims", "chunk", "rows"))):
                members = rows.values
                ids = members.field("vec_id").to_numpy(zero_copy_only=False).astype("<i8")
                flat = members.field("vec").flatten().to_numpy(zero_copy_only=False).astype("<i8")
                cells = ((flat - grid.low) // grid.width).astype(np.uint8)
                yield pa.RecordBatch.from_pylist(
                    [
                        {
                            "chunk": chunk.as_py(),
                            "dims": dims.as_py(),
                            "ids": ids.tobytes(),
                            "cells": cells.tobytes(),
                            "exact": flat.astype(grid.kind).tobytes(),
                        }
                    ],
                    schema=_PACKED_ARROW,
                )

    return pack


_PACKED_ARROW = pa.schema(
    [
        ("chunk", pa.int64()),
        ("dims", pa.int32()),
        ("ids", pa.binary()),
        ("cells", pa.binary()),
        ("exact", pa.binary()),
    ]
)


_NONE = np.iinfo(np.int64).min + 1
_MOST = np.iinfo(np.int64).max
_SLAB = 64
_SLAB_VALUES = 1 << 20


class Block:
    """Queries of one length, with what a task has found for them."""

    def __init__(self, dims: int, ids: bytes, exact: bytes, grid: Grid):
        self.dims = dims
        self.ids = np.frombuffer(ids, "<i8")
        self.queries = np.frombuffer(exact, grid.kind).reshape(len(self.ids), dims).astype(np.int64)


def _blocks(asked: Broadcast, grid: Grid) -> list[Block]:
    return [Block(*x, grid) for x in asked.value]


def _chunks(batches: Iterator[pa.RecordBatch], grid: Grid) -> Iterator[tuple]:
    """The length, ids and exact vectors, if any, of each chunk, and the lowest corner of every cell."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            dims, ids = row["dims"], np.frombuffer(row["ids"], "<i8")
            cells = np.frombuffer(row["cells"], np.uint8).reshape(len(ids), dims)
            exact = np.frombuffer(row["exact"], grid.kind).reshape(len(ids), dims) if "exact" in row else None
            yield dims, ids, grid.low + grid.width * cells.astype(np.int64), exact
    release()


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """left @ right.T; as floats only where every partial sum is exact in them."""
    largest = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * left.shape[1]
    for kind, exact_below in _EXACT_BELOW.items():
        if largest < exact_below:
            return left.astype(kind) @ right.astype(kind).T
    return left @ right.T


_EXACT_BELOW = {np.float32: 2**24, np.float64: 2**53}


def _reach(products: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the products that are ``least`` of their row or more."""
    if products.dtype.kind == "f":  # least in their type: all of them are within the bounds
        most = _EXACT_BELOW[products.dtype.type]
        least = np.clip(least, -most, most).astype(products.dtype)
    some = np.flatnonzero(products.max(1) >= least)  # far cheaper than to look at each of them
    rows, columns = np.divmod(np.flatnonzero(products[some] >= least[some, None]), products.shape[1])
    return some[rows], columns


def _bounds(queries: np.ndarray, corners: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Scores at the lowest corner, and what the rest of a cell can take from or add to them, per query."""
    above, below = np.maximum(queries, 0).sum(1), np.minimum(queries, 0).sum(1)
    return _products(queries, corners), (width - 1) * below, (width - 1) * above


def _lower_bounds(asked: Broadcast, grid: Grid, k: int):
    """The k best lower bounds of each query among the chunks of a task."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _blocks(asked, grid)
        tops = [np.full((len(x.ids), k), _NONE) for x in blocks]
        for dims, ids, corners, _ in _chunks(batches, grid):
            for block, top in zip(blocks, tops):
                if block.dims == dims and grid.bounded(dims):
                    _raise(top, block, ids, *_bounds(block.queries, corners, grid.width)[:2])
        for block, top in zip(blocks, tops):
            kept = np.nonzero(top > _NONE)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(kept[0]), block.dims, np.int32)),
                    pa.array(block.ids[kept[0]]),
                    pa.array(top[kept]),
                ],
                names=["dims", "query_id", "bound"],
            )

    return scan


def _raise(top: np.ndarray, block: Block, ids: np.ndarray, corner: np.ndarray, less: np.ndarray) -> None:
    """Put the lower bounds ``corner + less`` of a chunk that are among a query's best into its row of ``top``."""
    least = np.where(top[:, -1] > _NONE, top[:, -1] - less + 1, _MOST)
    short = np.flatnonzero(top[:, -1] == _NONE)
    if len(short):
        k, some = top.shape[1], corner[short]
        lowest = some[block.ids[short][:, None] == ids[None, :]] = _lowest(some.dtype)
        # k runs of columns have such a maximum, so k columns are as large.
        maxima = np.maximum.reduceat(some, np.arange(0, len(ids), max(1, len(ids) // (16 * k))), axis=1)
        enough = np.partition(maxima, -k, axis=1)[:, -k] if len(ids) >= k else np.full(len(short), lowest)
        rows, columns = _reach(some, enough)
        _merge(top, *_others(block, ids, short[rows], columns), corner, less)
    _merge(top, *_others(block, ids, *_reach(corner, least)), corner, less)


def _lowest(kind: np.dtype):
    return -np.inf if kind.kind == "f" else np.iinfo(kind).min


def _others(block: Block, ids: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without the pairs of a query and a row of its own id."""
    other = block.ids[rows] != ids[columns]
    return rows[other], columns[other]


def _merge(top: np.ndarray, rows: np.ndarray, columns: np.ndarray, corner: np.ndarray, less: np.ndarray) -> None:
    if not len(rows):
        return
    k, touched = top.shape[1], np.unique(rows)
    rows_of = np.concatenate([np.repeat(touched, k), rows])
    values = np.concatenate([top[touched].ravel(), corner[rows, columns].astype(np.int64) + less[rows]])
    order = np.lexsort((-values, rows_of))
    starts = np.flatnonzero(np.diff(rows_of[order], prepend=-1))
    top[touched] = values[order][starts[:, None] + np.arange(k)]


def _exact_scores(asked: Broadcast, bounds: Broadcast, grid: Grid, k: int):
    """The k best rows of each query among the chunks of a task."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _blocks(asked, grid)
        nearest = [Nearest(needed, k) for needed in bounds.value]
        for dims, ids, corners, exact in _chunks(batches, grid):
            for block, found in zip(blocks, nearest):
                if block.dims == dims:
                    _read(block, found, ids, corners, exact, grid)
        for block, found in zip(blocks, nearest):
            held = found.filled()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(block.ids, found.counts)),
                    pa.array(found.ids[held]),
                    pa.array(found.scores[held]),
                ],
                names=["query_id", "vec_id", "score"],
            )

    return scan


class Nearest:
    """The k best rows of each query of a block so far, highest score first, equal ones by ascending id."""

    def __init__(self, needed: np.ndarray, k: int):
        self.needed = needed.copy()  # what a row must reach
        self.ids, self.scores = np.zeros((2, len(needed), k), np.int64)
        self.counts = np.zeros(len(needed), np.int64)

    def filled(self, rows=slice(None)) -> np.ndarray:
        return np.arange(self.ids.shape[1]) < self.counts[rows, None]

    def of(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        return self.ids[i, : self.counts[i]], self.scores[i, : self.counts[i]]

    def put(self, i: int, ids: np.ndarray, scores: np.ndarray) -> None:
        self.counts[i] = n = len(ids)
        self.ids[i, :n], self.scores[i, :n] = ids, scores
        if n == self.ids.shape[1]:
            self.needed[i] = max(self.needed[i], scores[-1])

    def add(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        k, touched = self.ids.shape[1], np.unique(rows)
        held = self.filled(touched)
        rows = np.concatenate([np.repeat(touched, self.counts[touched]), rows])
        ids = np.concatenate([self.ids[touched][held], ids])
        scores = np.concatenate([self.scores[touched][held], scores])
        order = np.lexsort((ids, ~scores, rows))
        rows = rows[order]
        _, starts, counts = np.unique(rows, return_index=True, return_counts=True)
        place = np.arange(len(rows)) - np.repeat(starts, counts)
        best = place < k
        self.ids[rows[best], place[best]] = ids[order][best]
        self.scores[rows[best], place[best]] = scores[order][best]
        self.counts[touched] = np.minimum(counts, k)
        full = touched[counts >= k]
        self.needed[full] = np.maximum(self.needed[full], self.scores[full, -1])


def _read(block: Block, found: Nearest, ids: np.ndarray, corners: np.ndarray, exact: np.ndarray, grid: Grid) -> None:
    """Search a chunk for a block. Queries with no more than a slab of open cells are scored together."""
    bounded = grid.bounded(block.dims)
    if bounded:
        corner, _, more = _bounds(block.queries, corners, grid.width)
        rows, columns = _reach(corner, np.where(found.needed > _NONE, found.needed - more, _NONE))
    else:
        rows, columns = np.indices((len(block.ids), len(ids))).reshape(2, -1)
    rows, columns = _others(block, ids, rows, columns)
    counts = np.bincount(rows, minlength=len(block.ids))
    ends = np.cumsum(counts)
    few = np.flatnonzero(counts[rows] <= _SLAB)
    step = max(1, _SLAB_VALUES // max(1, block.dims))
    for start in range(0, len(few), step):
        some, cells = rows[few[start : start + step]], columns[few[start : start + step]]
        found.add(some, ids[cells], (exact[cells].astype(np.int64) * block.queries[some]).sum(1))
    for i in np.flatnonzero(counts > _SLAB).tolist():
        cells = columns[ends[i] - counts[i] : ends[i]]
        best = corner[i].astype(np.int64) + more[i] if bounded else np.full(len(ids), _MOST)
        own = _search(block.queries[i], exact, best, ids, cells, found.ids.shape[1], *found.of(i))
        found.put(i, *own)


def _search(query, exact, best, ids, cells, k, found=np.empty(0, np.int64), scores=np.empty(0, np.int64)):
    """Ids and scores of the k best of ``found`` and ``cells``, read in slabs from the highest possible score down."""
    cells = cells[np.argsort(-best[cells], kind="stable")]
    for start in range(0, len(cells), _SLAB):
        if len(scores) == k and scores[-1] > best[cells[start]]:
            break
        slab = cells[start : start + _SLAB]
        found = np.concatenate([found, ids[slab]])
        scores = np.concatenate([scores, exact[slab].astype(np.int64) @ query])
        order = np.lexsort((found, ~scores))[:k]
        found, scores = found[order], scores[order]
    return found, scores

"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import ctypes.util
import itertools
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from ..sources.shared import new_folder

SLICE_BYTES = 1 << 19
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialised(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """``df`` written below the shared folder and read back: a lost executor costs no recomputation.

    The shuffle files of the write go as soon as it is done, since nothing reads them again.
    """
    return written(df, purpose, **options)[0]


def written(df: DataFrame, purpose: str, **options: str) -> tuple[DataFrame, str]:
    """As :func:`materialised`, with the folder, for :func:`discard`."""
    spark = df.sparkSession
    folder = new_folder(spark, purpose)
    before = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.options(**options).parquet(folder)
    finally:
        spark.conf.unset(_CLEAN_UP) if before is None else spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(folder), folder


def discard(spark: SparkSession, *folders: str) -> None:
    """Delete folders of :func:`written` that no later step reads."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


_kept: dict[str, object] = {"stage": None}


def per_stage(make: Callable, *args):
    """``make(*args)``, which a Python worker keeps for all tasks of a stage and drops when it gets another's."""
    _forget()
    key = f"{make.__module__}.{make.__qualname__}{args!r}"
    if key not in _kept:
        _kept[key] = make(*args)
    return _kept[key]


def _forget() -> None:
    context = TaskContext.get()
    stage = context.stageId() if context else None
    if _kept["stage"] != stage:
        _kept.clear()
        _kept["stage"] = stage


@cache
def _trim() -> Callable:
    return getattr(ctypes.CDLL(ctypes.util.find_library("c")), "malloc_trim", lambda _: 0)


def release() -> None:
    """Give unused memory back to the system: a worker that waits for its next stage should hold little."""
    _forget()
    pa.default_memory_pool().release_unused()
    _trim()(0)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of whole rows with about ``limit`` bytes of ``column`` each, so memory does not follow batch size.

    A row counts 64 bytes more, which bounds the rows of a run too.
    """
    lengths = pc.binary_length(batch.column(column))
    sizes = pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes + 64, dtype=np.int64) // limit
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)]
    for start, end in itertools.pairwise(edges):
        if end > start:
            yield batch.slice(start, end - start)
    release()


def by_slices(function, column: pa.Array, limit: int = SLICE_BYTES) -> pa.Array:
    """``function`` of a string column, applied to runs of about ``limit`` bytes."""
    batch = pa.RecordBatch.from_arrays([column], ["text"])
    parts = [function(part.column("text")) for part in slices(batch, "text", limit)]
    return pa.concat_arrays(parts) if parts else function(column)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column as Python strings, null as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of all runs ``start .. start + length - 1``, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)

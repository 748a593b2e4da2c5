"""Proof that a table is small enough to broadcast."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.schemas import actual

MAX_ROWS = 200_000
MAX_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int


@dataclass
class Sizes:
    """Rows of a table, and bytes of those of its columns that are known."""

    rows: int = 0
    bytes: dict[str, int] = field(default_factory=dict)


_known: WeakKeyDictionary[DataFrame, Sizes] = WeakKeyDictionary()


def measure(df: DataFrame, columns: Sequence[str] | None = None) -> Size:
    """Rows, and bytes of the named columns; what is not known yet comes from one partial aggregate that reads only that.

    File statistics cannot answer this for a derived table: Spark's estimate for a join is the product
    of both sides, so a lookup of a few hundred rows would be sorted and shuffled with the facts. Answers are
    kept as long as ``df`` lives, and a published mart brings them along (:func:`remember`).
    """
    wanted = [c.strip("`") for c in columns or df.columns]
    own = tuple(dict.fromkeys(actual(df, c) or c for c in wanted))
    known = _known.setdefault(df, Sizes())
    missing = [name for name in own if name not in known.bytes]
    if missing:
        found = df.agg(*size_metrics(df, missing)).first()
        known.rows = found[0]
        known.bytes.update(zip(missing, (n or 0 for n in found[1:])))
    return Size(known.rows, sum(known.bytes[name] for name in own))


def size_metrics(df: DataFrame, columns: Sequence[str] | None = None) -> list[Column]:
    """Aggregates for the rows and for the bytes of each column, also for a pass that is made anyway."""
    widths = [_width(F.col(f"`{name}`"), df.schema[name].dataType) for name in columns or df.columns]
    return [F.count("*").alias("rows")] + [F.sum(w.cast("long")).alias(f"bytes_{i}") for i, w in enumerate(widths)]


def remember(df: DataFrame, rows: int, sizes: Mapping[str, int]) -> DataFrame:
    """``df``, whose size is known from when it was written."""
    _known[df] = Sizes(rows, dict(sizes))
    return df


def _width(value: Column, kind: T.DataType) -> Column:
    """Bytes of one value; nested values are charged as their JSON text."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(value)
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        size = F.octet_length(F.to_json(F.struct(value)))
    else:
        size = F.lit(16)
    return F.coalesce(size, F.lit(0)) + 8


def fits_in_broadcast(df: DataFrame, columns: Sequence[str] | None = None) -> bool:
    """Whether ``df``, cut to ``columns``, keeps within the limits."""
    size = measure(df, columns)
    return size.rows <= MAX_ROWS and size.bytes <= MAX_BYTES

"""Marts and quality rows that follow an append-only source.

For a source with updates or deletes, see ``changes``, or run the batch rebuild of the same plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def start_refresh(
    grouped: DataFrame,
    publish: Callable[[DataFrame], object],
    checkpoint: str,
    until_caught_up: bool = True,
) -> StreamingQuery:
    """Publish the whole result of a streaming aggregate after every micro-batch.

    The state holds one row per group. Publishing overwrites, so a repeated batch does no harm.
    """
    return _start(
        grouped.writeStream.outputMode("complete"),
        lambda batch, _: publish(batch),
        checkpoint,
        until_caught_up,
    )


def start_quality_flags(
    reports: DataFrame,
    check: Callable[[DataFrame], DataFrame],
    folder: str,
    checkpoint: str,
    until_caught_up: bool = True,
) -> StreamingQuery:
    """Check every micro-batch and keep its flags under the batch number.

    A batch that is run again after a failure replaces its own flags instead of adding to them.
    """

    return start_batches(
        reports.writeStream.outputMode("append"), check, folder, checkpoint, until_caught_up
    )


def start_batches(
    writer: DataStreamWriter,
    result: Callable[[DataFrame], DataFrame],
    folder: str,
    checkpoint: str,
    until_caught_up: bool = True,
) -> StreamingQuery:
    """Keep the result of every micro-batch below ``folder`` under its number."""

    def keep(batch: DataFrame, batch_id: int) -> None:
        result(batch).write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

    return _start(writer, keep, checkpoint, until_caught_up)


def _start(writer, handle, checkpoint: str, until_caught_up: bool) -> StreamingQuery:
    writer = writer.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if until_caught_up else writer).start()

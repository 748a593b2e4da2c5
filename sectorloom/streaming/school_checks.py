"""Checks between the school sources as their rows arrive.

The state is one row of counts per school number, kept by the stream. A school that is unmatched in one batch is
matched in the next if that brings its partner, so every batch has the results over all rows so far.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.periods import within_year
from ..plans.school_quality import key_presence, presence_log
from .refresh import start_batches


def streamed_presence(services: DataFrame, reports: DataFrame, infrastructure: DataFrame, year: int) -> DataFrame:
    """Per school number its row count in every source so far, of streams of the sources.

    The mart has the school numbers of the year's service rows.
    """
    of_year = services.where(within_year(F.col("reportdate"), year))
    return key_presence(services, reports, infrastructure, of_year, year)


def start_school_checks(
    presence: DataFrame,
    run_ts: dt.datetime,
    folder: str,
    checkpoint: str,
    until_caught_up: bool = True,
) -> StreamingQuery:
    """Keep the log rows of every micro-batch below ``folder`` as ``batch_id``; the last are those of all rows.

    A batch that is run again after a failure replaces its own rows.
    """
    return start_batches(
        presence.writeStream.outputMode("complete"),
        lambda counts: presence_log(counts, run_ts),
        folder,
        checkpoint,
        until_caught_up,
    )

"""The folder that all executors share."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; where that is unset, the session's warehouse.

    The warehouse that nobody has set is a folder of the driver's machine, which executors elsewhere don't see.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    unset = warehouse.removeprefix("file:").rstrip("/") == str(Path.cwd() / "spark-warehouse")
    if unset and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return warehouse


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/sectorloom/{purpose}-{uuid.uuid4().hex}"

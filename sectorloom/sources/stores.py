"""Where inputs are read and marts are written: catalog tables or Parquet folders.

Logical names are the only ones the plans know. A store may map a name to a table of another name and
its columns to other names, so existing raw tables and dashboards keep theirs.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.sizing import remember, size_metrics

RAW = (
    "regions",
    "districts",
    "lgas",
    "lga_shapes",
    "water_point_reports",
    "coverage_reports",
    "villages",
    "household_reports",
    "school_services",
    "school_reports",
    "school_infrastructure",
    "school_enrollment",
)
QUALITY = (
    "quality_flags",
    "qc_log",
    "qc_keys",
    "status_summary",
    "unmatched_lga_names",
    "districts_without_functional",
    "table_counts",
    "null_profile",
    "toilet_share",
    "water_share",
    "uncoded_sources",
    "no_toilet_type",
    "school_rejects",
    "reject_counts",
)
# Tables that grow by the rows of every run. A run's part is a partition of its own.
LOGS = ("quality_flags", "qc_log")
LOG_KEYS = ("run_id", "part")
# Superseded versions of a mart that stay for those who are reading them.
KEEP = 3


class EmptyStage(RuntimeError):
    """A staged table has no rows and was not published."""


class Store:
    """Reads inputs given as DataFrames; subclasses add the tables they keep."""

    def __init__(
        self,
        spark: SparkSession,
        inputs: Mapping[str, DataFrame] | None = None,
        columns: Mapping[str, Mapping[str, str]] | None = None,
        keep: int = KEEP,
    ):
        self.spark = spark
        self.keep = keep
        self.inputs = dict(inputs or {})
        self.columns = {name: dict(renames) for name, renames in (columns or {}).items()}

    def exists(self, name: str) -> bool:
        return name in self.inputs or self._exists(self.location(name))

    def read(self, name: str) -> DataFrame:
        df = self.inputs[name] if name in self.inputs else self._load(self.location(name))
        theirs = {theirs: ours for ours, theirs in self.columns.get(name, {}).items()}
        renamed = df.withColumnsRenamed(theirs)
        if name in LOGS:
            return renamed.drop(*LOG_KEYS)
        kept = None if name in self.inputs else self._kept_sizes(self.location(name))
        return remember(renamed, kept["rows"], kept["bytes"]) if kept else renamed

    def missing(self, names: Sequence[str]) -> list[str]:
        return [name for name in names if not self.exists(name)]

    def replace(
        self, name: str, df: DataFrame, partition_by: Sequence[str] = (), spread: bool = False
    ) -> DataFrame:
        """Put ``df`` in place of a table in one step and return it as read back, with its true size.

        Until the new table is complete, and if anything fails, readers keep the old one. Runs that publish
        at the same time don't touch each other's stage; the last one counts. ``spread`` says that the rows of ``df``
        are already spread by ``partition_by``.
        """
        location = self.location(name)
        self._publish(self._measured_stage(name, df, partition_by, spread), location)
        return self.read(name)

    def swap(self, name: str, df: DataFrame) -> DataFrame:
        """As :meth:`replace`, for a table that must not become empty."""
        location = self.location(name)
        stage = self._measured_stage(name, df, ())
        if self._load_stage(stage).isEmpty():
            self._discard(stage)
            raise EmptyStage(name)
        self._publish(stage, location)
        return self.read(name)

    def record(self, name: str, df: DataFrame, run: int, part: str) -> DataFrame:
        """Put the rows of a run's ``part`` into a log, in place of those that an earlier attempt of it left.

        They are a partition of their own: no row of another run is read or written, however long the log,
        and runs at the same time keep the rows of both. Without rows the partition becomes empty.
        """
        self._record(self.location(name), self._named(name, df), run, part)
        return self.read(name)

    def _measured_stage(
        self, name: str, df: DataFrame, partition_by: Sequence[str], spread: bool = False
    ) -> str:
        """A stage that knows its rows and the bytes of its columns, observed by the job that writes it."""
        observed = Observation()
        measured = df.observe(observed, *size_metrics(df))
        stage = self._stage(self.location(name), self._named(name, measured), partition_by, spread)
        found = observed.get
        sizes = {c: found.get(f"bytes_{i}") or 0 for i, c in enumerate(df.columns)}
        self._keep_sizes(stage, {"rows": found.get("rows") or 0, "bytes": sizes})
        return stage

    def _named(self, name: str, df: DataFrame) -> DataFrame:
        return df.withColumnsRenamed(self.columns.get(name, {}))

    def location(self, name: str) -> str:
        raise NotImplementedError

    def _exists(self, location: str) -> bool:
        raise NotImplementedError

    def _load(self, location: str) -> DataFrame:
        raise NotImplementedError

    def _stage(
        self, location: str, df: DataFrame, partition_by: Sequence[str], spread: bool = False
    ) -> str:
        """Write ``df`` beside ``location`` and return where."""
        raise NotImplementedError

    def _load_stage(self, stage: str) -> DataFrame:
        raise NotImplementedError

    def _discard(self, stage: str) -> None:
        raise NotImplementedError

    def _publish(self, stage: str, target: str) -> None:
        raise NotImplementedError

    def _record(self, location: str, df: DataFrame, run: int, part: str) -> None:
        raise NotImplementedError

    def _keep_sizes(self, stage: str, sizes: dict) -> None:
        raise NotImplementedError

    def _kept_sizes(self, location: str) -> dict | None:
        """What :meth:`_keep_sizes` has kept with the version that is the table now; None for a foreign table."""
        raise NotImplementedError

    def _files(self, location: str):
        """Hadoop's view of the store that holds ``location``, and the path in it."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(location)
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), path

    def _delete(self, location: str) -> None:
        files, path = self._files(location)
        files.delete(path, True)


def layer_of(name: str) -> str:
    if name in RAW:
        return "raw"
    return "quality" if name in QUALITY else "marts"


def _writer(df: DataFrame, partition_by: Sequence[str], spread: bool):
    """Partitioned tables are rebalanced first unless they come so: even files, and a hot partition in several of them."""
    if partition_by and not spread:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.format("parquet")
    return writer.partitionBy(*partition_by) if partition_by else writer


class TableStore(Store):
    """Tables of the session catalog, one database per layer.

    A mart is a view of one of its versions, which are tables named after it. One statement points the view to a new
    version, so readers find the old one or the new one, and a crash at any step leaves the old one. A version knows
    the one it follows; those further back than ``keep`` are dropped after the switch. (A plain table of the name becomes the
    first version when it is published for the first time; only then the name is missing for a moment.)

    A log is a partitioned table; the rows of a run's part are written to a folder of their own before its partition
    is pointed there.
    """

    def __init__(self, spark, databases: Mapping[str, str], tables=None, **kwargs):
        super().__init__(spark, **kwargs)
        self.databases = dict(databases)
        self.tables = dict(tables or {})

    def location(self, name: str) -> str:
        return self.tables.get(name, f"{self.databases[layer_of(name)]}.{name}")

    def sweep(self, name: str) -> None:
        """Drop the versions that crashed runs have left. Not while another run writes this mart."""
        location = self.location(name)
        current = self._version(location)
        kept = {version.rpartition(".")[2] for version in self._chain(current)[: self.keep + 1]}
        database, _, table = location.rpartition(".")
        for found in self.spark.sql(f"SHOW TABLES IN {database} LIKE '{table}__v*'").collect():
            if found["tableName"] not in kept:
                self._discard(f"{database}.{found['tableName']}")

    def _exists(self, location: str) -> bool:
        return self.spark.catalog.tableExists(location)

    def _load(self, location: str) -> DataFrame:
        return self.spark.table(location)

    def _stage(self, location, df, partition_by, spread=False):
        stage = f"{location}__v{uuid.uuid4().hex}"
        _writer(df, partition_by, spread).saveAsTable(stage)
        return stage

    def _load_stage(self, stage):
        return self.spark.table(stage)

    def _discard(self, stage):
        self.spark.sql(f"DROP TABLE IF EXISTS {stage}")

    def _publish(self, stage, target):
        known = self._exists(target)
        old = self._version(target) if known else None
        if known and old is None:
            old = f"{target}__v{uuid.uuid4().hex}"
            self.spark.sql(f"ALTER TABLE {target} RENAME TO {old}")
            self._switch("CREATE VIEW", target, old)
        if old:
            self.spark.sql(f"ALTER TABLE {stage} SET TBLPROPERTIES ('follows' = '{old}')")
        self._switch("ALTER VIEW" if old else "CREATE VIEW", target, stage)
        for version in self._chain(old)[self.keep :]:
            self._discard(version)

    def _keep_sizes(self, stage, sizes):
        text = json.dumps(sizes).encode().hex()
        self.spark.sql(f"ALTER TABLE {stage} SET TBLPROPERTIES ('sizes' = '{text}')")

    def _kept_sizes(self, location):
        text = self._properties(self._version(location) or location).get("sizes")
        return json.loads(bytes.fromhex(text)) if text else None

    def _properties(self, table: str) -> dict[str, str]:
        return {row["key"]: row["value"] for row in self.spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}

    def _switch(self, statement: str, view: str, version: str) -> None:
        """``ALTER VIEW`` is one change in the catalog; ``CREATE OR REPLACE VIEW`` would drop the view first."""
        self.spark.sql(f"{statement} {view} AS SELECT * FROM {version}")

    def _described(self, table: str, partition: str = "") -> dict[str, str]:
        """The details of a table or partition; those of its columns, and of a partition's table, are left out."""
        rows = [tuple(row)[:2] for row in self.spark.sql(f"DESCRIBE TABLE EXTENDED {table} {partition}").collect()]
        start = next(i for i, (name, _) in enumerate(rows) if name.startswith("# Detailed"))
        details: dict[str, str] = {}
        for name, value in rows[start + 1 :]:
            details.setdefault(name, value)
        return details

    def _version(self, view: str) -> str | None:
        """The version that a view shows; None for a table."""
        return self._described(view).get("View Text", "").rpartition(" FROM ")[2] or None

    def _chain(self, version: str | None) -> list[str]:
        """A version, the one it follows, and so on as far as they still exist."""
        chain = []
        while version:
            try:
                properties = self._properties(version)
            except AnalysisException:  # dropped, perhaps just now by another run
                break
            chain.append(version)
            version = properties.get("follows")
        return chain

    def _record(self, location, df, run, part):
        spec = f"PARTITION ({LOG_KEYS[0]} = {run}, {LOG_KEYS[1]} = '{part}')"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {location} ({df.schema.toDDL()}, {LOG_KEYS[0]} BIGINT, {LOG_KEYS[1]} STRING)"
            f" USING parquet PARTITIONED BY ({', '.join(LOG_KEYS)})"
        )
        folder = self._described(location)["Location"]
        attempt = f"{folder}/{LOG_KEYS[0]}={run}/{LOG_KEYS[1]}={part}/{uuid.uuid4().hex}"
        df.write.parquet(attempt)
        had = self.spark.sql(f"SHOW PARTITIONS {location} {spec}").collect()
        before = self._described(location, spec).get("Location") if had else None
        change = f"{spec} SET LOCATION" if had else f"ADD IF NOT EXISTS {spec} LOCATION"
        self.spark.sql(f"ALTER TABLE {location} {change} '{attempt}'")
        if before and before.startswith(f"{folder}/{LOG_KEYS[0]}="):
            self._delete(before)


class FolderStore(Store):
    """Parquet folders under one root, for sessions without a shared catalog.

    A table is a folder of numbered versions. A version is written under a hidden name and gets its own by one rename when it is
    complete, so a failed write changes nothing for readers; the latest is the table. ``keep`` versions before it
    stay for those that are reading them. A log has a folder per run and part instead, and in it one per attempt, of which the latest counts.
    """

    def __init__(self, spark, root: str, **kwargs):
        super().__init__(spark, **kwargs)
        self.root = root.rstrip("/")

    def location(self, name: str) -> str:
        return f"{self.root}/{layer_of(name)}/{name}"

    def _exists(self, location: str) -> bool:
        """A folder of plain Parquet files is a table too."""
        files, path = self._files(location)
        if not files.exists(path):
            return False
        names = [status.getPath().getName() for status in files.listStatus(path)]
        return any(not name.startswith(("_", ".")) for name in names)

    def _load(self, location: str) -> DataFrame:
        versions = self._versions(location)
        if versions:
            return self._load_stage(f"{location}/{versions[-1]}")
        log = self._load_log(location)
        return self._load_stage(location) if log is None else self._untimed(log)

    def _load_stage(self, stage):
        """Marts hold only times without zone, but a partition folder reads back with one."""
        df = self.spark.read.parquet(stage)
        if stage.startswith(f"{self.root}/raw/"):
            return df
        return self._untimed(df)

    def _untimed(self, df: DataFrame) -> DataFrame:
        zoned = [c for c, kind in df.dtypes if kind == "timestamp"]
        return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})

    def _stage(self, location, df, partition_by, spread=False):
        stage = f"{location}/_stage-{uuid.uuid4().hex}"
        _writer(df, partition_by, spread).save(stage)
        return stage

    def _discard(self, stage):
        self._delete(stage)

    def _publish(self, stage, target):
        versions = self._versions(target)
        number = int(versions[-1][1:9]) + 1 if versions else 1
        # Two runs may take the same number; the rest of the name keeps them apart.
        final = f"{target}/v{number:08d}-{stage.rpartition('-')[2]}"
        files, path = self._files(stage)
        if not files.rename(path, self._files(final)[1]):
            raise OSError(f"{stage} could not be renamed to {final}")
        for old in self._versions(target)[: -1 - self.keep]:
            self._discard(f"{target}/{old}")

    def _record(self, location, df, run, part):
        folder = f"{location}/{LOG_KEYS[0]}={run}/{LOG_KEYS[1]}={part}"
        name = uuid.uuid4().hex
        df.write.parquet(f"{folder}/_stage-{name}")
        before = self._attempts(folder)
        number = int(before[-1].rpartition("/")[2][8:16]) + 1 if before else 1
        files, path = self._files(f"{folder}/_stage-{name}")
        final = f"{folder}/attempt={number:08d}-{name}"
        if not files.rename(path, self._files(final)[1]):
            raise OSError(f"{path} could not be renamed to {final}")
        for old in before[:-1]:
            self._delete(old)

    def _keep_sizes(self, stage, sizes):
        files, path = self._files(f"{stage}/_sizes.json")
        stream = files.create(path)
        try:
            stream.write(bytearray(json.dumps(sizes).encode()))
        finally:
            stream.close()

    def _kept_sizes(self, location):
        versions = self._versions(location)
        files, path = self._files(f"{location}/{versions[-1] if versions else '.'}/_sizes.json")
        if not versions or not files.exists(path):
            return None
        stream = files.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _attempts(self, pattern: str) -> list[str]:
        """The finished attempts of parts of runs, as paths in order."""
        files, path = self._files(f"{pattern}/attempt=*")
        return sorted(status.getPath().toString() for status in files.globStatus(path) or [])

    def _load_log(self, location: str) -> DataFrame | None:
        """The latest attempt of every part; none if it is no log."""
        latest: dict[str, str] = {}
        for attempt in self._attempts(f"{location}/{LOG_KEYS[0]}=*/{LOG_KEYS[1]}=*"):
            latest[attempt.rpartition("/")[0]] = attempt
        if not latest:
            return None
        return self.spark.read.option("basePath", location).parquet(*latest.values()).drop("attempt")

    def _versions(self, location: str) -> list[str]:
        files, path = self._files(location)
        if not files.exists(path):
            return []
        found = [status.getPath().getName() for status in files.listStatus(path)]
        return sorted(name for name in found if name.startswith("v") and name[1:9].isdigit())
